"""Adapter: the star-schema test tables seen as the event table.

The tables hold (event_id, ts, user_id, event_type, value, props). Everything else
is derived by fixed rules from ``value`` and the number in ``props``; region comes
from customer -> nation -> region, sessions from a six-hour gap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import (
    MONEY,
    epoch_micros,
    epoch_weekday,
    hour_bucket,
    hour_of_day,
    is_event,
    literal_array,
)
from pulsetrail.materialize import materialize
from pulsetrail.operators.kpis import KPI_KEYS, discrete_quantile
from pulsetrail.operators.sessions import SLOT, session_slots, sessionize, slot_of
from pulsetrail.schemas import CATEGORIES, ERROR_CODES, HOURLY, OK_CODE

GAP_S = 6 * 3600
STAGES = ("view", "click", "signup", "purchase")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that come from the event row alone: no join, no shuffle."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return (
        read_table(spark, sf_dir, "events")
        .withColumn("k", k)
        .withColumn("timestamp", epoch_micros(F.col("ts")) / F.lit(1e6))
        .select(
            "event_id",
            "user_id",
            "event_type",
            "timestamp",
            F.col("ts").cast("timestamp_ntz").alias("timestamp_dt"),
            F.when(F.col("k") % 20 < 13, "mobile")
            .when(F.col("k") % 20 < 19, "desktop")
            .otherwise("tablet")
            .alias("device"),
            F.element_at(literal_array(CATEGORIES), F.col("k") % 10 + 1).alias("category"),
            F.col("value").alias("price"),
            F.when(is_event("purchase"), F.col("value")).otherwise(0.0).alias("revenue"),
            F.floor(F.col("value") * 10).alias("response_time_ms"),
            F.when(
                is_event("error"),
                F.element_at(literal_array(ERROR_CODES), F.col("k") % 5 + 1),
            )
            .otherwise(OK_CODE)
            .alias("error_code"),
            hour_of_day(F.col("timestamp")).alias("hour"),
            epoch_weekday(F.col("timestamp")).alias("day_of_week"),
        )
    )


def user_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region name per user. nation and region are the fixed 25- and 5-row tables."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (
        read_table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region"))
    )


def _labelled_slots(base: DataFrame, regions: DataFrame, gap_s: int) -> DataFrame:
    """The (user, slot) aggregate with its session and region."""
    slots = session_slots(base, gap_s).join(regions, "user_id", "left")
    return slots.withColumn("region", _known("region"))


def _known(region: str) -> Column:
    """Events without a user have no slot, and so no region yet."""
    return F.coalesce(F.col(region), F.lit("UNKNOWN"))


def canonical_events(spark: SparkSession, sf_dir: str, gap_s: int = GAP_S) -> DataFrame:
    """The full event table, with region and session.

    Region joins the (user, slot) aggregate, so events shuffle once for both.
    """
    base = base_events(spark, sf_dir)
    slots = _labelled_slots(base, user_regions(spark, sf_dir), gap_s)
    events = sessionize(base, gap_s, slots=materialize(slots))
    return events.withColumn("region", _known("region"))


def canonical_hourly(spark: SparkSession, sf_dir: str, gap_s: int = GAP_S) -> DataFrame:
    """The hourly KPI table, the same as ``hourly_kpis`` of the canonical events.

    Events are reduced to (hour, device, user, slot) where they are read, and only that
    aggregate meets the slots for region and session. A user has one region and a session
    one user, so users and sessions are counted by two groupings and no distinct count
    expands a row. The p95 is exact: events are counted per (hour, device, user, latency),
    so no event is shuffled for it, and it is the latency where the running count of an
    (hour, region, device) reaches 95 %.
    """
    base = base_events(spark, sf_dir).withColumn("hour_bucket", hour_bucket(F.col("timestamp")))
    regions = user_regions(spark, sf_dir)
    slots = _labelled_slots(base, regions, gap_s)
    rows = F.count(F.lit(1))
    fine = base.groupBy("hour_bucket", "device", "user_id", slot_of("timestamp_dt", gap_s).alias(SLOT)).agg(
        rows.alias("event_count"),
        F.count_if(is_event("purchase")).alias("purchases"),
        F.sum(F.col("revenue").try_cast(MONEY)).alias("revenue"),
        F.sum("response_time_ms").alias("latency"),
        F.count("response_time_ms").alias("timed"),
        F.count_if(is_event("error")).alias("error_count"),
    )
    # A (user, slot) pair has a few rows here, so no key of this join is hot.
    labels = slots.select("user_id", SLOT, "session_id", "region")
    sums = ["event_count", "purchases", "revenue", "latency", "timed", "error_count"]
    users = (
        fine.join(labels, ["user_id", SLOT], "left")
        .groupBy("hour_bucket", _known("region").alias("region"), "device", "user_id")
        .agg(*[F.sum(c).alias(c) for c in sums], F.count_distinct("session_id").alias("sessions"))
    )
    measured = users.groupBy(*KPI_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.count("user_id").alias("unique_users"),
        F.sum("sessions").alias("unique_sessions"),
        F.sum("purchases").alias("purchases"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.try_divide(F.sum("latency"), F.sum("timed")).alias("avg_response_ms"),
        F.sum("error_count").alias("error_count"),
        (F.sum("error_count") / F.sum("event_count")).alias("error_rate"),
    )
    counted = base.groupBy("hour_bucket", "device", "user_id", "response_time_ms").agg(rows.alias("n"))
    slow = discrete_quantile(
        counted.join(regions, "user_id", "left").withColumn("region", _known("region")),
        KPI_KEYS,
        "response_time_ms",
        95,
        "p95_response_ms",
    )
    # Exactly one side holds each measure of a key; grouping keeps null devices.
    both = measured.unionByName(slow, allowMissingColumns=True)
    names = [name for name in HOURLY.names if name not in KPI_KEYS]
    return both.groupBy(*KPI_KEYS).agg(*[F.max(name).alias(name) for name in names])

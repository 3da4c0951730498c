"""Seeded synthetic event log, produced by the executors.

Every value is a hash of (row id, column salt, seed), so a row is the same whatever
the number of partitions, on a retry, and in whichever chunk it is asked for.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import (
    DAY_S,
    HOUR_S,
    epoch_to_ts,
    epoch_weekday,
    exact_sum,
    hour_of_day,
    is_event,
    literal_array,
)
from pulsetrail.schemas import CATEGORIES, EVENT_TYPES, EVENTS, OK_CODE

# ---- Fixed values -------------------------------------------------------------
# Shares and parameters of the simulated shop. They define the data set.

EVENT_SHARES = {
    "page_view": 0.35,
    "search": 0.18,
    "product_view": 0.22,
    "add_to_cart": 0.09,
    "remove_from_cart": 0.02,
    "checkout_start": 0.05,
    "purchase": 0.04,
    "error": 0.03,
    "wishlist_add": 0.02,
}
DEVICE_SHARES = {"mobile": 0.65, "desktop": 0.30, "tablet": 0.05}
PLATFORM_SHARES = {"ios": 0.38, "android": 0.27, "web": 0.35}
REGION_SHARES = {
    "us-east-1": 0.35,
    "us-west-2": 0.25,
    "eu-west-1": 0.20,
    "ap-southeast-1": 0.12,
    "ap-northeast-1": 0.08,
}
ERROR_SHARES = {"500": 0.35, "503": 0.25, "504": 0.20, "404": 0.15, "429": 0.05}
SEARCH_WORDS = ("laptop", "phone", "shirt", "book", "toy", "shoes", "watch", "bag")
# Relative traffic for hours 0 to 23.
HOUR_WEIGHTS = (
    0.2, 0.1, 0.1, 0.1, 0.1, 0.2, 0.5, 0.9, 1.1, 1.2, 1.3, 1.4,
    1.8, 1.9, 1.7, 1.6, 1.5, 1.6, 1.7, 2.0, 1.8, 1.4, 0.9, 0.5,
)
SALE_DAY = 45
SALE_HOURS = (13, 14, 15)
START_EPOCH = 1_704_067_200  # 2024-01-01T00:00:00Z
DAYS = 90
PRICE_LOG_MEAN, PRICE_LOG_SD = 3.5, 1.2
PRICE_MIN, PRICE_MAX = 0.99, 2999.99
LATENCY_LOG_MEAN, LATENCY_LOG_SD = 5.5, 0.5
ERROR_LATENCY_LOG_MEAN, ERROR_LATENCY_LOG_SD = 7.5, 1.0
MIN_USERS = 100_000
EVENTS_PER_USER = 10
CHUNK_ROWS = 500_000

_RESOLUTION = 1 << 53


# One uniform per row for each of these; the position is the hash salt.
_SALTS = (
    "type", "day", "hour", "sale", "second", "user", "session", "device", "platform",
    "region", "category", "product", "price/r", "price/a", "fast/r", "fast/a",
    "slow/r", "slow/a", "code", "quantity", "word",
)


def _uniforms(row: Column, seed: int) -> list[Column]:
    """Doubles strictly inside (0, 1), one column per salt.

    They are columns of their own so that a draw used in many branches of a
    ``CASE`` is hashed once per row.
    """
    return [
        (
            (F.shiftrightunsigned(F.xxhash64(row, F.lit(i), F.lit(seed)), 11) + 0.5)
            / float(_RESOLUTION)
        ).alias(f"_{salt}")
        for i, salt in enumerate(_SALTS)
    ]


def _integer(salt: str, low: int, high: int) -> Column:
    """A whole number in [low, high)."""
    return F.floor(F.col(f"_{salt}") * (high - low)) + low


def _one_of(salt: str, values: Sequence) -> Column:
    return F.element_at(literal_array(values), _integer(salt, 1, len(values) + 1).cast("int"))


def _weighted(salt: str, shares: Mapping) -> Column:
    """A key of ``shares`` with probability proportional to its share."""
    total, running, choice = sum(shares.values()), 0.0, F
    *head, last = shares.items()
    for value, share in head:
        running += share
        choice = choice.when(F.col(f"_{salt}") < running / total, value)
    return choice.otherwise(last[0])


def _lognormal(salt: str, mean: float, sd: float) -> Column:
    radius = F.sqrt(-2.0 * F.log(F.col(f"_{salt}/r")))
    return F.exp(mean + sd * radius * F.cos(2.0 * math.pi * F.col(f"_{salt}/a")))


def _cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5) / 100


def _padded(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded id; numbers wider than ``width`` keep all their digits."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def diurnal_seconds(start: int = START_EPOCH, days: int = DAYS) -> Column:
    """Whole epoch seconds: uniform day, weighted hour, one day squeezed into a sale."""
    day = _integer("day", 0, days)
    hour = F.when(day == SALE_DAY, _one_of("sale", SALE_HOURS)).otherwise(
        _weighted("hour", dict(enumerate(HOUR_WEIGHTS)))
    )
    return (F.lit(start) + day * DAY_S + hour * HOUR_S + _integer("second", 0, HOUR_S)).cast(
        "double"
    )


def _user(row: Column, users: int, seed: int) -> Column:
    """User ids with a power-law load that changes from chunk to chunk.

    Zipf(1.5) weights per user give the i-th busiest one a share near 1/i^2. That is
    the law of floor(1/u), so a rank is one expression and no weight table exists.
    """
    rank = F.least(F.floor(1.0 / F.col("_user")), F.lit(users))
    chunk = F.floor(row / CHUNK_ROWS)
    number = F.pmod(F.xxhash64(rank, chunk, F.lit(len(_SALTS)), F.lit(seed)), F.lit(users))
    return _padded("U", number, 7)


def generate_diurnal_timestamps(
    spark: SparkSession,
    n: int,
    start: int = START_EPOCH,
    days: int = DAYS,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """``n`` event times alone: (id, timestamp in epoch seconds)."""
    ids = spark.range(0, n, 1, partitions)
    drawn = ids.select("id", *_uniforms(F.col("id"), seed))
    return drawn.select("id", diurnal_seconds(start, days).alias("timestamp"))


def generate_events(
    spark: SparkSession,
    n: int = 10_000_000,
    seed: int = 42,
    partitions: int | None = None,
    start: int = START_EPOCH,
    days: int = DAYS,
) -> DataFrame:
    """``n`` synthetic events with the schema ``EVENTS``."""
    users = max(MIN_USERS, n // EVENTS_PER_USER)
    row = F.col("id")
    return events_from_ids(spark.range(0, n, 1, partitions), row, users, seed, start, days)


def events_from_ids(
    ids: DataFrame,
    row: Column,
    users: int,
    seed: int = 42,
    start: int = START_EPOCH,
    days: int = DAYS,
) -> DataFrame:
    """Synthetic events for the row ids of any DataFrame."""
    at = F.col("timestamp")
    price = _cents(_lognormal("price", PRICE_LOG_MEAN, PRICE_LOG_SD))
    latency = F.when(
        is_event("error"), _lognormal("slow", ERROR_LATENCY_LOG_MEAN, ERROR_LATENCY_LOG_SD)
    ).otherwise(_lognormal("fast", LATENCY_LOG_MEAN, LATENCY_LOG_SD))
    drawn = ids.select(row.alias("_row"), *_uniforms(row, seed)).withColumns(
        {
            "event_type": _weighted("type", EVENT_SHARES),
            "timestamp": diurnal_seconds(start, days),
            "price": F.greatest(F.least(price, F.lit(PRICE_MAX)), F.lit(PRICE_MIN)),
        }
    )
    return drawn.withColumns(
        {
            "event_id": _padded("E", F.col("_row"), 10),
            "user_id": _user(F.col("_row"), users, seed),
            "session_id": F.concat(F.lit("S"), _integer("session", 10**9, 9 * 10**9)),
            "timestamp_dt": epoch_to_ts(at),
            "device": _weighted("device", DEVICE_SHARES),
            "platform": _weighted("platform", PLATFORM_SHARES),
            "region": _weighted("region", REGION_SHARES),
            "category": _one_of("category", CATEGORIES),
            "product_id": F.concat(F.lit("P"), _integer("product", 1000, 99_999)),
            "revenue": F.when(
                is_event("purchase"), _cents(F.col("price") * _integer("quantity", 1, 4))
            ).otherwise(0.0),
            "response_time_ms": F.floor(latency),
            "error_code": F.when(is_event("error"), _weighted("code", ERROR_SHARES)).otherwise(
                OK_CODE
            ),
            "search_query": F.when(
                is_event("search"), F.concat(F.lit("query_"), _one_of("word", SEARCH_WORDS))
            ).otherwise(""),
            "hour": hour_of_day(at),
            "day_of_week": epoch_weekday(at),
        }
    ).select(*EVENTS.names)


def event_distribution(events: DataFrame) -> DataFrame:
    """Events per type: (event_type, events). Events without a type are left out."""
    return (
        events.where("event_type is not null")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def dataset_profile(events: DataFrame, event_types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """One row that describes a data set: totals, distincts, distribution, range.

    Distinct counts run as their own narrow aggregates, so the wide one never
    expands its input. The distribution lists the given types that occur, and all others
    together as ``other``: its size is fixed. ``event_distribution`` counts any types.
    """
    others = ~F.col("event_type").isin(*event_types)
    counts = {kind: F.count_if(is_event(kind)) for kind in sorted(event_types)} | {"other": F.count_if(others)}
    totals = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.avg(is_event("error").cast("double")), F.lit(0.0)).alias("error_rate"),
        exact_sum("revenue").alias("total_revenue"),
        F.avg("response_time_ms").alias("avg_response_ms"),
        F.min("timestamp").alias("_from"),
        F.max("timestamp").alias("_to"),
        F.array(*counts.values()).alias("_counts"),
    )
    distribution = F.map_from_arrays(literal_array(counts), F.col("_counts"))
    date_range = F.concat_ws(
        " to ", *[epoch_to_ts(F.col(c)).cast("string") for c in ("_from", "_to")]
    )
    return totals.select(
        "total_events",
        events.agg(F.count_distinct("user_id")).scalar().alias("unique_users"),
        events.agg(F.count_distinct("session_id")).scalar().alias("unique_sessions"),
        F.map_filter(distribution, lambda _, n: n > 0).alias("event_distribution"),
        "error_rate",
        "total_revenue",
        "avg_response_ms",
        date_range.alias("date_range"),
    )

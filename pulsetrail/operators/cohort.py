"""Cohort retention: who comes back how many periods after their first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import epoch_micros, epoch_to_ts, month_index, rounded

_WEEK_MICROS = 7 * 86_400 * 1_000_000


def _period_start(ts: Column, grain: str) -> Column:
    return F.trunc(ts.cast("date"), grain).cast("timestamp_ntz")


def _periods_between(later: Column, earlier: Column, grain: str) -> Column:
    if grain == "month":
        return month_index(later) - month_index(earlier)
    return F.round((epoch_micros(later) - epoch_micros(earlier)) / _WEEK_MICROS)


def cohort_analysis(
    events: DataFrame,
    grain: str = "month",
    user_col: str = "user_id",
    time_col: str = "timestamp_dt",
) -> DataFrame:
    """Users and retention per (cohort period, periods since).

    Events collapse to the distinct (user, period) pairs before anything else, so a
    very active user weighs no more than the number of periods in the data.
    ``grain`` is ``month`` or ``week``. Output columns use the names of the monthly
    report: cohort_month, months_since (or cohort_week, weeks_since). A table without
    ``time_col`` is read by its epoch seconds in ``timestamp``.
    """
    if grain not in ("month", "week"):
        raise ValueError(f"unknown grain: {grain}")
    cohort, since = f"cohort_{grain}", f"{grain}s_since"
    has_time = time_col in events.columns
    at = F.col(time_col).cast("timestamp_ntz") if has_time else epoch_to_ts(F.col("timestamp"))
    # One shuffle: a user's set of periods is as long as the history, not as the events.
    counts = (
        events.select(F.col(user_col).alias("_user"), _period_start(at, grain).alias("_period"))
        .where("_user is not null and _period is not null")
        .groupBy("_user")
        .agg(F.collect_set("_period").alias("_periods"))
        .select(F.array_min("_periods").alias(cohort), F.explode("_periods").alias("_period"))
        .withColumn(since, _periods_between(F.col("_period"), F.col(cohort), grain).cast("int"))
        .groupBy(cohort, since)
        .agg(F.count(F.lit(1)).alias("users"))
    )
    by_age = Window.partitionBy(cohort).orderBy(since)
    size = F.first("users").over(by_age)  # period 0 exists for every cohort
    return counts.withColumn("retention", rounded(F.col("users") / size, 4))

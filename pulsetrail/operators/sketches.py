"""KPI states that merge upwards: latency quantiles and distinct users.

An hourly p95 cannot be turned into a daily one, nor can hourly user counts be added up.
A KPI row keeps a small state of each instead: a KLL sketch of the latencies and a HyperLogLog
sketch of the users. States of any rows merge into the state of all their events, so
every rollup is read from the hourly table and no event is read again. A state has a fixed
largest size, whatever its group holds: some ``3 * k`` numbers, and ``2 ** lg`` bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import hour_bucket

QUANTILE_K = 200
DISTINCT_LG = 12


def rank_error(k: int = QUANTILE_K) -> float:
    """Share of the values by which the rank of a quantile is off, at 99 % confidence."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg / 2)


def hourly_sketches(
    events: DataFrame,
    dims: Sequence[str] = ("region", "device"),
    k: int = QUANTILE_K,
    lg: int = DISTINCT_LG,
) -> DataFrame:
    """Per hour and dimension: event_count, latency_sketch, users_sketch.

    Null latencies and users are not counted. Both states combine before the shuffle.
    """
    return (
        events.withColumn("hour_bucket", hour_bucket(F.col("timestamp")))
        .groupBy("hour_bucket", *dims)
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.kll_sketch_agg_bigint(F.col("response_time_ms").cast("bigint"), F.lit(k)).alias("latency_sketch"),
            F.hll_sketch_agg("user_id", lg).alias("users_sketch"),
        )
    )


def merge_sketches(states: DataFrame, *keys: str | Column) -> DataFrame:
    """The states of coarser groups, from those of finer ones."""
    return states.groupBy(*keys).agg(
        F.sum("event_count").alias("event_count"),
        F.kll_merge_agg_bigint("latency_sketch").alias("latency_sketch"),
        F.hll_union_agg("users_sketch").alias("users_sketch"),
    )


def latency_quantile(probability: float, sketch: str = "latency_sketch") -> Column:
    """The least latency that at least this share of the events does not exceed."""
    empty = F.kll_sketch_get_n_bigint(sketch) == 0
    return F.when(~empty, F.kll_sketch_get_quantile_bigint(F.col(sketch), F.lit(probability)))


def unique_users(sketch: str = "users_sketch") -> Column:
    return F.hll_sketch_estimate(sketch)

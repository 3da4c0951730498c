"""Conversion funnel: how many entities reached each stage, in any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import is_event, rounded, safe_ratio
from pulsetrail.schemas import FUNNEL_STAGES


def _reached(
    events: DataFrame, stages: Sequence[str], entity: str, segment: Sequence[str]
) -> DataFrame:
    """One row per segment with a column ``_0``, ``_1``... of entities per stage.

    Each entity becomes one row of flags first. That combines map-side, shuffles at
    most one row per entity and task, and counts distinct entities without a
    distinct aggregate.
    """
    flags = [
        F.bool_or(is_event(stage)).alias(f"_{i}") for i, stage in enumerate(stages)
    ]
    counts = [F.count_if(F.col(f"_{i}")).alias(f"_{i}") for i in range(len(stages))]
    rows = events.where(F.col(entity).isNotNull())
    for name in segment:
        rows = rows.where(F.col(name).isNotNull())
    # Every segment keeps its row, also one whose events are all outside the stages.
    return rows.groupBy(*segment, entity).agg(*flags).groupBy(*segment).agg(*counts)


def _stage_struct(stages: Sequence[str], i: int) -> Column:
    users, top = F.col(f"_{i}"), F.col("_0")
    from_prev = safe_ratio(users, F.col(f"_{i - 1}")) if i else safe_ratio(users, users)
    return F.struct(
        F.lit(i).alias("stage_index"),
        F.lit(stages[i]).alias("stage"),
        users.alias("users"),
        rounded(safe_ratio(users, F.greatest(top, F.lit(1))), 4).alias("conversion_from_top"),
        rounded(from_prev, 4).alias("conversion_from_prev"),
        rounded(1.0 - from_prev if i else F.lit(0.0), 4).alias("dropoff_rate"),
    )


def compute_funnel(
    events: DataFrame,
    segment_by: str | Sequence[str] | None = None,
    stages: Sequence[str] = FUNNEL_STAGES,
    entity: str = "user_id",
) -> DataFrame:
    """Funnel per segment, one row per (segment, stage), empty stages included.

    A segment column the frame lacks means one overall funnel. Each row repeats the
    segment's ``overall_conversion`` and ``biggest_dropoff`` (the first stage after
    the top with the largest rounded drop-off).
    """
    names = [segment_by] if isinstance(segment_by, str) else list(segment_by or ())
    segment = names if names and set(names) <= set(events.columns) else []
    last = len(stages) - 1
    built = _reached(events, stages, entity, segment).select(
        *segment,
        F.array(*[_stage_struct(stages, i) for i in range(len(stages))]).alias("_stages"),
        rounded(safe_ratio(F.col(f"_{last}"), F.col("_0")), 4).alias("overall_conversion"),
    )
    if not segment:
        built = built.withColumn("segment", F.lit("overall"))
        segment = ["segment"]
    drops = F.slice("_stages", 2, len(stages))
    worst = F.array_max(F.transform(drops, lambda s: s["dropoff_rate"]))
    biggest = F.filter(drops, lambda s: s["dropoff_rate"] == worst)
    return (
        built.withColumn("biggest_dropoff", F.get(biggest, F.lit(0))["stage"])
        .withColumn("_row", F.explode("_stages"))
        .select(*segment, "_row.*", "overall_conversion", "biggest_dropoff")
    )

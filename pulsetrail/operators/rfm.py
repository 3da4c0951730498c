"""Recency / frequency / monetary scores and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import MONEY, MONEY_TOTAL, epoch_to_ts, is_event, rounded, whole_days
from pulsetrail.materialize import materialize
from pulsetrail.operators.ordering import equal_frequency_cuts, group_number
from pulsetrail.schemas import RFM_SEGMENTS

QUINTILES = 5


def segment_label(r: Column, f: Column, m: Column) -> Column:
    """Segment of a score triple; the first rule that fits wins."""
    champions, loyal, potential, new, at_risk, lost = RFM_SEGMENTS
    return (
        F.when(F.least(r, f, m) >= 4, champions)
        .when(F.least(r, f) >= 3, loyal)
        .when((r >= 4) & (f <= 2), new)
        .when((r <= 2) & (f >= 3), at_risk)
        .when((r <= 2) & (f <= 2), lost)
        .otherwise(potential)
    )


def _purchase_totals(purchases: DataFrame, user: str, order_id: str, amount: str) -> DataFrame:
    return (
        purchases.where(F.col(user).isNotNull())
        .groupBy(F.col(user).alias("user_id"))
        .agg(
            F.max("_at").alias("last_purchase"),
            F.count(order_id).alias("frequency"),
            # An exact sum: monetary ties decide ranks, so they must be real ties. An
            # amount that money cannot hold counts as missing.
            F.coalesce(F.sum(F.col(amount).try_cast(MONEY)), F.lit(0).cast(MONEY)).alias("monetary"),
        )
    )


def rfm_segmentation(
    events: DataFrame,
    reference_date: Column | None = None,
    purchases_only: bool = True,
    user_col: str = "user_id",
    time_col: str = "timestamp_dt",
    id_col: str = "event_id",
    amount_col: str = "revenue",
    strict_edges: bool = False,
) -> DataFrame:
    """Score and segment every purchasing user.

    The reference date defaults to the latest time over all events, never to the
    clock. Recency is cut at the quintile values, frequency and monetary at the
    quintiles of their rank with ties broken by user id. ``strict_edges`` raises
    when recency quintiles coincide; otherwise tied edges leave a score unused.
    """
    if time_col in events.columns:
        at = F.col(time_col).cast("timestamp_ntz")
    else:
        at = epoch_to_ts(F.col("timestamp"))
    timed = events.withColumn("_at", at)
    if reference_date is None:
        reference_date = timed.agg(F.max("_at")).scalar()
    bought = timed.where(is_event("purchase")) if purchases_only else timed
    users = materialize(
        _purchase_totals(bought, user_col, id_col, amount_col).withColumn(
            "recency_days", whole_days(reference_date, F.col("last_purchase"))
        )
    )
    # percentile() keeps one counter per distinct value: here whole days, so the
    # buffer is bounded by the length of the history and not by the users.
    marks = [i / QUINTILES for i in range(QUINTILES + 1)]
    recency = users.agg(F.percentile("recency_days", marks).alias("edges"))
    if strict_edges:
        recency = recency.where(
            F.when(F.size(F.array_distinct("edges")) == len(marks), F.lit(True)).otherwise(
                F.raise_error(F.lit("recency quintile edges are not distinct"))
            )
        )
    inner = F.slice("edges", 2, QUINTILES - 1).alias("edges")  # without the extremes
    recency = recency.select(inner)
    cuts = {name: equal_frequency_cuts(users, [name, "user_id"], QUINTILES) for name in ("frequency", "monetary")}
    scored = users.withColumns(
        {
            "_edges": recency.scalar(),
            **{f"_{name}_cuts": c.select("cuts").scalar() for name, c in cuts.items()},
            "_n": users.agg(F.count(F.lit(1))).scalar(),
        }
    )
    days = F.col("recency_days")
    r = F.lit(QUINTILES) - F.size(F.filter("_edges", lambda edge: edge < days))
    scored = scored.withColumns(
        {
            "r_score": r.cast("int"),
            "f_score": _rank_score("frequency"),
            "m_score": _rank_score("monetary"),
        }
    ).withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    return scored.select(
        "user_id",
        "last_purchase",
        "frequency",
        F.col("monetary").cast("double").alias("monetary"),
        "recency_days",
        "r_score",
        "f_score",
        "m_score",
        "rfm_score",
        segment_label(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias("segment"),
    )


def _rank_score(name: str) -> Column:
    return group_number(F.col(f"_{name}_cuts"), F.col("_n"), [name, "user_id"], QUINTILES)


def rfm_rollup(rfm: DataFrame) -> DataFrame:
    """Users, share and mean revenue per segment."""
    # The total comes from the few segment counts, not from the users again.
    counts = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("count"),
        rounded((F.sum(F.col("monetary").try_cast(MONEY_TOTAL)) / F.count("monetary")).cast("double"), 2).alias(
            "avg_revenue"
        ),
    )
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", rounded(F.col("count") * 100 / total, 1)).select(
        "segment", "count", "pct", "avg_revenue"
    )

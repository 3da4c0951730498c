"""Gap sessionization: a pause longer than ``gap`` starts a new session.

Cutting time into slots as wide as the gap puts any two events of one slot in the
same session, so a (user, slot) pair needs only its first and last time. That
aggregate combines map-side, and a user has at most (time span / gap) slots however
many events they sent. The running session number is computed over slots, and the
labels go back to the events with a balanced join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import MICROS, epoch_micros, micros_to_ts
from pulsetrail.materialize import materialize
from pulsetrail.operators.skew import attach_by_key

SLOT = "_slot"
DEFAULT_GAP_S = 30 * 60


def slot_of(time_col: str, gap_s: int) -> Column:
    return F.floor(epoch_micros(F.col(time_col)) / F.lit(gap_s * MICROS))


def session_slots(
    events: DataFrame,
    gap_s: int = DEFAULT_GAP_S,
    user_col: str = "user_id",
    time_col: str = "timestamp_dt",
    carried: DataFrame | None = None,
) -> DataFrame:
    """One row per (user, slot) with its session number, id and row count.

    ``carried`` is the state that earlier, older batches left (``open_sessions``): numbers go
    on from there, and a first event within the gap continues the open session.
    """
    micros = epoch_micros(F.col(time_col))
    slots = (
        events.where(F.col(user_col).isNotNull() & F.col(time_col).isNotNull())
        .groupBy(user_col, slot_of(time_col, gap_s).alias(SLOT))
        .agg(
            F.min(micros).alias("_first"),
            F.max(micros).alias("_last"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    by_user = Window.partitionBy(user_col).orderBy(SLOT)
    before, number = F.lag("_last").over(by_user), F.lit(0)
    if carried is not None:
        earlier = carried.select(user_col, F.col("_last").alias("_open"), F.col("session_seq").alias("_number"))
        slots = slots.join(earlier, user_col, "left")
        before, number = F.coalesce(before, "_open"), F.coalesce("_number", F.lit(0))
    starts = F.when(F.col("_first") - before <= gap_s * MICROS, 0).otherwise(1)
    running = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        slots.withColumn("_starts", starts)
        .withColumn("session_seq", number + F.sum("_starts").over(running))
        .withColumn("session_id", F.concat_ws("-", user_col, "session_seq"))
        .select(user_col, SLOT, "_first", "_last", "_rows", "session_seq", "session_id")
    )


def open_sessions(
    slots: DataFrame, carried: DataFrame | None = None, user_col: str = "user_id"
) -> DataFrame:
    """State for the next batch: per user the last time and number of a session.

    One row per user ever seen. It is what ``session_slots`` takes as ``carried``; batches
    must come in order of time, as day partitions do.
    """
    state = slots.select(user_col, "_last", "session_seq")
    if carried is not None:
        state = state.unionByName(carried.select(user_col, "_last", "session_seq"))
    return state.groupBy(user_col).agg(
        F.max("_last").alias("_last"), F.max("session_seq").alias("session_seq")
    )


def sessionize(
    events: DataFrame,
    gap_s: int = DEFAULT_GAP_S,
    user_col: str = "user_id",
    time_col: str = "timestamp_dt",
    id_cols: Sequence[str] = ("event_id",),
    slots: DataFrame | None = None,
) -> DataFrame:
    """Label every event with ``session_seq`` and ``session_id``.

    ``slots`` may carry further per-user columns (see the canonical view), which
    then reach the events in the same join.
    """
    if slots is None:
        slots = materialize(session_slots(events, gap_s, user_col, time_col))
    labelled = attach_by_key(
        events.drop("session_seq", "session_id").withColumn(SLOT, slot_of(time_col, gap_s)),
        slots.drop("_first", "_last"),
        [user_col, SLOT],
        weight="_rows",
        spread_by=id_cols,
    )
    return labelled.drop(SLOT, "_rows")


def session_spans(slots: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Start, end and depth of each gap session, from the slots alone."""
    return slots.groupBy(user_col, "session_seq", "session_id").agg(
        micros_to_ts(F.min("_first")).alias("session_start"),
        micros_to_ts(F.max("_last")).alias("session_end"),
        F.sum("_rows").alias("session_depth"),
    )

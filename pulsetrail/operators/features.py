"""Per-user and per-session features, and the enriched event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import exact_sum, is_event
from pulsetrail.operators.skew import attach_by_key
from pulsetrail.schemas import SESSION_FEATURES, USER_FEATURES


def user_features(events: DataFrame) -> DataFrame:
    """Lifetime totals per user. Every aggregate combines before the shuffle."""
    measures = (
        exact_sum("revenue"),
        F.count(F.lit(1)),
        F.count_if(is_event("purchase")),
        F.avg("response_time_ms"),
        F.min("timestamp"),
        F.max("timestamp"),
    )
    return events.groupBy("user_id").agg(*[m.alias(n) for m, n in zip(measures, USER_FEATURES, strict=True)])


def session_features(events: DataFrame) -> DataFrame:
    """Depth, span, conversion and revenue per session."""
    measures = (
        F.count(F.lit(1)),
        F.min("timestamp"),
        F.max("timestamp"),
        F.coalesce(F.bool_or(is_event("purchase")), F.lit(False)).cast("int"),
        exact_sum("revenue"),
    )
    return events.groupBy("session_id").agg(
        *[m.alias(n) for m, n in zip(measures, SESSION_FEATURES, strict=True)]
    )


def enrich_events(
    events: DataFrame,
    users: DataFrame,
    sessions: DataFrame,
    id_cols: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Attach both feature tables to every event.

    Both joins use the counts the features already carry to spread hot keys.
    """
    with_user = attach_by_key(events, users, ["user_id"], "user_event_count", id_cols)
    return attach_by_key(with_user, sessions, ["session_id"], "session_depth", id_cols)

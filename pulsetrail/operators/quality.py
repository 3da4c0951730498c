"""Schema validation and data-quality rules for event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsetrail.functions.scalar import MONEY, present, rounded
from pulsetrail.schemas import ERROR_CODES, EVENT_TYPES, EVENTS, OK_CODE


def validate_schema(df: DataFrame, expected: StructType = EVENTS) -> DataFrame:
    """Missing, mistyped and unexpected columns; no rows when the schema fits."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    problems = [
        (name, kind, have.get(name), "missing" if name not in have else "type")
        for name, kind in want.items()
        if have.get(name) != kind
    ] + [(name, None, kind, "unexpected") for name, kind in have.items() if name not in want]
    return df.sparkSession.createDataFrame(
        problems, "column_name string, expected string, actual string, problem string"
    )


def _row_rules(event_types: Sequence[str], error_codes: Sequence[str]) -> dict[str, tuple]:
    """Rule name -> (columns it needs, condition that marks a bad row)."""
    kind, code = F.col("event_type"), F.col("error_code")
    rules: dict[str, tuple[tuple[str, ...], Column]] = {
        f"null_{name}": ((name,), F.col(name).isNull())
        for name in ("event_id", "user_id", "session_id", "event_type", "timestamp")
    }
    rules |= {
        f"unusable_{name}": ((name,), F.col(name).isNotNull() & F.col(name).try_cast(MONEY).isNull())
        for name in ("revenue",)
    }
    rules |= {
        "unknown_event_type": (("event_type",), ~kind.isin(*event_types)),
        "negative_price": (("price",), F.col("price") < 0),
        "negative_latency": (("response_time_ms",), F.col("response_time_ms") < 0),
        "revenue_without_purchase": (
            ("revenue", "event_type"),
            (F.col("revenue") != 0) & (kind != "purchase"),
        ),
        "error_without_code": (("error_code", "event_type"), (kind == "error") & (code == OK_CODE)),
        "code_without_error": (("error_code", "event_type"), (kind != "error") & (code != OK_CODE)),
        "unknown_error_code": (("error_code",), ~code.isin(OK_CODE, *error_codes)),
    }
    return rules


def quality_report(
    events: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    error_codes: Sequence[str] = ERROR_CODES,
) -> DataFrame:
    """Bad rows per rule: (rule, bad_rows, total_rows, bad_share).

    All row rules share one pass. Duplicates need an aggregate of their own; it
    reads the id column only. Rules whose columns are absent are left out.
    """
    rules = {
        name: bad
        for name, (needs, bad) in _row_rules(event_types, error_codes).items()
        if len(present(events, needs)) == len(needs)
    }
    counts = events.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(bad).alias(n) for n, bad in rules.items()]
    )
    if "event_id" in events.columns:
        per_id = events.where("event_id is not null").groupBy("event_id").count()
        repeats = per_id.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)))
        counts = counts.withColumn("duplicate_event_id", repeats.scalar())
        rules["duplicate_event_id"] = None
    return (
        counts.unpivot(["_total"], list(rules), "rule", "bad_rows")
        .withColumnRenamed("_total", "total_rows")
        .withColumn(
            "bad_share",
            rounded(F.coalesce(F.try_divide("bad_rows", "total_rows"), F.lit(0.0)), 6),
        )
    )

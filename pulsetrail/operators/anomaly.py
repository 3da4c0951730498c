"""Anomaly detectors on metric series, and the combined report.

A series is a set of rows with an order. ``series=()`` treats the whole table as one
series in the order given (hour, region, device for KPIs), so windows count rows, not
hours, and mix segments. ``series=("region", "device")`` runs one series per segment,
which is the better choice for new work.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import filled, fixed, literal_array, present, rounded
from pulsetrail.materialize import materialize
from pulsetrail.operators.decay import exponential_hits
from pulsetrail.operators.iforest import isolation_forest_detection
from pulsetrail.operators.ordering import RANK, global_rank, order_statistics, over_frame
from pulsetrail.schemas import ANOMALIES, METHODS, SEVERITIES

ORDER = ("hour_bucket", "region", "device")
MIN_ROWS = 3
TINY = 1e-6

# ---- Fixed values -------------------------------------------------------------
# Metrics of the combined report with their method and threshold, and the metrics
# of the multivariate detector.
METRIC_METHODS = {
    "error_rate": ("zscore", 2.5),
    "avg_response_ms": ("iqr", 2.0),
    "total_revenue": ("zscore", 3.0),
    "event_count": ("zscore", 3.0),
    "unique_users": ("zscore", 3.0),
}
FOREST_METRICS = ("error_rate", "avg_response_ms", "total_revenue", "event_count")


def classify_severity(deviation: Column) -> Column:
    """Severity label of an unrounded deviation."""
    size = F.abs(deviation)
    return (
        F.when(size >= 4.0, "critical")
        .when(size >= 3.0, "high")
        .when(size >= 2.5, "medium")
        .otherwise("low")
    )


def _severity_rank(severity: Column) -> Column:
    return F.array_position(literal_array(SEVERITIES), severity)


def _null_string() -> Column:
    return F.lit(None).cast("string")


def _finding(
    metric: str,
    value: Column,
    expected: Column,
    deviation: Column,
    method: str,
    severity_of: Column,
    description: Column,
    region: Column | None = None,
) -> Column:
    """One anomaly as a struct, without its timestamp."""
    return F.struct(
        F.lit(metric).alias("metric"),
        rounded(value, 4).alias("value"),
        rounded(expected, 4).alias("expected"),
        rounded(deviation, 3).alias("deviation"),
        F.lit(method).alias("method"),
        classify_severity(severity_of).alias("severity"),
        description.alias("description"),
        (_null_string() if region is None else region).alias("region"),
        _null_string().alias("device"),
    )


def _ordered(df: DataFrame, series: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rank the rows by series, then order, keeping only the columns needed."""
    keys = [*series, *[k for k in present(df, order) if k not in series]]
    wanted = dict.fromkeys([*keys, *keep])
    return global_rank(df.select(*wanted), keys)


def zscore_detection(
    df: DataFrame,
    metrics: Mapping[str, float] | str,
    threshold: float = 2.5,
    window: int = 24,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Rows far from the mean of the last ``window`` rows, themselves included.

    ``metrics`` is one name, or names with a threshold each; all of them share one
    ordering and one window pass. At least three rows and a non-zero spread are
    needed, and |z| cannot exceed (n-1)/sqrt(n).
    """
    limits = {metrics: threshold} if isinstance(metrics, str) else dict(metrics)
    region = F.col("region") if "region" in df.columns else None
    keep = [*limits, *present(df, ["region"])]
    filled_metrics = df.withColumns({name: filled(name) for name in limits})

    def stats(rows: DataFrame, over: WindowSpec) -> DataFrame:
        recent = over.rowsBetween(1 - window, Window.currentRow)
        enough = F.count(F.lit(1)).over(recent) >= MIN_ROWS
        return rows.withColumns(
            {
                **{f"_mean_{m}": F.when(enough, F.avg(m).over(recent)) for m in limits},
                **{f"_sd_{m}": F.when(enough, F.stddev_samp(m).over(recent)) for m in limits},
            }
        )

    scored = over_frame(
        _ordered(filled_metrics, series, order, keep), stats, window - 1, series=series
    )

    def candidate(metric: str, limit: float) -> Column:
        mean, sd = F.col(f"_mean_{metric}"), F.col(f"_sd_{metric}")
        z = F.when(sd >= TINY, (F.col(metric) - mean) / sd)
        text = F.format_string(
            f"{metric} deviated %sσ from rolling {window}h mean", fixed(z, 1)
        )
        found = _finding(metric, F.col(metric), mean, z, "zscore", z, text, region)
        return F.when(F.abs(z) >= limit, found)

    hits = F.array_compact(F.array(*[candidate(m, t) for m, t in limits.items()]))
    return scored.select(F.col(order[0]).alias("timestamp"), F.explode(hits).alias("_hit")).select(
        "timestamp", "_hit.*"
    )


def _literals(row: Row | None, names: Sequence[str]) -> list[Column]:
    """Fields of a summary row as double literals; null when there is no row."""
    return [F.lit(None if row is None else row[name]).cast("double") for name in names]


def iqr_detection(
    df: DataFrame, metric: str, multiplier: float = 2.0, order: Sequence[str] = ORDER
) -> DataFrame:
    """Rows outside the interquartile fences of the whole table."""
    time, *_ = present(df, order)
    rows = df.withColumn(metric, filled(metric)).select(time, metric)
    # Three numbers, used a dozen times below: as literals they stay out of the plan,
    # where a subquery would be copied to every place it is used.
    quartiles = order_statistics(rows, metric, (0.25, 0.5, 0.75)).first()
    q1, q2, q3 = _literals(quartiles, ("q0", "q1", "q2"))
    value, width = F.col(metric), q3 - q1
    low, high = q1 - multiplier * width, q3 + multiplier * width
    deviation = (value - q2) / (width + TINY)
    text = F.format_string(
        f"{metric}=%s outside IQR bounds [%s, %s]", *[fixed(v, 2) for v in (value, low, high)]
    )
    return (
        rows.where((value < low) | (value > high))
        .select(
            F.col(time).alias("timestamp"),
            _finding(metric, value, q2, deviation, "iqr", deviation, text).alias("_hit"),
        )
        .select("timestamp", "_hit.*")
    )


def ewma_detection(
    df: DataFrame,
    metric: str,
    span: int = 12,
    threshold: float = 1.8,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Rows far from an exponentially weighted mean that includes them.

    The weighted mean and deviation are an associative scan over chunks of the series
    (``operators.decay``). Nulls are skipped but still age the rows before
    them. Since a window includes its own row, |z| cannot exceed (1 - w) / sqrt(v) with
    the row's weight share w and the deviation's share v: 2.25 for a span of 12. Returns
    the order columns, the zero-based position in the series and the statistics.
    """
    keys = [*series, *[k for k in present(df, order) if k not in series]]
    typed = df.withColumn(metric, F.nullif(F.col(metric).cast("double"), F.lit(math.nan)))
    ranked = _ordered(typed, series, order, [metric])
    scored = exponential_hits(ranked, metric, 1.0 - 2.0 / (span + 1.0), threshold, TINY, series)
    first = ranked.groupBy(*series).agg(F.min(RANK).alias("_first"))
    if series:
        same = [F.col(f"s.{name}").eqNullSafe(F.col(f"f.{name}")) for name in series]
        placed = scored.alias("s").join(first.alias("f"), same).select("s.*", "f._first")
    else:
        placed = scored.withColumn("_first", first.scalar())
    return placed.select(
        *keys,
        (F.col(RANK) - F.col("_first")).alias("position"),
        F.col(metric).alias("value"),
        "ewma",
        "ewm_std",
        "z",
    )


def seasonal_residuals(
    df: DataFrame,
    metric: str,
    period: int = 24,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
    time_col: str = "hour_bucket",
) -> DataFrame:
    """Classical additive decomposition: trend, seasonal and remainder per row.

    Trend is the centred moving average over one period (half weight on both ends of
    an even one) and null where the frame is cut off. The season of a row is its
    hour of the day; its effect is the mean detrended value, centred per series.
    """
    half = period // 2

    def smooth(rows: DataFrame, over: WindowSpec) -> DataFrame:
        inner = half - 1 if period % 2 == 0 else half
        total = F.sum(metric).over(over.rowsBetween(-inner, inner))
        ends = F.lag(metric, half).over(over), F.lead(metric, half).over(over)
        if period % 2 == 0:
            total = total + (ends[0] + ends[1]) / 2
        cut_off = ends[0].isNull() | ends[1].isNull()
        return rows.withColumn("trend", F.when(~cut_off, total / period))

    rows = df.withColumn(metric, filled(metric))
    keep = dict.fromkeys([time_col, metric])
    trended = over_frame(
        _ordered(rows, series, order, list(keep)), smooth, half, half, series=series
    ).withColumn("_season", F.hour(time_col))
    # At most 24 rows per series.
    effect = (
        trended.groupBy(*series, "_season")
        .agg(F.avg(F.col(metric) - F.col("trend")).alias("_effect"))
        .withColumn(
            "seasonal", F.col("_effect") - F.avg("_effect").over(Window.partitionBy(*series))
        )
        .drop("_effect")
        .withColumnRenamed("_season", "_hour")
    )
    same = F.col("_season") == F.col("_hour")
    for name in series:
        effect = effect.withColumnRenamed(name, f"_s_{name}")
        same = same & F.col(name).eqNullSafe(F.col(f"_s_{name}"))
    if series:
        # Written, so that the planner knows its size: up to the broadcast limit no row of
        # the table is shuffled, and a series with many rows is no hot key.
        effect = materialize(effect)
    else:
        # One row per hour of the day, whatever the size of the table.
        effect = F.broadcast(effect)
    return (
        trended.join(effect, same, "left")
        .withColumn("remainder", F.col(metric) - F.col("trend") - F.col("seasonal"))
        .drop("_season", "_hour", RANK, *[f"_s_{name}" for name in series])
    )


def seasonal_detection(
    df: DataFrame,
    metric: str,
    threshold: float = 3.0,
    period: int = 24,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
    time_col: str = "hour_bucket",
) -> DataFrame:
    """Rows whose seasonal remainder lies ``threshold`` deviations from its mean."""
    parts = seasonal_residuals(df, metric, period, series, order, time_col)
    stats = parts.groupBy(*series).agg(
        F.avg("remainder").alias("_mean"), F.stddev_samp("remainder").alias("_sd")
    )
    if series:
        scored, mean, sd = parts.join(stats, list(series)), F.col("_mean"), F.col("_sd")
    else:
        scored, (mean, sd) = parts, _literals(stats.first(), ("_mean", "_sd"))
    z = F.when(sd >= TINY, (F.col("remainder") - mean) / sd)
    return scored.withColumn("z", z).where(F.abs("z") >= threshold).drop("_mean", "_sd")


def detect_all(
    hourly: DataFrame,
    region: str | None = None,
    series: Sequence[str] = (),
    methods: Sequence[str] = METHODS,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Findings of every detector over the KPI table (schema ``ANOMALIES``).

    Metrics the frame lacks are skipped; the forest needs at least two of its own.
    ``order`` must name every dimension of the table, so that windows are reproducible.
    """
    rows = hourly.where(F.col("region") == region) if region is not None else hourly
    found: list[DataFrame] = []
    have = {m: spec for m, spec in METRIC_METHODS.items() if m in rows.columns}
    by_z = {m: limit for m, (method, limit) in have.items() if method == "zscore"}
    if "zscore" in methods and by_z:
        found.append(zscore_detection(rows, by_z, series=series, order=order))
    if "iqr" in methods:
        found += [
            iqr_detection(rows, m, limit, order) for m, (method, limit) in have.items() if method == "iqr"
        ]
    features = present(rows, FOREST_METRICS)
    if "isolation_forest" in methods and len(features) >= 2:
        found.append(_forest_findings(rows, features, region, order))
    out = rows.sparkSession.createDataFrame([], ANOMALIES)
    for piece in found:
        out = out.unionByName(piece)
    return out


def _forest_findings(
    rows: DataFrame, features: list[str], region: str | None, order: Sequence[str]
) -> DataFrame:
    ids = present(rows, order)
    scored = isolation_forest_detection(rows.select(*ids, *features), features, id_cols=ids)
    score = F.col("anomaly_score")
    names = "[" + ", ".join(f"'{name}'" for name in features) + "]"
    hit = _finding(
        "multivariate",
        score,
        F.lit(0.0),
        -score,
        "isolation_forest",
        -score * 3,
        F.lit(f"Multivariate anomaly: simultaneous degradation in {names}"),
        F.lit(region).cast("string"),
    )
    return (
        scored.where("is_anomaly")
        .select(F.col(ids[0]).alias("timestamp"), hit.alias("_hit"))
        .select("timestamp", "_hit.*")
    )


_TIES = ["method", "metric", "timestamp", "region", "value"]


def top_anomalies(anomalies: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` worst findings: by severity, then by size of the deviation."""
    return anomalies.orderBy(
        _severity_rank(F.col("severity")),
        F.desc(F.abs("deviation")),
        *_TIES,
    ).limit(k)


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Findings per severity and per method, zeros included: (kind, name, count)."""
    names = {"severity": SEVERITIES, "method": METHODS}
    counts = anomalies.agg(
        *[
            F.count_if(F.col(kind) == name).alias(f"{kind}/{name}")
            for kind, values in names.items()
            for name in values
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(name).alias("name"),
                F.col(f"{kind}/{name}").alias("count"),
            )
            for kind, values in names.items()
            for name in values
        ]
    )
    return counts.select(F.explode(rows).alias("_row")).select("_row.*")


def anomaly_report(anomalies: DataFrame, k: int = 50) -> DataFrame:
    """The whole report as one nested row. Only the top ``k`` findings are gathered."""

    def count_of(kind: str, values: Sequence[str]) -> Column:
        return F.struct(*[F.count_if(F.col(kind) == v).alias(v) for v in values])

    fields = F.struct(
        _severity_rank(F.col("severity")).alias("_rank"),
        (-F.abs("deviation")).alias("_size"),
        F.struct(*_TIES).alias("_ties"),
        F.struct(*[F.col(name) for name in ANOMALIES.names]).alias("_finding"),
    )
    worst = top_anomalies(anomalies, k).agg(
        F.transform(F.sort_array(F.collect_list(fields)), lambda r: r["_finding"])
    )
    return anomalies.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        count_of("severity", SEVERITIES).alias("by_severity"),
        count_of("method", METHODS).alias("by_method"),
    ).withColumn("anomalies", worst.scalar())

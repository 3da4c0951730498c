"""Root-cause analysis: correlation, Granger tests, segment contribution, report."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import filled, fixed, literal_array, present, rounded
from pulsetrail.functions.tails import f_sf, f_tail
from pulsetrail.materialize import materialize
from pulsetrail.operators.comoments import AGE, Moments, lagged_moments, merged

ORDER = ("hour_bucket", "region", "device")
MAX_LAG = 3
ALPHA = 0.05
TINY = 1e-6
EPSILON = 1e-10
MIN_ROWS = 10
# A series that varies by less than this share of its level is constant.
FLAT = 1e-14
TOP_GRANGER = 3
TOP_CORRELATIONS = 5

# ---- Fixed values -------------------------------------------------------------
# Metrics the report looks at, and the wording of its findings.
CANDIDATES = (
    "error_rate",
    "avg_response_ms",
    "total_revenue",
    "event_count",
    "unique_users",
    "purchases",
    "p95_response_ms",
)
TIMEOUTS = (
    "Infrastructure degradation: high response times co-occur with errors "
    "→ possible timeout cascade"
)
TRAFFIC_DROP = "Traffic drop caused revenue decline — investigate upstream traffic source"
CHECKOUT = "Error spike blocking checkout flow — users unable to complete purchases"
ERROR_ACTIONS = (
    "Check service health dashboard for upstream dependencies",
    "Review recent deployments in the anomaly time window",
    "Scale up error-prone services if load-related",
)
LATENCY_ACTIONS = (
    "Check database query performance and connection pool saturation",
    "Review CDN cache hit rates",
    "Check for N+1 query patterns in recent code changes",
)
REVENUE_ACTIONS = (
    "Validate checkout flow end-to-end",
    "Check payment gateway success rates",
    "Review pricing engine for anomalous discounts",
)
ERROR_ACTION_LEVEL = 0.05


# ---- Correlation ----------------------------------------------------------------


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def correlate_pairs(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Pearson correlation of each target with its features, one aggregate for all.

    Rows (target, feature, pearson_r, p_value, significant, direction, strength,
    position): position 1 is the strongest by rounded |r|, ties in feature order.
    Constant features and undefined correlations are left out.
    """
    wanted = {t: [f for f in present(df, fs) if f != t] for t, fs in targets.items()}
    pairs = [(t, f) for t, fs in wanted.items() for f in fs]
    if not pairs:
        return df.sparkSession.createDataFrame([], _CORRELATION_SCHEMA)
    columns = list(dict.fromkeys(name for pair in pairs for name in pair))
    at = {name: i for i, name in enumerate(columns)}
    once = dict.fromkeys(tuple(sorted((at[t], at[f]))) for t, f in pairs)
    # SQL text instead of Column calls: 42 pairs make hundreds of expressions, and
    # each call from Python costs milliseconds.
    sums = df.select(*[filled(c).alias(f"x{i}") for c, i in at.items()]).selectExpr(
        "count(1) AS n",
        *[f"stddev_samp(x{i}) AS sd{i}" for i in at.values()],
        *[f"covar_samp(x{i}, x{j}) AS c{i}_{j}" for i, j in once],
    )

    def pair_row(target: str, feature: str) -> str:
        i, j = sorted((at[target], at[feature]))
        order = wanted[target].index(feature)
        # corr() itself raises on a constant column in ANSI mode.
        corr = f"try_divide(c{i}_{j}, sd{i} * sd{j})"
        return (
            f"named_struct('target', {_literal(target)}, "
            f"'feature', {_literal(feature)}, '_order', {order}, "
            f"'_r', CASE WHEN sd{at[feature]} >= {TINY} THEN {corr} END, '_n', n)"
        )

    rows = F.expr(f"explode(array({', '.join(pair_row(*pair) for pair in pairs)}))")
    r = F.col("_r")
    r_squared = r * r
    # |r| = 1 leaves no residual: F is infinite and its tail zero.
    statistic = F.when(r_squared >= 1.0 - 1e-15, F.lit(float("inf"))).otherwise(
        r_squared * (F.col("_n") - 2) / (1.0 - r_squared)
    )
    p = F.when(F.col("_n") <= 2, 1.0).otherwise(f_sf(statistic, F.lit(1), F.col("_n") - 2))
    ranking = Window.partitionBy("target").orderBy(F.desc(F.abs("pearson_r")), "_order")
    return (
        sums.select(rows.alias("_row"))
        .select("_row.*")
        .where(r.isNotNull())
        .withColumn("_p", p)
        .select(
            "target",
            "feature",
            rounded(r, 4).alias("pearson_r"),
            rounded("_p", 6).alias("p_value"),
            F.coalesce(F.col("_p") < ALPHA, F.lit(False)).alias("significant"),
            F.when(r > 0, "positive").otherwise("negative").alias("direction"),
            F.when(F.abs(r) > 0.7, "strong")
            .when(F.abs(r) > 0.4, "moderate")
            .otherwise("weak")
            .alias("strength"),
            "_order",
        )
        .withColumn("position", F.row_number().over(ranking))
        .drop("_order")
    )


_CORRELATION_SCHEMA = (
    "target string, feature string, pearson_r double, p_value double, significant boolean, "
    "direction string, strength string, position int"
)


def correlate_metrics(
    df: DataFrame, target: str, features: Sequence[str], k: int | None = None
) -> DataFrame:
    """Features ranked by correlation with ``target``; ``k`` keeps the strongest."""
    ranked = correlate_pairs(df, {target: features}).drop("target")
    return ranked if k is None else ranked.where(F.col("position") <= k)


# ---- Granger tests --------------------------------------------------------------

def nested_f_test(state: Moments, lag: int, rows: int, max_lag: int) -> tuple:
    """F test that the candidate's lags add nothing, from co-moments alone.

    ``state`` is of (y lags, x lags, y). Columns are scaled to unit length, which keeps
    the solve well conditioned for metrics of any size.
    """
    centred, den = state.products, state.n - (2 * lag + 1)
    if rows <= 3 * max_lag + 1 or den <= 0:
        allowed = int((rows - 1) / 3) - 1
        return None, den, None, f"Insufficient observations. Maximum allowable lag is {allowed}"
    lengths = np.sqrt(np.clip(np.diag(centred), 0.0, None))
    levels = np.sqrt(np.diag(centred) + state.n * state.mean**2)
    if (lengths <= FLAT * levels).any():
        return None, den, None, "a series is constant"
    unit = centred / np.outer(lengths, lengths)

    def residual(k: int) -> float:
        solution = np.linalg.solve(unit[:k, :k], unit[:k, -1])
        return max(1.0 - float(solution @ unit[:k, -1]), 0.0)

    if np.linalg.cond(unit[:-1, :-1]) > 1e12:
        return None, den, None, "the lagged series are collinear"
    restricted, full = residual(lag), residual(2 * lag)
    if full < 1e-13:
        return None, den, None, "perfect fit of the data"
    f = max(restricted - full, 0.0) / lag / (full / den)
    return f, den, f_tail(f, lag, den), None


_TESTS = "target string, candidate string, lag int, n long, f double, df_den long, p double, error string"


def _series_tests(metrics: list[str], pairs: list[tuple[str, str]], series: list[str], max_lag: int):
    """All tests of one series, from its states."""
    at = {name: i * (max_lag + 1) for i, name in enumerate(metrics)}

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([AGE, "n"], kind="stable")
        by_age: list[list[Moments]] = [[] for _ in range(max_lag + 1)]
        for age, n, mean, products in zip(frame[AGE], frame["n"], frame["mean"], frame["products"]):
            by_age[age].append(Moments(int(n), np.array(mean), np.array(products).reshape(len(mean), -1)))
        ages = [merged(states) for states in by_age]
        rows = sum(state.n for state in ages if state)
        found = []
        for lag in range(1, max_lag + 1):
            state = merged(s for s in ages[lag:] if s)
            if state is None:
                continue
            for target, candidate in pairs:
                y, x = at[target], at[candidate]
                keep = [*range(y + 1, y + lag + 1), *range(x + 1, x + lag + 1), y]
                part = Moments(state.n, state.mean[keep], state.products[np.ix_(keep, keep)])
                f, den, p, error = nested_f_test(part, lag, rows, max_lag)
                found.append((target, candidate, lag, rows, f, den, p, error))
        out = pd.DataFrame(found, columns=["target", "candidate", "lag", "n", "f", "df_den", "p", "error"])
        for place, name in enumerate(series):
            out.insert(place, name, [frame[name].iloc[0]] * len(out))
        return out

    return run


def granger_tests(
    df: DataFrame,
    metrics: Sequence[str],
    pairs: DataFrame,
    max_lag: int = MAX_LAG,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per (series, target, candidate, lag): F statistic, p-value, error.

    ``pairs`` has columns (target, candidate) with names out of ``metrics``; there
    are at most len(metrics)^2 of them. One pass sums the co-moments of all metrics and
    lags; every pair and lag is then solved from a part of that matrix.
    """
    metrics = list(metrics)
    listed = [(row["target"], row["candidate"]) for row in pairs.select("target", "candidate").collect()]
    states = lagged_moments(df, metrics, max_lag, series, order)
    keys = "".join(f"`{name}` {df.schema[name].dataType.simpleString()}, " for name in series)
    return states.groupBy(*series).applyInPandas(
        _series_tests(metrics, listed, list(series), max_lag), keys + _TESTS
    )


def granger_summary(tests: DataFrame, max_lag: int = MAX_LAG, series: Sequence[str] = ()) -> DataFrame:
    """Best lag per pair: the smallest p-value, the shorter lag on ties.

    Any failed lag fails the pair, with the reason in ``error``.
    """
    p = F.col("_best.p")
    causes = p < ALPHA
    text = F.when(
        causes,
        F.format_string(
            "%s Granger-causes %s with lag=%dh (p=%s)",
            "candidate",
            "target",
            F.col("_best.lag"),
            fixed(p, 4),
        ),
    ).otherwise(
        F.format_string("No significant Granger causality from %s to %s", "candidate", "target")
    )
    return (
        tests.groupBy(*series, "target", "candidate")
        .agg(
            F.min(F.struct(F.least("p", F.lit(1.0)).alias("p"), F.col("lag"))).alias("_best"),
            F.when(F.max("n") < MIN_ROWS, F.lit("Insufficient data"))
            .otherwise(F.min("error"))
            .alias("error"),
        )
        .select(
            *series,
            "target",
            "candidate",
            *[
                F.when(F.col("error").isNull(), value).alias(name)
                for name, value in {
                    "granger_causes": causes,
                    "best_lag": F.col("_best.lag"),
                    "p_value": rounded(p, 6),
                    "interpretation": text,
                }.items()
            ],
            "error",
        )
    )


def granger_causality(
    df: DataFrame,
    target: str,
    candidate: str,
    max_lag: int = MAX_LAG,
    series: Sequence[str] = (),
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Do past values of ``candidate`` help to predict ``target``? One row per series.

    Fewer than two rows have no lags and give no test row at all.
    """
    pairs = df.sparkSession.createDataFrame([(target, candidate)], "target string, candidate string")
    tests = granger_tests(df, [target, candidate], pairs, max_lag, series, order)
    return granger_summary(tests, max_lag, series)


# ---- Segment contribution ---------------------------------------------------------


def segment_changes(
    df: DataFrame,
    metrics: Sequence[str],
    start: str,
    end: str,
    dims: Sequence[str] = ("region", "device"),
    time_col: str = "hour_bucket",
) -> DataFrame:
    """Mean before and inside a window for every (metric, dimension, segment).

    The baseline is everything before ``start``; the window includes both ends; rows
    after it count for neither side. All dimensions and metrics share one aggregate.
    A side without rows counts as zero.
    """
    at = F.col(time_col)
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    side = F.when(at < first, "baseline").when((at >= first) & (at <= last), "anomaly")
    places = F.array(
        *[
            F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment"))
            for d in present(df, dims)
        ]
    )
    values = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("_value"))
            for m in metrics
        ]
    )
    means = (
        df.select(side.alias("_side"), places.alias("_places"), values.alias("_values"))
        .where(F.col("_side").isNotNull())
        .select("_side", F.explode("_places").alias("_place"), "_values")
        .select("_side", "_place.*", F.explode("_values").alias("_v"))
        .select("_side", "dimension", "segment", "_v.*")
        .where(F.col("segment").isNotNull())
        .groupBy("metric", "dimension", "segment")
        .agg(
            *[
                F.coalesce(
                    F.avg(F.when(F.col("_side") == name, F.col("_value"))), F.lit(0.0)
                ).alias(f"_{name}")
                for name in ("baseline", "anomaly")
            ]
        )
    )
    change = F.col("_anomaly") - F.col("_baseline")
    changes = means.select(
        "metric",
        "dimension",
        "segment",
        rounded("_baseline", 4).alias("baseline"),
        rounded("_anomaly", 4).alias("anomaly"),
        rounded(change / (F.col("_baseline") + EPSILON), 4).alias("pct_change"),
        rounded(change, 4).alias("abs_change"),
    )
    # One row per (metric, dimension): metrics and dimensions are lists of names.
    drivers = changes.groupBy("metric", "dimension").agg(
        F.min_by(
            F.struct("segment", "pct_change"), F.struct(-F.abs("pct_change"), F.col("segment"))
        ).alias("_driver")
    )
    return (
        changes.join(F.broadcast(drivers), ["metric", "dimension"])
        .withColumn("primary_driver", F.col("_driver.segment"))
        .withColumn("driver_change", F.col("_driver.pct_change"))
        .drop("_driver")
    )


def segment_anomaly(
    df: DataFrame,
    metric: str,
    start: str,
    end: str,
    dims: Sequence[str] = ("region", "device"),
    time_col: str = "hour_bucket",
) -> DataFrame:
    """Which segment of each dimension drives a change of ``metric``."""
    return segment_changes(df, [metric], start, end, dims, time_col).drop("metric")


# ---- Report -----------------------------------------------------------------------


def hypothesis(target: Column, feature: Column, direction: Column, r: Column) -> Column:
    """Sentence for one correlated feature; the specific rules come first."""
    return (
        F.when(
            (feature == "avg_response_ms") & (direction == "positive") & (target == "error_rate"),
            TIMEOUTS,
        )
        .when(
            (feature == "event_count")
            & (direction == "negative")
            & target.isin("total_revenue", "purchases"),
            TRAFFIC_DROP,
        )
        .when(
            (feature == "error_rate") & (direction == "negative") & (target == "total_revenue"),
            CHECKOUT,
        )
        .otherwise(
            F.format_string(
                "%s (%sly correlated, r=%s) may be contributing cause", feature, direction, fixed(r, 2)
            )
        )
    )


def recommended_actions(target: Column, value: Column) -> Column:
    return (
        F.when(
            (target == "error_rate") & (F.coalesce(value, F.lit(0.0)) > ERROR_ACTION_LEVEL),
            literal_array(ERROR_ACTIONS),
        )
        .when(target == "avg_response_ms", literal_array(LATENCY_ACTIONS))
        .when(target == "total_revenue", literal_array(REVENUE_ACTIONS))
        .otherwise(F.array().cast("array<string>"))
    )


def _by_position(columns: Sequence[str], limit: int, of: Column | None = None) -> Column:
    """The first ``limit`` entries of a group as an array in rank order."""
    entry = F.struct(*columns) if of is None else of
    pick = F.when(F.col("position") <= limit, F.struct("position", entry.alias("entry")))
    return F.transform(F.sort_array(F.collect_list(pick)), lambda e: e["entry"])


def _quoted_list(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def target_reports(
    hourly: DataFrame,
    targets: Sequence[str] = CANDIDATES,
    series: Sequence[str] = (),
    max_lag: int = MAX_LAG,
) -> DataFrame:
    """Correlations, Granger tests and hypotheses per target metric."""
    metrics = present(hourly, CANDIDATES)
    wanted = {t: metrics for t in present(hourly, targets)}
    columns = list(dict.fromkeys([*metrics, *wanted]))
    # A row per pair of metrics: stored, as three branches read it.
    correlations = materialize(correlate_pairs(hourly, wanted))
    leaders = correlations.where(F.col("position") <= TOP_GRANGER).select(
        "target", F.col("feature").alias("candidate"), "position"
    )
    tests = granger_tests(hourly, columns, leaders.drop("position"), max_lag, series)
    # With several series a candidate keeps its strongest one, so a report stays small.
    outcome = ["best_lag", "p_value", "interpretation", "error"]
    strongest = F.struct(F.coalesce(F.col("p_value"), F.lit(2.0)), "best_lag", "interpretation")
    granger = (
        granger_summary(tests, max_lag, series)
        .join(leaders, ["target", "candidate"])
        .groupBy("target", "candidate", "position")
        .agg(
            F.bool_or("granger_causes").alias("granger_causes"),
            F.min_by(F.struct(*series, *outcome), strongest).alias("_best"),
        )
        .select("target", "candidate", "position", "granger_causes", "_best.*")
    )
    by_target = granger.groupBy("target").agg(
        _by_position([*series, "candidate", "granger_causes", *outcome], TOP_GRANGER).alias(
            "granger_causality"
        ),
        F.transform(
            F.sort_array(
                F.collect_list(F.when(F.col("granger_causes"), F.struct("position", "candidate")))
            ),
            lambda e: e["candidate"],
        ).alias("leading_indicators"),
    )
    guess = hypothesis(*[F.col(c) for c in ("target", "feature", "direction", "pearson_r")])
    return (
        correlations.groupBy("target")
        .agg(
            _by_position(
                ["feature", "pearson_r", "p_value", "significant", "direction", "strength"],
                TOP_CORRELATIONS,
            ).alias("top_correlations"),
            _by_position([], TOP_GRANGER, guess).alias("hypotheses"),
        )
        .join(by_target, "target", "left")
    )


def rca_report(
    hourly: DataFrame,
    anomalies: DataFrame,
    series: Sequence[str] = (),
    max_lag: int = MAX_LAG,
    window: tuple[str, str] | None = None,
    dims: Sequence[str] = ("region", "device"),
    targets: Sequence[str] | None = None,
) -> DataFrame:
    """One report per anomaly (columns metric, timestamp, value at least).

    Correlations and tests depend on the metric only, so they run once per metric and
    join the anomalies. Without ``targets`` these are the metrics of the anomalies that
    the table has. ``window`` adds the driving segment per dimension. Anomalies of other
    metrics (the multivariate detector's) get a report without findings.
    """
    if targets is None:
        # Names of columns: there cannot be more of them than the table has.
        named = anomalies.where(F.col("metric").isin(*hourly.columns)).select("metric").distinct()
        targets = sorted(r.metric for r in named.collect())
    reports = target_reports(hourly, targets, series, max_lag)
    if window is not None:
        names = present(hourly, targets)
        drivers = (
            segment_changes(hourly, names, *window, dims=dims)
            .groupBy("metric", "dimension")
            .agg(F.first("primary_driver").alias("segment"), F.first("driver_change").alias("change"))
            .groupBy(F.col("metric").alias("target"))
            .agg(
                F.sort_array(F.collect_list(F.struct("dimension", "segment", "change"))).alias(
                    "segment_drivers"
                )
            )
        )
        reports = reports.join(drivers, "target", "left")
    none = F.array().cast("array<string>")
    extra = ["segment_drivers"] if window is not None else []
    given = F.struct(*[F.col(c) for c in anomalies.columns]).alias("anomaly")
    # At most one report row per metric name, so the broadcast has a fixed size.
    joined = anomalies.select(given, F.col("metric").alias("target")).join(
        F.broadcast(reports), "target", "left"
    )
    filled_lists = joined.withColumns(
        {name: F.coalesce(F.col(name), none) for name in ("leading_indicators", "hypotheses")}
    )
    features = F.transform(F.slice("top_correlations", 1, 2), lambda c: c["feature"])
    leading, guesses = F.col("leading_indicators"), F.col("hypotheses")
    top = F.when(F.size(features) > 0, _quoted_list(features)).otherwise("[]")
    summary = F.concat(
        F.format_string(
            "Anomaly detected in %s at %s. ", "target", F.col("anomaly.timestamp").cast("string")
        ),
        F.format_string("Top correlated metrics: %s. ", top),
        F.format_string(
            "Leading indicators: %s. ",
            F.when(F.size(leading) > 0, _quoted_list(leading)).otherwise("none found"),
        ),
        F.format_string(
            "Hypothesis: %s.", F.coalesce(F.get(guesses, F.lit(0)), F.lit("under investigation"))
        ),
    )
    return filled_lists.select(
        "anomaly",
        F.col("target").alias("target_metric"),
        "top_correlations",
        "granger_causality",
        "leading_indicators",
        "hypotheses",
        recommended_actions(F.col("target"), F.col("anomaly.value")).alias("recommended_actions"),
        F.when(F.size(leading) > 0, "high").otherwise("medium").alias("confidence"),
        summary.alias("summary"),
        *extra,
    )


# Workers need no installed copy of this package to run the test UDF.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""

The event table of every query is the canonical view of the test tables
(``pulsetrail.sources.canonical``); retention and RFM also run over ``orders``, whose
history is long enough for them to mean something.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from pulsetrail.functions.scalar import exact_sum, is_event, rounded  # noqa: E402
from pulsetrail.materialize import materialize, scratch_path  # noqa: E402
from pulsetrail.operators import anomaly, rca  # noqa: E402
from pulsetrail.operators.bitmaps import daily_bitmaps, number_users, users_by_period  # noqa: E402
from pulsetrail.operators.cohort import cohort_analysis  # noqa: E402
from pulsetrail.operators.experiment import ab_test_analysis, two_proportion_z  # noqa: E402
from pulsetrail.operators.features import (  # noqa: E402
    enrich_events,
    session_features,
    user_features,
)
from pulsetrail.operators.funnel import compute_funnel  # noqa: E402
from pulsetrail.operators.iforest import isolation_forest_detection  # noqa: E402
from pulsetrail.operators.kpis import (  # noqa: E402
    hourly_kpis,
    kpi_summary,
    kpi_timeseries,
    latest_points,
)
from pulsetrail.operators.quality import quality_report, validate_schema  # noqa: E402
from pulsetrail.operators.rfm import rfm_rollup, rfm_segmentation  # noqa: E402
from pulsetrail.operators.sessions import (  # noqa: E402
    open_sessions,
    session_slots,
    session_spans,
    sessionize,
)
from pulsetrail.operators.sketches import (  # noqa: E402
    hourly_sketches,
    latency_quantile,
    merge_sketches,
    unique_users,
)
from pulsetrail.plans.incremental import FeatureStore  # noqa: E402
from pulsetrail.plans.saved_queries import SAVED_QUERIES, run_saved_query  # noqa: E402
from pulsetrail.schemas import METHODS, SEVERITIES  # noqa: E402
from pulsetrail.session import prepare  # noqa: E402
from pulsetrail.sources import lake  # noqa: E402
from pulsetrail.sources.canonical import (  # noqa: E402
    GAP_S,
    STAGES,
    base_events,
    canonical_events,
    canonical_hourly,
    read_table,
)
from pulsetrail.sources.generate import dataset_profile, event_distribution  # noqa: E402
from pulsetrail.sources.layout import write_clustered  # noqa: E402

EVENT_TYPES = ("signup", "error", "click", "view", "purchase")
# A two-day window inside the thirty days of the test events.
WINDOW = ("2024-01-20 00:00:00", "2024-01-21 23:00:00")
BY_SEGMENT = ("region", "device")
DATA = "/root/testdata/sf0.001"


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({name: rounded(name, places) for name in doubles})


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    """The KPI table as the ETL leaves it: written once, then scanned."""
    return materialize(canonical_hourly(spark, sf))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(canonical_events(spark, sf))


def _events_without_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(base_events(spark, sf).select("event_id", "user_id", "timestamp_dt"))


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


# ---- events, features, sessions -------------------------------------------------


def user_features_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(user_features(base_events(spark, sf)))


def session_features_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(session_features(canonical_events(spark, sf)))


def enriched_events_q(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    users, sessions = materialize(user_features(events)), materialize(session_features(events))
    return _rounded(enrich_events(events, users, sessions).drop("k", "session_seq"))


def sessionize_q(spark: SparkSession, sf: str) -> DataFrame:
    return canonical_events(spark, sf).select("event_id", "user_id", "session_id", "session_seq")


def session_spans_q(spark: SparkSession, sf: str) -> DataFrame:
    return session_spans(session_slots(base_events(spark, sf), GAP_S))


def quality_q(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(base_events(spark, sf), EVENT_TYPES)


def profile_q(spark: SparkSession, sf: str) -> DataFrame:
    profile = dataset_profile(_events(spark, sf), EVENT_TYPES)
    entries = F.transform(
        F.array_sort(F.map_entries("event_distribution")),
        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
    )
    profile = profile.withColumn("event_distribution", F.array_join(entries, ","))
    return _rounded(profile)


def event_distribution_q(spark: SparkSession, sf: str) -> DataFrame:
    return event_distribution(base_events(spark, sf))


def sessionize_batches_q(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of ten days, each with the sessions that the one before left open."""
    events = _events_without_sessions(spark, sf)
    labelled, carried = [], None
    for number in range(4):
        batch = events.where(F.floor((F.dayofyear("timestamp_dt") - 1) / 10) == number)
        slots = materialize(session_slots(batch, GAP_S, carried=carried))
        labelled.append(sessionize(batch, GAP_S, slots=slots))
        carried = materialize(open_sessions(slots, carried))
    whole = labelled[0]
    for part in labelled[1:]:
        whole = whole.unionByName(part)
    return whole.select("event_id", "user_id", "session_id", "session_seq")


def _store(spark: SparkSession, sf: str) -> FeatureStore:
    """A first load, two days one by one, and one of them again."""
    events = _events(spark, sf).withColumn("dt", F.to_date("timestamp_dt"))
    lake.replace_partitions(events, path := _scratch(spark, "days"))
    stored = lake.read_table(spark, path)
    days = [str(row["dt"]) for row in stored.select("dt").distinct().orderBy("dt").collect()]
    store = FeatureStore(spark, _scratch(spark, "features"))
    for batch in (days[:-2], days[-2:-1], days[-1:], days[-2:]):
        store.add(stored, batch)
    return store


def incremental_users_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_store(spark, sf).user_features())


def incremental_sessions_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_store(spark, sf).session_features())


# ---- KPIs and saved queries -------------------------------------------------------


def _sketches(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly states, as a table."""
    return materialize(hourly_sketches(canonical_events(spark, sf)))


def daily_latency_q(spark: SparkSession, sf: str) -> DataFrame:
    """Daily p95 from merged states, next to the mean of the hourly ones."""
    hourly = _sketches(spark, sf).withColumn("p95", latency_quantile(0.95))
    day = F.to_date("hour_bucket").alias("day")
    means = hourly.groupBy(day, "region").agg(rounded(F.avg("p95"), 6).alias("mean_of_p95"))
    merged = merge_sketches(hourly, day, "region").select(
        "day", "region", "event_count", latency_quantile(0.95).alias("p95"), latency_quantile(0.5).alias("median")
    )
    return merged.join(means, ["day", "region"])


def daily_unique_users_q(spark: SparkSession, sf: str) -> DataFrame:
    """Users per day from merged states, next to the sum of hourly counts."""
    hourly = _sketches(spark, sf).withColumn("users", unique_users())
    day = F.to_date("hour_bucket").alias("day")
    summed = hourly.groupBy(day).agg(F.sum("users").alias("summed_users"))
    merged = merge_sketches(hourly, day).select("day", unique_users().alias("unique_users"))
    return merged.join(summed, "day")


def users_by_period_q(spark: SparkSession, sf: str) -> DataFrame:
    """Exact users per day, week and month from one stored table of bitmaps."""
    events = base_events(spark, sf)
    bitmaps = materialize(daily_bitmaps(events, materialize(number_users(events))))
    whole = users_by_period(bitmaps, "day")
    for period in ("week", "month"):
        whole = whole.unionByName(users_by_period(bitmaps, period))
    return whole


def hourly_kpi_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(canonical_hourly(spark, sf))


def hourly_kpi_events_q(spark: SparkSession, sf: str) -> DataFrame:
    """The same table by the operator of the batch job, from labelled events."""
    return _rounded(hourly_kpis(_events(spark, sf)))


def hourly_kpi_exact_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(hourly_kpis(_events(spark, sf), exact_p95=True))


def hourly_kpi_short_gap_q(spark: SparkSession, sf: str) -> DataFrame:
    """With a pause of five minutes, users have several sessions in an hour."""
    return _rounded(canonical_hourly(spark, sf, 300))


def schema_report_q(spark: SparkSession, sf: str) -> DataFrame:
    return validate_schema(read_table(spark, sf, "events"))


def hourly_csv_q(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "hourly-csv")
    lake.write_hourly_csv(canonical_hourly(spark, sf), path)
    return _rounded(lake.read_hourly_csv(spark, path))


def kpi_summary_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(kpi_summary(canonical_hourly(spark, sf)))


def timeseries_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(kpi_timeseries(canonical_hourly(spark, sf)))


def latest_points_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(latest_points(kpi_timeseries(canonical_hourly(spark, sf))))


def _saved(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        # Only the revenue by region needs the region join.
        events = canonical_events if name == "raw_daily_revenue" else base_events
        source = {"hourly": canonical_hourly, "events": events}
        tables = {t: source[t](spark, sf) for t in SAVED_QUERIES[name][1]}
        return _rounded(run_saved_query(spark, name, tables, STAGES))

    return run


# ---- customers --------------------------------------------------------------------


def funnel_overall_q(spark: SparkSession, sf: str) -> DataFrame:
    return compute_funnel(canonical_events(spark, sf), None, STAGES, "session_id")


def funnel_by_segment_q(spark: SparkSession, sf: str) -> DataFrame:
    events = canonical_events(spark, sf).withColumn("day", F.to_date("timestamp_dt"))
    return compute_funnel(events, ["region", "day"], STAGES)


def cohort_weekly_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_analysis(base_events(spark, sf), "week")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders")


def cohort_retention_q(spark: SparkSession, sf: str) -> DataFrame:
    return cohort_analysis(_orders(spark, sf), "month", "o_custkey", "o_orderdate")


def _order_rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rfm_segmentation(
        _orders(spark, sf),
        purchases_only=False,
        user_col="o_custkey",
        time_col="o_orderdate",
        id_col="o_orderkey",
        amount_col="o_totalprice",
    )


def rfm_users_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_order_rfm(spark, sf))


def rfm_events_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(rfm_segmentation(base_events(spark, sf)))


def rfm_rollup_q(spark: SparkSession, sf: str) -> DataFrame:
    return rfm_rollup(_order_rfm(spark, sf))


def _variants(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("user_id") % 2 == 0
    return base_events(spark, sf).select(
        F.when(even, "control").otherwise("treatment").alias("variant"),
        F.col("price").alias("value"),
        is_event("purchase").cast("int").alias("converted"),
    )


def ab_test_q(spark: SparkSession, sf: str) -> DataFrame:
    return ab_test_analysis(_variants(spark, sf), metric_name="value")


def two_proportion_q(spark: SparkSession, sf: str) -> DataFrame:
    return two_proportion_z(_variants(spark, sf), success_col="converted")


# ---- anomalies ----------------------------------------------------------------------


def zscore_q(spark: SparkSession, sf: str) -> DataFrame:
    limits = {m: t for m, (method, t) in anomaly.METRIC_METHODS.items() if method == "zscore"}
    return anomaly.zscore_detection(canonical_hourly(spark, sf), limits).drop("device")


def zscore_by_series_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = canonical_hourly(spark, sf)
    return anomaly.zscore_detection(hourly, "event_count", series=BY_SEGMENT).drop("device")


def iqr_q(spark: SparkSession, sf: str) -> DataFrame:
    found = anomaly.iqr_detection(_hourly(spark, sf), "avg_response_ms")
    return found.drop("region", "device")


def ewma_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = canonical_hourly(spark, sf)
    return _rounded(anomaly.ewma_detection(hourly, "avg_response_ms", threshold=1.8))


def ewma_by_series_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = canonical_hourly(spark, sf)
    found = anomaly.ewma_detection(hourly, "event_count", threshold=1.5, series=BY_SEGMENT)
    return _rounded(found.withColumn("value", F.col("value").cast("double")))


def seasonal_residual_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(anomaly.seasonal_residuals(canonical_hourly(spark, sf), "event_count"))


def seasonal_anomalies_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(anomaly.seasonal_detection(canonical_hourly(spark, sf), "event_count"))


def _univariate(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.detect_all(_hourly(spark, sf), methods=("zscore", "iqr"))


def anomaly_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.anomaly_counts(_univariate(spark, sf))


def top_anomalies_q(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.top_anomalies(_univariate(spark, sf)).drop("device")


def isolation_forest_q(spark: SparkSession, sf: str) -> DataFrame:
    return isolation_forest_detection(_hourly(spark, sf), anomaly.FOREST_METRICS)


def detect_all_q(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.detect_all(_hourly(spark, sf))


def detect_region_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = _hourly(spark, sf)
    return anomaly.detect_all(hourly, region="ASIA", methods=("zscore", "iqr")).drop("device")


PLANTED = 5


def _with_planted(hourly: DataFrame) -> DataFrame:
    """The KPI table and a few hours later on that no forest may overlook."""
    wild = {"error_rate": 0.9, "avg_response_ms": 1e6, "total_revenue": 1e9, "event_count": 10_000_000}
    ends = hourly.select(F.max("hour_bucket").alias("last")).crossJoin(
        hourly.sparkSession.range(1, PLANTED + 1).select(F.col("id").alias("later"))
    )
    planted = ends.select(
        (F.col("last") + F.make_dt_interval(hours=F.col("later"))).alias("hour_bucket"),
        F.lit("PLANTED").alias("region"),
        F.lit("device").alias("device"),
        *[(F.lit(v) * (1 + F.col("later") / 100)).cast(hourly.schema[c].dataType).alias(c) for c, v in wild.items()],
    )
    return hourly.unionByName(planted, allowMissingColumns=True)


def detect_gaps_q(spark: SparkSession, sf: str) -> DataFrame:
    """The KPI table with nulls, NaN and a metric that is not there."""
    hour = F.hour("hour_bucket")
    gaps = (
        _hourly(spark, sf)
        .withColumn("error_rate", F.when(hour % 7 != 3, F.when(hour % 5 == 0, F.lit(float("nan"))).otherwise(F.col("error_rate"))))
        .withColumn("avg_response_ms", F.when(hour % 6 != 1, F.col("avg_response_ms")))
        .drop("unique_users")
    )
    return anomaly.detect_all(materialize(gaps), methods=("zscore", "iqr")).drop("device")


def isolation_forest_checks_q(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the forest's scores, whatever the random numbers.

    Planted rows must have the worst scores, and scores must differ enough that the cut
    flags at least half of its share.
    """
    table = materialize(_with_planted(_hourly(spark, sf)))
    scored = materialize(isolation_forest_detection(table, anomaly.FOREST_METRICS))
    score, flagged, planted = F.col("anomaly_score"), F.col("is_anomaly"), F.col("region") == "PLANTED"
    limit = F.ceil(0.03 * (F.count(F.lit(1)) - 1))
    worst_kept = F.min(F.when(~flagged, score))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(flagged) <= limit).alias("share_fits"),
        (F.count_if(flagged) * 2 >= limit).alias("enough_flagged"),
        F.bool_and((F.col("anomaly_label") == -1) == flagged).alias("labels_fit"),
        (F.min(score) >= -1).alias("low_fits"),
        (F.max(score) < 0).alias("high_fits"),
        (F.coalesce(F.max(F.when(flagged, score)), F.lit(-1.0)) <= worst_kept).alias("order_fits"),
        F.count_if(planted & flagged).alias("planted_flagged"),
        (F.max(F.when(planted, score)) < F.min(F.when(~planted, score))).alias("planted_first"),
    )


def detect_all_checks_q(spark: SparkSession, sf: str) -> DataFrame:
    """The full report over the table with planted rows: exact rows of two methods.

    Of the forest's findings, the hours of the planted rows are there and the share is.
    """
    hourly = _hourly(spark, sf)
    found = materialize(anomaly.detect_all(materialize(_with_planted(hourly)), methods=("isolation_forest",)))
    last = hourly.agg(F.max("hour_bucket")).scalar()
    rows = hourly.agg(F.count(F.lit(1))).scalar() + PLANTED
    forest = found.agg(
        F.count_if(F.col("timestamp") > last).alias("planted_found"),
        ((F.count(F.lit(1)) * 2 >= F.ceil(0.03 * (rows - 1))) & (F.count(F.lit(1)) <= F.ceil(0.03 * (rows - 1)))).alias(
            "forest_share_fits"
        ),
        F.bool_and(F.abs(F.col("deviation") + F.col("value")) <= 0.00056).alias("forest_deviations_fit"),
    )
    exact = anomaly.detect_all(hourly, methods=("zscore", "iqr")).drop("device")
    return exact.withColumn("_forest", forest.select(F.struct("*")).scalar()).select(*exact.columns, "_forest.*")


def anomaly_report_q(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly.anomaly_report(materialize(anomaly.detect_all(_hourly(spark, sf))))


def anomaly_report_flat_q(spark: SparkSession, sf: str) -> DataFrame:
    """The nested report of the two exact methods, written, read, one row per listed finding."""
    report = anomaly.anomaly_report(_univariate(spark, sf))
    path = lake.write_report(report, _scratch(spark, "report"))
    return spark.read.schema(report.schema).json(path).select(
        "total_anomalies",
        *[F.col(f"by_severity.{name}").alias(f"severity_{name}") for name in SEVERITIES],
        *[F.col(f"by_method.{name}").alias(f"method_{name}") for name in METHODS],
        F.posexplode("anomalies").alias("place", "finding"),
    ).select("*", "finding.*").drop("finding", "device")


# ---- root causes ----------------------------------------------------------------------


def correlate_q(spark: SparkSession, sf: str) -> DataFrame:
    return rca.correlate_metrics(canonical_hourly(spark, sf), "error_rate", rca.CANDIDATES)


def _granger_pairs(spark: SparkSession, hourly: DataFrame) -> DataFrame:
    pairs = spark.createDataFrame(oracle.GRANGER_PAIRS, "target string, candidate string")
    return rca.granger_tests(hourly, oracle.GRANGER_METRICS, pairs)


def granger_tests_q(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_granger_pairs(spark, _hourly(spark, sf)))


def granger_q(spark: SparkSession, sf: str) -> DataFrame:
    return rca.granger_summary(_granger_pairs(spark, _hourly(spark, sf)))


def segment_anomaly_q(spark: SparkSession, sf: str) -> DataFrame:
    return rca.segment_anomaly(canonical_hourly(spark, sf), "error_rate", *WINDOW)


def segment_by_category_q(spark: SparkSession, sf: str) -> DataFrame:
    dims = ("region", "device", "category")
    hourly = hourly_kpis(_events(spark, sf), dims)
    return rca.segment_anomaly(hourly, "total_revenue", *WINDOW, dims=dims)


def rca_hypotheses_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = canonical_hourly(spark, sf)
    ranked = rca.correlate_pairs(hourly, {t: rca.CANDIDATES for t in rca.CANDIDATES})
    args = [F.col(c) for c in ("target", "feature", "direction", "pearson_r")]
    return ranked.where(F.col("position") <= rca.TOP_GRANGER).select(
        "target", "position", "feature", rca.hypothesis(*args).alias("hypothesis")
    )


def rca_findings_q(spark: SparkSession, sf: str) -> DataFrame:
    """The report of two metrics' worst anomalies, its lists joined to text."""
    hourly = _hourly(spark, sf)
    found = anomaly.detect_all(hourly, methods=("zscore", "iqr"))
    worst = anomaly.top_anomalies(found.where(F.col("metric").isin(*oracle.RCA_TARGETS)), 15)
    report = rca.rca_report(hourly, materialize(worst), max_lag=1, window=WINDOW)
    names = F.transform("top_correlations", lambda c: c["feature"])
    drivers = F.transform("segment_drivers", lambda d: F.concat_ws(":", d["dimension"], d["segment"]))
    return report.select(
        "anomaly.metric",
        "anomaly.timestamp",
        "anomaly.value",
        "target_metric",
        F.array_join(names, ",").alias("correlated"),
        F.array_join("leading_indicators", ",").alias("leaders"),
        F.array_join("hypotheses", "|").alias("hypotheses"),
        F.array_join("recommended_actions", "|").alias("actions"),
        F.array_join(drivers, ",").alias("drivers"),
        "confidence",
        "summary",
    )


def rca_report_q(spark: SparkSession, sf: str) -> DataFrame:
    hourly = _hourly(spark, sf)
    worst = anomaly.top_anomalies(anomaly.detect_all(hourly, methods=("zscore", "iqr")), 15)
    return rca.rca_report(hourly, worst, window=WINDOW)


# ---- lake and generator -------------------------------------------------------------


def event_partitions_q(spark: SparkSession, sf: str) -> DataFrame:
    """Write region/dt partitions, replace the later ones, read the layout back."""
    path = _scratch(spark, "partitions")
    events = _events(spark, sf).withColumn("dt", F.to_date("timestamp_dt"))
    lake.replace_partitions(events, path)
    later = events.where((F.col("dt") >= "2024-01-15") & is_event("purchase"))
    lake.replace_partitions(later, path)
    stored = lake.read_table(spark, path)
    return stored.groupBy("region", "dt").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(is_event("purchase")).alias("purchases")
    )


def stored_events_q(spark: SparkSession, sf: str) -> DataFrame:
    """Events as another writer leaves them, by region and in other widths, read back."""
    path = _scratch(spark, "stored")
    events = _events(spark, sf)
    narrow = events.withColumns(
        {
            "event_id": F.col("event_id").cast("string"),
            "user_id": F.col("user_id").cast("string"),
            "response_time_ms": F.col("response_time_ms").cast("int"),
            "hour": F.col("hour").cast("tinyint"),
        }
    ).drop("timestamp_dt", "k", "session_seq")
    lake.write_events_by_region(narrow, path)
    stored = lake.read_events(spark, path)
    return _rounded(
        stored.groupBy("region", "event_type").agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.count_distinct("session_id").alias("sessions"),
            F.min("timestamp_dt").alias("first"),
            F.max("timestamp_dt").alias("last"),
            F.sum("response_time_ms").alias("latency"),
            F.sum("hour").alias("hours"),
            exact_sum("revenue").alias("revenue"),
        )
    )


def clustered_slice_q(spark: SparkSession, sf: str) -> DataFrame:
    """Events written along a curve of (hour, region, user); two days of a region read back."""
    path = _scratch(spark, "clustered")
    hour = F.floor(F.col("timestamp") / 3600).alias("epoch_hour")
    events = _events(spark, sf).select(hour, "region", "user_id", "event_type", "revenue")
    write_clustered(materialize(events), path, ["epoch_hour", "region", "user_id"])
    first = F.floor(F.unix_timestamp(F.lit(WINDOW[0]).cast("timestamp")) / 3600)
    stored = lake.read_table(spark, path)
    return _rounded(
        stored.where((F.col("region") == "ASIA") & F.col("epoch_hour").between(first, first + 47))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("events"), exact_sum("revenue").alias("revenue"))
    )


def enriched_layout_q(spark: SparkSession, sf: str) -> DataFrame:
    """Write enriched events by region/device, read each directory back."""
    path = _scratch(spark, "enriched")
    events = _events(spark, sf)
    users, sessions = materialize(user_features(events)), materialize(session_features(events))
    lake.write_enriched(enrich_events(events, users, sessions), path)
    stored = lake.read_table(spark, path)
    return stored.groupBy(*BY_SEGMENT).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("session_id").alias("sessions"),
        F.sum("user_event_count").alias("user_events"),
        F.count_if(F.col("converted") == 1).alias("converted"),
    )


def table_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    return lake.table_stats({name: read_table(spark, sf, name) for name in oracle.TABLES})


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "user_features": user_features_q,
    "session_features": session_features_q,
    "enriched_events": enriched_events_q,
    "sessionize_gap": sessionize_q,
    "session_spans": session_spans_q,
    "dq_report": quality_q,
    "dataset_profile": profile_q,
    "event_distribution": event_distribution_q,
    "sessionize_batches": sessionize_batches_q,
    "incremental_users": incremental_users_q,
    "incremental_sessions": incremental_sessions_q,
    "daily_latency": daily_latency_q,
    "daily_unique_users": daily_unique_users_q,
    "users_by_period": users_by_period_q,
    "hourly_kpi": hourly_kpi_q,
    "hourly_kpi_events": hourly_kpi_events_q,
    "hourly_kpi_exact": hourly_kpi_exact_q,
    "hourly_kpi_short_gap": hourly_kpi_short_gap_q,
    "schema_report": schema_report_q,
    "hourly_csv": hourly_csv_q,
    "kpi_summary": kpi_summary_q,
    "timeseries_168h": timeseries_q,
    "latest_points": latest_points_q,
    **{name: _saved(name) for name in SAVED_QUERIES},
    "funnel_overall": funnel_overall_q,
    "funnel_by_segment": funnel_by_segment_q,
    "cohort_retention": cohort_retention_q,
    "cohort_weekly": cohort_weekly_q,
    "rfm_users": rfm_users_q,
    "rfm_events": rfm_events_q,
    "rfm_rollup": rfm_rollup_q,
    "ab_test": ab_test_q,
    "two_proportion_z": two_proportion_q,
    "zscore": zscore_q,
    "zscore_by_series": zscore_by_series_q,
    "iqr": iqr_q,
    "ewma": ewma_q,
    "ewma_by_series": ewma_by_series_q,
    "seasonal_residual": seasonal_residual_q,
    "seasonal_anomalies": seasonal_anomalies_q,
    "anomaly_counts": anomaly_counts_q,
    "top_anomalies": top_anomalies_q,
    "isolation_forest": isolation_forest_q,
    "detect_all": detect_all_q,
    "detect_region": detect_region_q,
    "detect_gaps": detect_gaps_q,
    "detect_all_checks": detect_all_checks_q,
    "isolation_forest_checks": isolation_forest_checks_q,
    "anomaly_report": anomaly_report_q,
    "anomaly_report_flat": anomaly_report_flat_q,
    "correlate_metrics": correlate_q,
    "granger_tests": granger_tests_q,
    "granger": granger_q,
    "segment_anomaly": segment_anomaly_q,
    "segment_by_category": segment_by_category_q,
    "rca_hypotheses": rca_hypotheses_q,
    "rca_findings": rca_findings_q,
    "rca_report": rca_report_q,
    "event_partitions": event_partitions_q,
    "enriched_layout": enriched_layout_q,
    "stored_events": stored_events_q,
    "clustered_slice": clustered_slice_q,
    "table_stats": table_stats_q,
}


# The text operators and their pipeline can be left out of an installation.
try:
    import corpus_pipeline
    from pulsetrail.llm import oracles as llm_oracles
    from pulsetrail.llm import queries as llm_queries
except ImportError:
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
    _LLM_SQL = dict(llm_oracles.SQL)
    if corpus_pipeline.ORACLE_SQL:
        _LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def _prepared(
    query: Callable[[SparkSession, str], DataFrame],
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), str(sf_dir).rstrip("/"))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Hourly KPIs per region and device."""
    return _prepared(hourly_kpi_q)(spark, DATA)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(query) for name, query in {**_QUERIES, **_LLM_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracle.oracle_sql(), **_LLM_SQL}

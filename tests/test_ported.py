"""The behaviours the analytics are known for, on the standard frames."""

import pytest
from frames import SPIKE, event_frame, hourly_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.operators import anomaly, rca
from pulsetrail.operators.experiment import ab_test_analysis
from pulsetrail.operators.funnel import compute_funnel
from pulsetrail.operators.iforest import isolation_forest_detection
from pulsetrail.operators.rfm import rfm_segmentation
from pulsetrail.schemas import FUNNEL_STAGES, RFM_SEGMENTS


@pytest.fixture(scope="module")
def hourly(spark):
    return to_spark(spark, hourly_frame()).cache()


@pytest.fixture(scope="module")
def events(spark):
    return to_spark(spark, event_frame()).cache()


def test_zscore_finds_the_spike(hourly):
    found = anomaly.zscore_detection(hourly, "error_rate", threshold=2.0).collect()
    assert [r for r in found if r.value > 0.1 and r.severity == "critical"]


def test_iqr_finds_the_slow_hour(hourly):
    found = anomaly.iqr_detection(hourly, "avg_response_ms", 1.5).collect()
    assert SPIKE["avg_response_ms"] in {r.value for r in found}


def test_forest_ranks_the_spike_first(hourly):
    features = ["error_rate", "avg_response_ms", "total_revenue"]
    scored = isolation_forest_detection(hourly, features).collect()
    worst = min(scored, key=lambda r: r.anomaly_score)
    assert worst.error_rate == SPIKE["error_rate"] and worst.is_anomaly and worst.anomaly_label == -1
    assert 1 <= sum(r.is_anomaly for r in scored) <= 5


@pytest.mark.parametrize(
    ("deviation", "label"),
    [(4.5, "critical"), (-4.0, "critical"), (3.2, "high"), (2.7, "medium"), (1.5, "low")],
)
def test_severity(spark, deviation, label):
    assert spark.range(1).select(anomaly.classify_severity(F.lit(deviation))).first()[0] == label


def test_detect_all_report(hourly):
    report = anomaly.anomaly_report(anomaly.detect_all(hourly)).first()
    assert report.total_anomalies == sum(report.by_severity) == sum(report.by_method)
    assert report.anomalies and report.anomalies[0].severity == "critical"
    sizes = [abs(a.deviation) for a in report.anomalies if a.severity == "critical"]
    assert sizes == sorted(sizes, reverse=True)


def test_funnel(events):
    rows = compute_funnel(events).orderBy("stage_index").collect()
    assert [r.stage for r in rows] == list(FUNNEL_STAGES)
    assert rows[0].conversion_from_top == 1.0 and rows[0].dropoff_rate == 0.0
    assert all(0 <= r.conversion_from_top <= 1.1 for r in rows)


def test_rfm(events):
    rows = rfm_segmentation(events).collect()
    assert {r.segment for r in rows} <= set(RFM_SEGMENTS)
    assert all(r.rfm_score == r.r_score + r.f_score + r.m_score for r in rows)


def test_ab(spark):
    samples = spark.createDataFrame(
        [("control", float(i < 100)) for i in range(1000)]
        + [("treatment", float(i < 130)) for i in range(1000)],
        "variant string, value double",
    )
    row = ab_test_analysis(samples).first()
    assert (row.control_mean, row.treatment_mean, row.lift) == (0.1, 0.13, 0.3)
    # t = -2.1027 on 1998 degrees of freedom
    assert row.p_value == pytest.approx(0.035616, abs=2e-4)
    assert row.significant and row.recommendation == "Ship treatment"


def test_correlations(hourly):
    rows = rca.correlate_metrics(
        hourly, "error_rate", ["avg_response_ms", "total_revenue", "event_count"]
    ).collect()
    assert rows[0].feature == "avg_response_ms" and rows[0].strength == "strong"
    assert all(-1 <= r.pearson_r <= 1 and 0 <= r.p_value <= 1 for r in rows)


def test_rca_report(spark, hourly):
    anomalies = spark.sql(
        "SELECT 'error_rate' AS metric, TIMESTAMP_NTZ'2024-01-03 02:00:00' AS timestamp, "
        "0.35D AS value, 'critical' AS severity UNION ALL "
        "SELECT 'multivariate', TIMESTAMP_NTZ'2024-01-03 02:00:00', -0.7D, 'low'"
    )
    window = ("2024-01-03 00:00:00", "2024-01-03 04:00:00")
    rows = {r.target_metric: r for r in rca.rca_report(hourly, anomalies, window=window).collect()}
    report = rows["error_rate"]
    assert report.hypotheses[0] == rca.TIMEOUTS and len(report.hypotheses) == 3
    assert report.recommended_actions == list(rca.ERROR_ACTIONS)
    assert report.top_correlations[0].feature == "avg_response_ms"
    assert len(report.top_correlations) == 5 and len(report.granger_causality) == 3
    assert (report.confidence == "high") == bool(report.leading_indicators)
    assert report.summary.startswith("Anomaly detected in error_rate at 2024-01-03 02:00:00. Top")
    assert {d.dimension for d in report.segment_drivers} == {"region", "device"}
    other = rows["multivariate"]
    assert other.hypotheses == [] and other.confidence == "medium"
    assert other.summary.endswith("Hypothesis: under investigation.")

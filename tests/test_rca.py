import numpy as np
import pandas as pd
import pytest
from frames import REGIONS, hourly_frame, to_spark

from pulsetrail.functions.tails import f_tail
from pulsetrail.operators import rca


def _table(spark, **columns):
    n = len(next(iter(columns.values())))
    frame = pd.DataFrame(
        {"hour_bucket": pd.date_range("2024-01-01", periods=n, freq="h"), "region": "r", **columns}
    )
    return to_spark(spark, frame)


def test_correlations_match_numpy(spark):
    frame = hourly_frame()
    rows = rca.correlate_metrics(to_spark(spark, frame), "error_rate", rca.CANDIDATES).collect()
    assert [r.position for r in rows] == [1, 2, 3, 4, 5, 6]
    for row in rows:
        r = np.corrcoef(frame["error_rate"], frame[row.feature])[0, 1]
        assert row.pearson_r == pytest.approx(r, abs=6e-5)
        assert row.p_value == pytest.approx(f_tail(r * r * 98 / (1 - r * r), 1, 98), abs=6e-7)
        assert row.direction == ("positive" if r > 0 else "negative")


def test_degenerate_correlations(spark):
    x = np.arange(20.0)
    df = _table(spark, a=x, b=-2 * x, flat=np.ones(20), c=np.where(x < 3, np.nan, x))
    rows = {r.feature: r for r in rca.correlate_metrics(df, "a", ["b", "flat", "c", "gone"]).collect()}
    assert set(rows) == {"b", "c"}
    assert (rows["b"].pearson_r, rows["b"].p_value, rows["b"].direction) == (-1.0, 0.0, "negative")
    assert rca.correlate_metrics(df, "flat", ["a", "b"]).count() == 0
    assert rca.correlate_metrics(df, "a", ["gone"]).count() == 0
    assert rca.correlate_metrics(df.where("false"), "a", ["b"]).count() == 0


def _least_squares_f(y, x, lag):
    n = len(y) - lag
    target = y[lag:]
    own = [y[lag - k : len(y) - k] for k in range(1, lag + 1)]
    other = [x[lag - k : len(x) - k] for k in range(1, lag + 1)]

    def rss(columns):
        design = np.column_stack([np.ones(n), *columns])
        residual = target - design @ np.linalg.lstsq(design, target, rcond=None)[0]
        return residual @ residual

    restricted, full = rss(own), rss(own + other)
    return (restricted - full) / lag / (full / (n - 2 * lag - 1))


def test_granger_matches_least_squares(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(1e6, 1e4, 400)
    y = np.concatenate([[0.0, 0.0], 3e-5 * x[:-2]]) + rng.normal(0, 0.1, 400)
    df = _table(spark, x=x, y=y)
    pairs = spark.createDataFrame([("y", "x"), ("x", "y")], "target string, candidate string")
    data = {"x": x, "y": y}
    for row in rca.granger_tests(df, ["x", "y"], pairs).collect():
        want = _least_squares_f(data[row.target], data[row.candidate], row.lag)
        assert row.f == pytest.approx(want, rel=1e-7)
        assert row.p == pytest.approx(f_tail(want, row.lag, 400 - 3 * row.lag - 1), abs=1e-9)
    best = rca.granger_causality(df, "y", "x").first()
    assert best.granger_causes and best.best_lag in (2, 3) and best.error is None
    assert best.interpretation.startswith("x Granger-causes y with lag=")


@pytest.mark.parametrize(
    ("n", "message"),
    [(9, "Insufficient data"), (10, "Insufficient observations. Maximum allowable lag is 2")],
)
def test_granger_needs_rows(spark, n, message):
    rng = np.random.default_rng(n)
    df = _table(spark, x=rng.normal(size=n), y=rng.normal(size=n))
    row = rca.granger_causality(df, "y", "x").first()
    assert row.error == message and row.granger_causes is None


def test_granger_reports_what_it_cannot_solve(spark):
    x = np.random.default_rng(4).normal(size=60)
    df = _table(spark, x=x, flat=np.zeros(60), same=2 * x + 1)
    assert rca.granger_causality(df, "x", "flat").first().error == "a series is constant"
    assert "collinear" in rca.granger_causality(df, "x", "same").first().error


def test_granger_per_series(spark):
    rng = np.random.default_rng(9)
    frame = pd.concat(
        [
            pd.DataFrame(
                {
                    "hour_bucket": pd.date_range("2024-01-01", periods=80, freq="h"),
                    "region": name,
                    "x": rng.normal(size=80),
                    "y": rng.normal(size=80),
                }
            )
            for name in ("a", "b")
        ]
    )
    df = to_spark(spark, frame)
    pairs = spark.createDataFrame([("y", "x")], "target string, candidate string")
    rows = rca.granger_tests(df, ["x", "y"], pairs, series=("region",)).collect()
    assert len(rows) == 6
    for row in rows:
        part = frame[frame["region"] == row.region]
        want = _least_squares_f(part["y"].to_numpy(), part["x"].to_numpy(), row.lag)
        assert row.f == pytest.approx(want, rel=1e-7)


def test_segments_on_one_side_only(spark):
    df = to_spark(
        spark,
        pd.DataFrame(
            {
                "hour_bucket": pd.to_datetime(
                    ["2024-01-01 00:00", "2024-01-01 01:00", "2024-01-01 02:00", "2024-01-01 03:00"]
                ),
                "region": ["old", "both", "both", "late"],
                "device": ["m", "m", "new", "m"],
                "v": [1.0, 2.0, 3.0, 100.0],
            }
        ),
    )
    rows = rca.segment_anomaly(df, "v", "2024-01-01 02:00:00", "2024-01-01 02:00:00").collect()
    got = {(r.dimension, r.segment): r for r in rows}
    assert set(got) == {("region", "old"), ("region", "both"), ("device", "m"), ("device", "new")}
    assert got["region", "old"].pct_change == -1.0 and got["region", "both"].abs_change == 1.0
    assert got["region", "old"].primary_driver == "old"
    # A segment without a baseline divides by the epsilon and wins.
    assert got["device", "m"].primary_driver == "new" and got["device", "m"].driver_change > 1e9
    empty = rca.segment_anomaly(df, "v", "2020-01-01 00:00:00", "2020-01-01 00:00:00")
    assert empty.count() == 0


def test_report_per_series_stays_one_row(spark):
    hourly = to_spark(spark, hourly_frame(300))
    anomalies = spark.sql(
        "SELECT 'error_rate' AS metric, TIMESTAMP_NTZ'2024-01-03 02:00:00' AS timestamp, 0.01D AS value"
    )
    rows = rca.rca_report(hourly, anomalies, series=("region", "device")).collect()
    assert len(rows) == 1 and len(rows[0].granger_causality) == 3
    assert rows[0].recommended_actions == []  # below the error level
    assert {g.region for g in rows[0].granger_causality} <= set(REGIONS)


def test_report_of_any_metric_the_table_has(spark):
    hourly = to_spark(spark, hourly_frame(200))
    anomalies = spark.sql(
        "SELECT * FROM VALUES ('unique_sessions', TIMESTAMP_NTZ'2023-06-07 02:00:00', 9D), "
        "('multivariate', TIMESTAMP_NTZ'2023-06-07 03:00:00', 0D) AS t(metric, timestamp, value)"
    )
    rows = {r.target_metric: r for r in rca.rca_report(hourly, anomalies).collect()}
    found = rows["unique_sessions"]
    assert len(found.top_correlations) == 5 and len(found.hypotheses) == 3
    assert "Top correlated metrics: ['" in found.summary
    assert rows["multivariate"].hypotheses == [] and rows["multivariate"].top_correlations is None

import numpy as np
import pandas as pd
import pytest
from frames import hourly_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.operators import anomaly
from pulsetrail.operators.decay import exponential_hits
from pulsetrail.operators.iforest import isolation_forest_detection
from pulsetrail.operators.ordering import global_rank


def _series(spark, values):
    frame = pd.DataFrame(
        {
            "hour_bucket": pd.date_range("2024-01-01", periods=len(values), freq="h"),
            "region": "r",
            "device": "d",
            "m": np.asarray(values, dtype="float64"),
        }
    )
    return to_spark(spark, frame)  # NaN stays NaN


def test_zscore_matches_pandas(spark):
    rng = np.random.default_rng(3)
    values = pd.Series(rng.normal(10, 2, 400))
    values[rng.choice(400, 20, replace=False)] = np.nan
    values[200] = 60.0
    x = values.fillna(0)
    mean, sd = x.rolling(24, min_periods=3).mean(), x.rolling(24, min_periods=3).std()
    z = (x - mean) / sd
    want = z[(z.abs() >= 2.5) & (sd >= 1e-6)]
    got = anomaly.zscore_detection(_series(spark, values), "m").orderBy("timestamp").collect()
    hours = [int((r.timestamp - pd.Timestamp("2024-01-01")) / pd.Timedelta(hours=1)) for r in got]
    assert hours == list(want.index)
    assert [r.deviation for r in got] == pytest.approx(list(want.round(3)), abs=1e-9)


@pytest.mark.parametrize("values", [[], [5.0], [5.0, 9.0], [4.0] * 30])
def test_detectors_stay_quiet(spark, values):
    df = _series(spark, values)
    assert anomaly.zscore_detection(df, "m", threshold=0.1).count() == 0
    assert anomaly.iqr_detection(df, "m").count() == 0
    assert anomaly.ewma_detection(df, "m").count() == 0
    assert anomaly.seasonal_detection(df, "m").count() == 0


def test_zscore_reach(spark):
    """A window that includes the point cannot exceed (n-1)/sqrt(n): 2.475 for 8 rows."""
    assert anomaly.zscore_detection(_series(spark, [0.0] * 7 + [1e6]), "m").count() == 0
    assert anomaly.zscore_detection(_series(spark, [0.0] * 8 + [1e6]), "m").count() == 1


def test_zscore_per_series_ignores_the_others(spark):
    frame = hourly_frame(120)
    df = to_spark(spark, frame)
    got = anomaly.zscore_detection(df, "error_rate", 2.0, series=("region", "device"))
    want = 0
    for _, part in frame.groupby(["region", "device"]):
        x = part.sort_values("hour_bucket")["error_rate"]
        roll = x.rolling(24, min_periods=3)
        want += int((((x - roll.mean()) / roll.std()).abs() >= 2.0).sum())
    assert got.count() == want


def test_iqr_matches_pandas(spark):
    values = pd.Series(np.random.default_rng(5).lognormal(3, 1, 301))
    q1, q2, q3 = values.quantile([0.25, 0.5, 0.75])
    out = values[(values < q1 - 2 * (q3 - q1)) | (values > q3 + 2 * (q3 - q1))]
    got = anomaly.iqr_detection(_series(spark, values), "m").orderBy("timestamp").collect()
    assert [r.value for r in got] == pytest.approx(list(out.round(4)))
    assert {r.expected for r in got} == {round(q2, 4)}
    want = ((out - q2) / (q3 - q1 + 1e-6)).round(3)
    assert [r.deviation for r in got] == pytest.approx(list(want), abs=1e-9)


@pytest.mark.parametrize("span", [4, 12])
def test_ewma_matches_pandas(spark, span):
    rng = np.random.default_rng(6)
    values = pd.Series(rng.normal(0, 1, 600).cumsum())
    values[[5, 6, 100]] = np.nan
    mean, sd = values.ewm(span=span).mean(), values.ewm(span=span).std()
    z = (values - mean) / (sd + 1e-6)
    want = list(np.where(z.abs() > 1.2)[0])
    got = anomaly.ewma_detection(_series(spark, values), "m", span, 1.2).orderBy("position")
    rows = got.collect()
    assert [r.position for r in rows] == want
    assert [r.z for r in rows] == pytest.approx(list(z[want]), rel=1e-9)


@pytest.mark.parametrize("kind", ["level", "old spike", "constant", "high level"])
def test_ewma_keeps_its_digits_and_its_memory(spark, kind):
    rng = np.random.default_rng(8)
    values = pd.Series(rng.normal(0, 1, 700))
    if kind == "old spike":
        values[3] = 1e12
    values += {"level": 1e9, "constant": 1e8, "high level": 5e6}.get(kind, 0)
    if kind == "constant":
        values[:] = 1e8
    if kind == "high level":
        values = 5e6 + (values - 5e6) * 0.05
    mean, sd = values.ewm(span=12).mean(), values.ewm(span=12).std()
    z = (values - mean) / (sd + 1e-6)
    want = list(np.where(z.abs() > 1.2)[0])
    rows = anomaly.ewma_detection(_series(spark, values), "m", 12, 1.2).orderBy("position").collect()
    assert [r.position for r in rows] == want
    assert [r.z for r in rows] == pytest.approx(list(z[want]), rel=1e-6)


def test_ewma_over_chunks_and_series(spark):
    rng = np.random.default_rng(9)
    size = 11_500
    values = pd.Series(rng.normal(0, 1, size).cumsum())
    z = (values - values.ewm(span=12).mean()) / (values.ewm(span=12).std() + 1e-6)
    rows = anomaly.ewma_detection(_series(spark, values), "m", 12, 2.0).orderBy("position").collect()
    assert [r.position for r in rows] == list(np.where(z.abs() > 2.0)[0])


@pytest.mark.parametrize(("chunk_rows", "block_chunks"), [(1, 1), (3, 4), (7, 1000), (1000, 2)])
def test_scan_does_not_depend_on_the_cuts(spark, chunk_rows, block_chunks):
    rng = np.random.default_rng(10)
    frames = []
    for name, n in (("a", 150), ("b", 1), ("c", 67), (None, 40)):
        values = pd.Series(rng.normal(50, 9, n))
        values[rng.random(n) < 0.2] = np.nan
        frames.append(pd.DataFrame({"s": name, "at": range(n), "x": values}))
    frame = pd.concat(frames)
    df = spark.createDataFrame(frame.astype({"s": object}), "s string, at long, x double")
    ranked = global_rank(df.withColumn("x", F.nullif("x", F.lit(float("nan")))), ["s", "at"])
    found = exponential_hits(ranked, "x", 1 - 2 / 9, 0.6, 1e-6, ["s"], chunk_rows=chunk_rows, block_chunks=block_chunks)
    assert "Python" not in found._jdf.queryExecution().toString()
    got = {(r.s, r["at"]): (r.ewma, r.ewm_std, r.z) for r in found.collect()}
    want = {}
    for (name,), part in frame.groupby(["s"], dropna=False):
        window = part["x"].ewm(span=8)
        mean, sd = window.mean(), window.std()
        z = (part["x"] - mean) / (sd + 1e-6)
        for i in np.where(z.abs() > 0.6)[0]:
            want[(None if name != name else name, int(part["at"].iloc[i]))] = (mean.iloc[i], sd.iloc[i], z.iloc[i])
    assert got.keys() == want.keys() and len(want) > 40
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-9)


def test_ewma_bound(spark):
    """A jump after a flat stretch is as far as a row can be: 2.25 for a span of 12."""
    rows = anomaly.ewma_detection(_series(spark, [0.0] * 200 + [1e6]), "m", 12, 2.2).collect()
    assert [r.position for r in rows] == [200] and rows[0].z == pytest.approx(2.245, abs=2e-3)


def test_nan_counts_as_zero(spark):
    values = pd.Series(np.random.default_rng(11).normal(100, 3, 120))
    values[60], values[110] = np.nan, 160.0
    x = values.fillna(0)
    roll = x.rolling(24, min_periods=3)
    z = (x - roll.mean()) / roll.std()
    got = anomaly.zscore_detection(_series(spark, values), "m", 2.5).count()
    assert got == int((z.abs() >= 2.5).sum())
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    outside = (x < q1 - 2 * (q3 - q1)) | (x > q3 + 2 * (q3 - q1))
    assert anomaly.iqr_detection(_series(spark, values), "m").count() == int(outside.sum())


def test_seasonal_parts_add_up(spark):
    hours = np.arange(24 * 10)
    clean = 100 + 0.5 * hours + 20 * np.sin(2 * np.pi * hours / 24)
    values = clean.copy()
    values[120] += 50
    df = _series(spark, values)
    parts = anomaly.seasonal_residuals(df, "m").orderBy("hour_bucket").toPandas()
    inside = parts[12:-12]
    total = inside["trend"] + inside["seasonal"] + inside["remainder"]
    assert np.allclose(total, inside["m"])
    assert parts["trend"][:12].isna().all() and parts["trend"][-12:].isna().all()
    assert abs(parts["seasonal"].head(24).sum()) < 1e-9
    found = anomaly.seasonal_detection(df, "m").collect()
    assert [r.m for r in found] == [values[120]]


def test_missing_columns_are_skipped(spark):
    df = to_spark(spark, hourly_frame()).select("hour_bucket", "region", "error_rate")
    found = anomaly.detect_all(df)
    assert {r.method for r in found.collect()} == {"zscore"}


def test_region_filter_labels_the_forest(spark):
    df = to_spark(spark, hourly_frame(300))
    rows = anomaly.detect_all(df, region="north").collect()
    assert {r.region for r in rows if r.method == "isolation_forest"} == {"north"}
    assert {r.region for r in rows if r.method == "iqr"} <= {None}


def test_counts_keep_zeros(spark):
    rows = anomaly.anomaly_counts(anomaly.detect_all(_series(spark, []), methods=("zscore",)))
    assert {(r.kind, r["count"]) for r in rows.collect()} == {("severity", 0), ("method", 0)}
    assert rows.count() == 7


def test_forest_ignores_partitioning(spark):
    df = to_spark(spark, hourly_frame(800))
    features = ["error_rate", "avg_response_ms", "event_count"]

    def scores(parts):
        rows = isolation_forest_detection(df.repartition(parts), features).collect()
        return {(r.hour_bucket, r.region, r.device): r.anomaly_score for r in rows}

    first = scores(3)
    assert first == scores(11)
    assert -1 <= min(first.values()) and max(first.values()) < 0


def test_forest_share(spark):
    df = to_spark(spark, hourly_frame(1000))
    rows = isolation_forest_detection(df, ["error_rate", "total_revenue"], contamination=0.05)
    assert rows.where("is_anomaly").count() == 50

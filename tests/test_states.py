"""States that merge: sketches, bitmaps, open sessions, the feature store."""

import numpy as np
import pandas as pd
import pytest
from frames import event_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.operators.bitmaps import daily_bitmaps, number_users, users_by_period
from pulsetrail.operators.features import session_features, user_features
from pulsetrail.operators.sessions import open_sessions, session_slots, sessionize
from pulsetrail.operators.sketches import (
    distinct_error,
    hourly_sketches,
    latency_quantile,
    merge_sketches,
    rank_error,
    unique_users,
)
from pulsetrail.plans.incremental import FeatureStore


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _events(spark, n, users, days=20):
    rng = np.random.default_rng(n)
    at = rng.integers(0, days * 86_400, n).astype("float64") + 1_704_067_200
    frame = pd.DataFrame(
        {
            "event_id": np.arange(n),
            "user_id": rng.zipf(1.3, n) % users,
            "timestamp": at,
            "timestamp_dt": pd.to_datetime(at, unit="s"),
            "region": np.array(["a", "b"], dtype=object)[rng.integers(0, 2, n)],
            "device": "phone",
            "response_time_ms": (rng.lognormal(5, 1, n)).astype("int64"),
        }
    )
    return frame, to_spark(spark, frame)


# ---- sketches


def test_merged_sketches_stay_within_their_errors(spark):
    frame, events = _events(spark, 120_000, 9_000)
    merged = merge_sketches(hourly_sketches(events), "region")
    probabilities = (0.01, 0.25, 0.5, 0.95, 0.99)
    rows = merged.select(
        "region", "event_count", unique_users().alias("users"),
        *[latency_quantile(p).alias(f"q{i}") for i, p in enumerate(probabilities)],
        F.length("latency_sketch").alias("bytes"),
    ).collect()
    assert len(rows) == 2
    for row in rows:
        part = frame[frame["region"] == row["region"]]
        assert row["event_count"] == len(part)
        values = np.sort(part["response_time_ms"].to_numpy())
        for i, p in enumerate(probabilities):
            low = np.searchsorted(values, row[f"q{i}"], "left") / len(values)
            high = np.searchsorted(values, row[f"q{i}"], "right") / len(values)
            assert low - rank_error() <= p <= high + rank_error()
        exact = part["user_id"].nunique()
        assert abs(row["users"] - exact) <= 3 * distinct_error() * exact
        assert row["bytes"] < 8 * 3 * 200 + 1_000  # 60,000 events or a hundred


def test_sketches_of_nothing_and_nulls(spark):
    frame, events = _events(spark, 40, 5)
    blank = events.withColumns({"response_time_ms": F.lit(None).cast("long"), "user_id": F.lit(None).cast("long")})
    row = merge_sketches(hourly_sketches(blank), "region").select(
        latency_quantile(0.95).alias("q"), unique_users().alias("u")
    ).collect()
    assert {(r["q"], r["u"]) for r in row} == {(None, 0)}
    assert hourly_sketches(events.where("false")).count() == 0


# ---- bitmaps


@pytest.mark.parametrize("kind", ["long", "string"])
def test_bitmaps_count_exactly(spark, kind):
    frame, events = _events(spark, 30_000, 70_000, days=60)
    events = events.withColumn("user_id", F.col("user_id").cast(kind))
    loose = events.limit(5).withColumn("user_id", F.lit(None).cast(kind))
    numbers = number_users(events)
    found = daily_bitmaps(events.unionByName(loose), numbers)
    for period, rule in (("day", "D"), ("week", "W-SUN"), ("month", "M")):
        start = frame["timestamp_dt"].dt.to_period(rule).dt.start_time.dt.date
        want = frame.groupby(start)["user_id"].nunique()
        got = {r["start"]: r["unique_users"] for r in users_by_period(found, period).collect()}
        assert got == want.to_dict()


def test_known_numbers_stay(spark):
    _, events = _events(spark, 2_000, 500)
    first = number_users(events.where("user_id < 200"))
    both = number_users(events, known=first)
    old = dict(_rows(first))
    new = dict(_rows(both))
    assert {u: new[u] for u in old} == old
    assert sorted(new.values()) == list(range(len(new)))
    assert len(new) == events.select("user_id").distinct().count()


# ---- sessions across batches


@pytest.mark.parametrize("gap_s", [1_800, 7 * 3_600, 40 * 3_600])
def test_day_by_day_sessions_equal_one_run(spark, gap_s):
    _, events = _events(spark, 1_500, 40, days=6)
    whole = _rows(sessionize(events, gap_s).select("event_id", "session_id", "session_seq"))
    got, carried = [], None
    for day in range(6):
        batch = events.where(F.dayofyear("timestamp_dt") == day + 1)
        slots = session_slots(batch, gap_s, carried=carried)
        got += _rows(sessionize(batch, gap_s, slots=slots).select("event_id", "session_id", "session_seq"))
        state = open_sessions(slots, carried).collect()
        carried = spark.createDataFrame(state, "user_id long, _last long, session_seq long")
    assert sorted(got, key=repr) == whole


# ---- feature store


@pytest.fixture
def days(spark):
    frame = event_frame(3_000, 60)
    frame = frame[frame["timestamp_dt"] < "2023-06-15"]
    events = to_spark(spark, frame).withColumn("dt", F.to_date("timestamp_dt"))
    return events, sorted(str(d) for d in frame["timestamp_dt"].dt.date.unique())


def _check(store, events):
    for got, want in (
        (store.user_features(), user_features(events)),
        (store.session_features(), session_features(events)),
    ):
        names = want.columns
        a = got.select(*names).toPandas().sort_values(names[0]).reset_index(drop=True)
        b = want.toPandas().sort_values(names[0]).reset_index(drop=True)
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-12)


def test_day_by_day_store_equals_a_full_run(spark, tmp_path, days):
    events, names = days
    store = FeatureStore(spark, str(tmp_path))
    assert store.version() == 0 and store.add(events, []) == []
    assert store.add(events, names[:-3]) == names[:-3]
    _check(store, events.where(F.col("dt") < names[-3]))
    for day in names[-3:]:
        assert store.add(events, [day]) == [day]
    _check(store, events)
    assert store.version() == 4
    # A replayed day changes nothing, with or without correction.
    assert store.add(events, names[-3:]) == [] and store.version() == 4
    store.add(events, [names[-2]], replace=True)
    _check(store, events)


def test_store_reads_the_new_day_alone(spark, tmp_path, days):
    events, names = days
    path = str(tmp_path / "events")
    events.write.partitionBy("dt").parquet(path)
    store = FeatureStore(spark, str(tmp_path / "store"))
    store.add(spark.read.parquet(path), names[:-1])
    # Earlier days cannot be read any more.
    for name in names[:-1]:
        for file in (tmp_path / "events" / f"dt={name}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
    store.add(spark.read.schema(events.schema).parquet(path), [names[-1]])
    _check(store, events)


def test_corrected_day_and_interrupted_run(spark, tmp_path, days):
    events, names = days
    store = FeatureStore(spark, str(tmp_path))
    store.add(events, names[:-1])
    # A run that died after its totals, before its ledger, leaves no trace.
    store._states("users", 1).limit(3).write.parquet(store._totals("users", 2))
    _check(store, events.where(F.col("dt") < names[-1]))
    store.add(events, [names[-1]])
    _check(store, events)
    fewer = events.where((F.col("dt") != names[1]) | (F.col("user_id") > "user3"))
    store.add(fewer, [names[1]], replace=True)
    _check(store, fewer)

"""Sessions, features, skew, quality, generator, lake, ETL, saved queries."""

import numpy as np
import pandas as pd
import pytest
from frames import event_frame, hourly_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize
from pulsetrail.operators.features import enrich_events, session_features, user_features
from pulsetrail.operators.kpis import hourly_kpis, kpi_summary, kpi_timeseries, latest_points
from pulsetrail.operators.quality import quality_report, validate_schema
from pulsetrail.operators.sessions import session_slots, session_spans, sessionize
from pulsetrail.operators.skew import attach_by_key
from pulsetrail.plans.etl import run_etl
from pulsetrail.plans.saved_queries import (
    SAVED_QUERIES,
    descriptions,
    query_payload,
    run_saved_query,
)
from pulsetrail.schemas import EVENT_TYPES, EVENTS, HOURLY
from pulsetrail.sources import lake
from pulsetrail.sources.generate import (
    EVENT_SHARES,
    HOUR_WEIGHTS,
    REGION_SHARES,
    dataset_profile,
    generate_diurnal_timestamps,
    generate_events,
)


def _skewed(n: int = 6000) -> pd.DataFrame:
    """A third of all events belong to one user, half of those to one minute."""
    frame = event_frame(n, users=40)
    frame.loc[: n // 3, "user_id"] = "hot"
    frame.loc[: n // 6, "timestamp_dt"] = pd.Timestamp("2024-02-01 12:00:00") + pd.to_timedelta(
        np.arange(n // 6 + 1) % 60, unit="s"
    )
    return frame


def _pandas_sessions(frame: pd.DataFrame, gap_s: int) -> pd.Series:
    ordered = frame.sort_values(["user_id", "timestamp_dt"])
    pause = ordered.groupby("user_id")["timestamp_dt"].diff().dt.total_seconds()
    starts = (~(pause <= gap_s)).astype(int)
    return starts.groupby(ordered["user_id"]).cumsum().reindex(frame.index)


@pytest.mark.parametrize("gap_s", [60, 1800, 86_400])
def test_sessions_match_pandas_under_skew(spark, gap_s):
    frame = _skewed()
    got = sessionize(to_spark(spark, frame), gap_s).select("event_id", "session_seq", "session_id")
    got = got.toPandas().set_index("event_id").loc[frame["event_id"]]
    assert (got["session_seq"].to_numpy() == _pandas_sessions(frame, gap_s).to_numpy()).all()
    assert (got["session_id"] == (frame["user_id"].to_numpy() + "-" + got["session_seq"].astype(str))).all()


def test_a_pause_of_exactly_the_gap_continues(spark):
    at = pd.Timestamp("2024-01-01") + pd.to_timedelta([0, 1_800_000_000, 3_600_000_001], unit="us")
    frame = pd.DataFrame({"event_id": ["a", "b", "c"], "user_id": "u", "timestamp_dt": at})
    spans = session_spans(session_slots(to_spark(spark, frame), 1800)).orderBy("session_seq").collect()
    assert [r.session_depth for r in spans] == [2, 1]


@pytest.mark.parametrize("rows_per_task", [200, 10**6])
def test_hot_and_null_keys_join_as_usual(spark, rows_per_task):
    frame = _skewed()
    frame.loc[frame.index % 5 == 0, "user_id"] = None
    events = to_spark(spark, frame)
    users = materialize(user_features(events))
    joined = attach_by_key(events, users, ["user_id"], "user_event_count", ["event_id"], rows_per_task)
    plain = events.join(users, "user_id", "left")
    assert joined.exceptAll(plain.select(joined.columns)).count() == 0
    assert joined.count() == events.count() == len(frame)


@pytest.mark.parametrize("hot", [-1, None])
def test_tasks_are_balanced(spark, hot):
    """No shuffle partition of the join gets much more than its share."""
    key = F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.col("id") % 9973)
    rows = spark.range(400_000).select(F.col("id").alias("event_id"), key.alias("k"))
    weights = materialize(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach_by_key(rows, weights, ["k"], "n", ["event_id"], 2_000)
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert joined.where("n is null").count() == (0 if hot else 200_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sizes < 1.5 * 400_000 / 8


def test_enriched_events_match_pandas(spark):
    frame = _skewed(3000)
    events = to_spark(spark, frame)
    got = enrich_events(
        events, materialize(user_features(events)), materialize(session_features(events))
    ).toPandas()
    assert len(got) == len(frame)
    got = got.set_index("event_id").loc[frame["event_id"]].reset_index()
    by_user, by_session = frame.groupby("user_id"), frame.groupby("session_id")
    assert (got["user_event_count"] == by_user["event_id"].transform("count")).all()
    assert np.allclose(got["user_total_revenue"], by_user["revenue"].transform("sum"))
    assert (got["session_depth"] == by_session["event_id"].transform("count")).all()
    bought = (frame["event_type"] == "purchase").astype(int)
    assert (got["converted"] == bought.groupby(frame["session_id"]).transform("max")).all()


def test_hourly_matches_pandas_and_keeps_null_groups(spark):
    frame = event_frame(4000, users=30)
    frame.loc[:99, "region"] = None
    df = to_spark(spark, frame)
    got = hourly_kpis(df).toPandas()
    assert got["event_count"].sum() == 4000
    assert got[got["region"].isna()]["event_count"].sum() == 100
    frame["hour_bucket"] = frame["timestamp_dt"].dt.floor("h")
    want = frame.groupby(["hour_bucket", "region", "device"], dropna=False).agg(
        unique_users=("user_id", "nunique"), unique_sessions=("session_id", "nunique")
    )
    keyed = got.set_index(["hour_bucket", "region", "device"])[["unique_users", "unique_sessions"]]
    assert keyed["unique_users"].sum() == want["unique_users"].sum()
    assert keyed["unique_sessions"].sum() == want["unique_sessions"].sum()
    rough = hourly_kpis(df, approximate_distinct=True)
    assert rough.columns == hourly_kpis(df).columns == HOURLY.names
    assert rough.count() == len(got)


def test_timeseries_takes_the_earliest_week(spark):
    series = kpi_timeseries(to_spark(spark, hourly_frame(200)))
    hours = [r.hour_bucket for r in series.collect()]
    assert len(hours) == 168 and hours[0] == hourly_frame(1)["hour_bucket"][0]
    tail = [r.hour_bucket for r in latest_points(series).collect()]
    assert tail == hours[-48:]
    assert kpi_summary(to_spark(spark, hourly_frame(200))).first().unique_regions == 3


def test_quality_counts_bad_rows(spark):
    frame = event_frame(200)
    frame.loc[0, "event_id"] = frame.loc[1, "event_id"]
    frame.loc[2, "user_id"] = None
    frame.loc[3, "price"] = -1.0
    frame.loc[4, ["event_type", "revenue", "error_code"]] = "teleport", 0.0, "200"
    frame.loc[5, ["event_type", "revenue", "error_code"]] = "search", 9.0, "500"
    frame.loc[6, ["event_type", "revenue", "error_code"]] = "error", 0.0, "200"
    bad = {r.rule: r.bad_rows for r in quality_report(to_spark(spark, frame)).collect()}
    expected = {
        "duplicate_event_id": 1,
        "null_user_id": 1,
        "negative_price": 1,
        "unknown_event_type": 1,
        "revenue_without_purchase": 1,
        "code_without_error": 1,
        "error_without_code": 1,
    }
    assert {rule: n for rule, n in bad.items() if n} == expected


def test_schema_check(spark):
    good = generate_events(spark, 5)
    assert validate_schema(good).count() == 0
    bad = good.drop("platform").withColumn("price", F.col("price").cast("string"))
    assert {(r.column_name, r.problem) for r in validate_schema(bad).collect()} == {
        ("platform", "missing"),
        ("price", "type"),
    }


def test_generator_marginals(spark):
    n = 200_000
    events = generate_events(spark, n).cache()
    assert events.schema.names == EVENTS.names
    for column, shares in (("event_type", EVENT_SHARES), ("region", REGION_SHARES)):
        for row in events.groupBy(column).count().collect():
            assert row["count"] / n == pytest.approx(shares[row[column]], abs=0.005)
    day = F.floor((F.col("timestamp") - 1_704_067_200) / 86_400)
    sale = {r.hour for r in events.where(day == 45).select("hour").distinct().collect()}
    assert sale == {13, 14, 15}
    usual = events.where(day != 45).groupBy("hour").count().collect()
    total = sum(r["count"] for r in usual)
    for row in usual:
        assert row["count"] / total == pytest.approx(HOUR_WEIGHTS[row.hour] / sum(HOUR_WEIGHTS), abs=0.005)
    stats = events.agg(
        F.percentile("price", 0.5).alias("price"),
        F.percentile("response_time_ms", 0.5).alias("latency"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.max(F.when(F.col("event_type") != "purchase", F.col("revenue"))).alias("other"),
    ).first()
    assert stats.price == pytest.approx(np.exp(3.5), rel=0.03)
    assert stats.latency == pytest.approx(np.exp(5.5), rel=0.05)
    assert stats.low >= 0.99 and stats.high <= 2999.99 and stats.other == 0.0
    bad = quality_report(events).where("bad_rows > 0").collect()
    assert bad == []
    top = events.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert top / n == pytest.approx(0.5, abs=0.05)  # power law: one user, half the load


def test_generator_ignores_partitioning(spark):
    a, b = generate_events(spark, 3000, partitions=2), generate_events(spark, 3000, partitions=9)
    assert a.exceptAll(b).count() == 0 and b.count() == 3000
    assert generate_events(spark, 3000, seed=7).exceptAll(a).count() > 2900


def test_profile(spark):
    row = dataset_profile(generate_events(spark, 5000)).first()
    assert row.total_events == 5000 and sum(row.event_distribution.values()) == 5000
    assert set(row.event_distribution) <= set(EVENT_TYPES) and " to 2024-" in row.date_range


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "lake")
    events = generate_events(spark, 2000).withColumn("dt", F.to_date("timestamp_dt"))
    lake.replace_partitions(events, path)
    one = events.where("region = 'us-east-1' AND dt = '2024-01-05'")
    lake.replace_event_partition(one.limit(3).drop("region", "dt"), path, "us-east-1", "2024-01-05")
    stored = lake.read_table(spark, path)
    assert stored.count() == 2000 - one.count() + 3
    files = [r.path for r in lake.list_partitions(spark, path).collect()]
    assert any("region=us-east-1/dt=2024-01-05" in f for f in files)
    metrics = lake.storage_metrics(spark, path).first()
    assert metrics.total_objects >= len([f for f in files if f.endswith(".parquet")]) > 100
    assert metrics.total_size_mb > 0


def test_etl_round_trip(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    lake.write_events_by_region(generate_events(spark, 5000), raw)
    result = run_etl(spark, raw, out)
    assert result.events.count() == 5000
    assert result.events.where("user_event_count is null or session_depth is null").count() == 0
    assert result.hourly.agg(F.sum("event_count")).first()[0] == 5000
    assert result.quality.where("bad_rows > 0").count() == 0
    stats = lake.table_stats({"events": result.events, "hourly": result.hourly}).collect()
    assert {r.table for r in stats} == {"events", "hourly"}
    lake.write_hourly_csv(result.hourly, out + "/csv")
    back = lake.read_hourly_csv(spark, out + "/csv")
    assert back.schema == HOURLY and back.exceptAll(result.hourly.select(HOURLY.names)).count() == 0
    east = lake.read_events(spark, raw).where("region = 'us-east-1'")
    assert "PartitionFilters: [isnotnull(region" in east._jdf.queryExecution().executedPlan().toString()


def test_saved_queries(spark):
    hourly, events = to_spark(spark, hourly_frame()), to_spark(spark, event_frame())
    tables = {"hourly": hourly, "events": events}
    assert set(descriptions()) == set(SAVED_QUERIES)
    for name in SAVED_QUERIES:
        assert run_saved_query(spark, name, tables).count() > 0
    with pytest.raises(ValueError, match="Unknown query: nope"):
        run_saved_query(spark, "nope", tables)
    with pytest.raises(RuntimeError, match="No data loaded"):
        run_saved_query(spark, "top_categories", {"hourly": hourly})
    page = query_payload(run_saved_query(spark, "hourly_kpis", tables))
    assert len(page["rows"]) == 50 and page["columns"][0] == "hour_bucket" and page["elapsed_ms"] > 0
    funnel = run_saved_query(spark, "funnel_conversion", tables).collect()
    assert funnel[0].relative_pct == 100.0 and len(funnel) == 6


def test_diurnal_timestamps_are_the_generators(spark):
    times = generate_diurnal_timestamps(spark, 500).select("timestamp")
    assert times.exceptAll(generate_events(spark, 500).select("timestamp")).count() == 0
    assert times.count() == 500

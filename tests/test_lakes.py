"""Event tables as other writers leave them, under any session time zone."""

import numpy as np
import pytest
from frames import event_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import epoch_micros, epoch_to_ts, exact_sum, hour_bucket
from pulsetrail.materialize import scratch_path
from pulsetrail.operators.cohort import cohort_analysis
from pulsetrail.operators.rfm import rfm_segmentation
from pulsetrail.plans.etl import run_etl
from pulsetrail.schemas import EVENTS
from pulsetrail.sources import lake


@pytest.fixture(params=["UTC", "Asia/Kolkata", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def raw(spark):
    """17 columns by region: no timestamp_dt, 64-bit hour and weekday."""
    path = scratch_path(spark, "raw-lake")
    frame = event_frame(3000, users=60).drop(columns="timestamp_dt")
    frame["platform"], frame["product_id"], frame["search_query"] = "web", "p", ""
    frame["hour"] = (frame["timestamp"] // 3600 % 24).astype("int64")
    frame["day_of_week"] = (frame["timestamp"] // 86_400 % 7).astype("int64")
    assert frame.shape[1] == 17
    lake.write_events_by_region(to_spark(spark, frame), path)
    return path


def test_etl_reads_it(spark, raw, zone):
    out = scratch_path(spark, "lake")
    result = run_etl(spark, raw, out)
    assert result.events.count() == 3000
    assert result.events.where("timestamp_dt is null").count() == 0
    wrong = epoch_micros(F.col("timestamp_dt")) != F.col("timestamp") * 1e6
    assert result.events.where(wrong).count() == 0
    assert result.hourly.agg(F.sum("event_count")).first()[0] == 3000
    problems = {(r.column_name, r.problem) for r in result.schema.collect()}
    assert problems == {("timestamp_dt", "missing"), ("hour", "type"), ("day_of_week", "type")}


def test_a_lake_without_users_is_refused(spark, raw):
    path = scratch_path(spark, "raw-lake")
    spark.read.parquet(raw).drop("user_id").write.parquet(path)
    with pytest.raises(ValueError, match="user_id"):
        run_etl(spark, path, scratch_path(spark, "lake"))


def test_cohorts_and_rfm(spark, raw, zone):
    events = lake.read_events(spark, raw)
    assert events.schema == EVENTS
    stored = cohort_analysis(events)
    derived = cohort_analysis(spark.read.parquet(raw))
    assert stored.count() > 0 and stored.exceptAll(derived).count() == 0
    scores = rfm_segmentation(events)
    assert scores.count() > 0 and scores.where("recency_days is null or rfm_score is null").count() == 0


def test_times_do_not_depend_on_the_session(spark, zone):
    seconds = np.arange(1_710_000_000, 1_710_200_000, 1799.5).tolist()  # over a change of clocks
    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    rows = df.select("s", epoch_to_ts(F.col("s")).alias("t"), hour_bucket(F.col("s")).alias("h")).select(
        "s", epoch_micros(F.col("t")).alias("micros"), F.col("h").cast("string").alias("h")
    )
    for r in rows.collect():
        assert r.micros == round(r.s * 1e6)
        assert r.h == str(np.datetime64(int(r.s // 3600 * 3600), "s")).replace("T", " ")


def test_money_that_does_not_fit(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 2e12), (2, 1.0)], "user_id long, revenue double")
    got = {r.user_id: r.total for r in df.groupBy("user_id").agg(exact_sum("revenue").alias("total")).collect()}
    assert got == {1: 5.0, 2: 1.0}

import math

import numpy as np
import pandas as pd
import pytest
from frames import event_frame, to_spark
from pyspark.sql import functions as F

from pulsetrail.functions.tails import f_tail
from pulsetrail.operators.cohort import cohort_analysis
from pulsetrail.operators.experiment import ab_test_analysis, two_proportion_z
from pulsetrail.operators.features import session_features, user_features
from pulsetrail.operators.funnel import compute_funnel
from pulsetrail.operators.kpis import hourly_kpis
from pulsetrail.operators.rfm import rfm_rollup, rfm_segmentation
from pulsetrail.plans.saved_queries import run_saved_query
from pulsetrail.schemas import FUNNEL_STAGES


def test_rfm_matches_pandas(spark):
    frame = event_frame(20_000, users=300)
    ref = frame["timestamp_dt"].max()
    bought = frame[frame["event_type"] == "purchase"]
    want = bought.groupby("user_id").agg(
        last=("timestamp_dt", "max"), frequency=("event_id", "count"), monetary=("revenue", "sum")
    )
    want["monetary"] = want["monetary"].round(2)
    days = (ref - want["last"]).dt.days
    want["r"] = pd.qcut(days, 5, labels=[5, 4, 3, 2, 1]).astype(int)
    for score, column in (("f", "frequency"), ("m", "monetary")):
        ranks = want[column].rank(method="first")
        want[score] = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    got = rfm_segmentation(to_spark(spark, frame)).toPandas().set_index("user_id").loc[want.index]
    assert (got["recency_days"] == days).all()
    for ours, theirs in (("r_score", "r"), ("f_score", "f"), ("m_score", "m")):
        assert (got[ours] == want[theirs]).all()
    assert np.allclose(got["monetary"], want["monetary"])


def test_rfm_edge_sizes(spark):
    one = event_frame(1).assign(event_type="purchase", revenue=5.0)
    row = rfm_segmentation(to_spark(spark, one)).first()
    assert (row.f_score, row.m_score, row.recency_days) == (3, 3, 0)
    assert rfm_segmentation(to_spark(spark, one).where("false")).count() == 0


def test_rfm_strict_edges(spark):
    frame = event_frame(50).assign(event_type="purchase", timestamp_dt=pd.Timestamp("2024-01-01"))
    df = to_spark(spark, frame)
    assert rfm_segmentation(df).count() > 0
    with pytest.raises(Exception, match="edges are not distinct"):
        rfm_segmentation(df, strict_edges=True).collect()


def test_rfm_rollup_adds_up(spark):
    rows = rfm_rollup(rfm_segmentation(to_spark(spark, event_frame()))).collect()
    assert sum(r.pct for r in rows) == pytest.approx(100, abs=0.3)


def test_funnel_counts_stage_members(spark):
    rows = [("a", s) for s in FUNNEL_STAGES] + [("b", "page_view"), ("c", "purchase"), (None, "search")]
    df = spark.createDataFrame(rows, "user_id string, event_type string")
    got = {r.stage: r for r in compute_funnel(df).collect()}
    assert [got[s].users for s in FUNNEL_STAGES] == [2, 1, 1, 1, 1, 2]
    assert got["search"].dropoff_rate == 0.5 and got["purchase"].dropoff_rate == -1.0
    assert {r.biggest_dropoff for r in got.values()} == {"search"}
    assert got["page_view"].overall_conversion == 1.0


def test_funnel_without_a_top_stage(spark):
    df = spark.createDataFrame([("a", "purchase"), ("b", "other")], "user_id string, event_type string")
    got = {r.stage: r for r in compute_funnel(df).collect()}
    assert got["purchase"].conversion_from_top == 1.0  # divisor 1
    assert got["purchase"].conversion_from_prev == 0.0
    assert got["search"].dropoff_rate == 1.0 and got["search"].biggest_dropoff == "search"
    assert compute_funnel(df.where("false")).count() == len(FUNNEL_STAGES)


def test_funnel_by_segment_is_dense(spark):
    df = spark.createDataFrame(
        [("a", "page_view", "x"), ("b", "other", "y"), ("c", "search", None)],
        "user_id string, event_type string, region string",
    )
    rows = compute_funnel(df, "region").collect()
    assert len(rows) == 2 * len(FUNNEL_STAGES) and {r.region for r in rows} == {"x", "y"}
    assert {r.segment for r in compute_funnel(df, "nope").collect()} == {"overall"}


def test_cohorts_match_pandas(spark):
    frame = event_frame(3000, users=200)
    month = frame["timestamp_dt"].dt.to_period("M")
    first = month.groupby(frame["user_id"]).transform("min")
    since = (month - first).map(lambda d: d.n)
    want = frame.groupby([first.dt.to_timestamp(), since])["user_id"].nunique()
    got = cohort_analysis(to_spark(spark, frame)).collect()
    assert {(r.cohort_month, r.months_since): r.users for r in got} == want.to_dict()
    assert all(r.retention == 1.0 for r in got if r.months_since == 0)
    with pytest.raises(ValueError):
        cohort_analysis(to_spark(spark, frame), "year")


# Standard table values of the F, t and chi-square distributions.
@pytest.mark.parametrize(
    ("f", "d1", "d2", "p"),
    [
        (4.9646, 1, 10, 0.05),
        (3.7083, 3, 10, 0.05),
        (1.96**2, 1, 1e9, 0.05),
        (2.086**2, 1, 20, 0.05),
        (7.8147 / 3, 3, 1e8, 0.05),
        (161.4476, 1, 1, 0.05),
        (0.0, 2, 5, 1.0),
    ],
)
def test_f_tail(f, d1, d2, p):
    assert f_tail(f, d1, d2) == pytest.approx(p, abs=2e-5)


def _chi2_tail_of_3(x):
    """P(X > x) for three degrees of freedom, in closed form."""
    return math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2)


@pytest.mark.parametrize("f", [0.1, 1.0, 2.6, 9.0])
def test_tails_have_no_step(f):
    """From 1e6 to 1e9 degrees of freedom the tail goes smoothly to its limit."""
    limit = _chi2_tail_of_3(3 * f)
    errors = [abs(f_tail(f, 3, d) - limit) * d for d in (1e6, 3e6, 9.9e6, 1.01e7, 1e8, 1e9)]
    # The distance shrinks as 1 / d: d times it hardly changes.
    assert max(errors[:5]) == pytest.approx(min(errors[:5]), rel=2e-2, abs=1e-6)
    assert abs(errors[5]) / 1e9 < 1e-8


def _samples(spark, control, treatment):
    rows = [("control", v) for v in control] + [("treatment", v) for v in treatment]
    return spark.createDataFrame(rows, "variant string, value double")


def test_ab_without_variance(spark):
    same = ab_test_analysis(_samples(spark, [1.0] * 5, [1.0] * 5)).first()
    assert same.p_value is None and same.recommendation == "Inconclusive" and not same.significant
    apart = ab_test_analysis(_samples(spark, [1.0] * 5, [2.0] * 5)).first()
    assert apart.p_value == 0.0 and apart.recommendation == "Ship treatment"
    empty = ab_test_analysis(_samples(spark, [1.0], [])).first()
    assert empty.p_value is None and empty.treatment_size == 0


def test_ab_rejects_a_worse_treatment(spark):
    rng = np.random.default_rng(0)
    row = ab_test_analysis(
        _samples(spark, rng.normal(10, 1, 300).tolist(), rng.normal(9, 1, 300).tolist() + [None])
    ).first()
    assert row.recommendation == "Reject treatment" and row.treatment_size == 300
    assert row.ci_lower < row.ci_upper < 0 and row.lift_pct.endswith("%")


def test_two_proportions(spark):
    row = two_proportion_z(
        _samples(spark, [1.0] * 180 + [0.0] * 720, [1.0] * 279 + [0.0] * 921)
    ).first()
    pooled = 459 / 2100
    z = (279 / 1200 - 0.2) / math.sqrt(pooled * (1 - pooled) * (1 / 900 + 1 / 1200))
    assert row.z == pytest.approx(z, abs=1e-6)
    assert row.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-5)
    nothing = two_proportion_z(_samples(spark, [0.0] * 5, [0.0] * 5)).first()
    assert nothing.p_value is None and nothing.recommendation == "Inconclusive"


def test_week_cohorts(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'2024-01-07 10:00:00'), "
        "('a', TIMESTAMP_NTZ'2024-01-08 10:00:00') AS t(user_id, timestamp_dt)"
    )
    rows = cohort_analysis(df, "week").orderBy("weeks_since").select(F.col("weeks_since")).collect()
    assert [r[0] for r in rows] == [0, 1]


def test_one_revenue_beyond_money(spark):
    """It counts as missing, in every operator and query that sums revenue."""
    frame = event_frame(400, 30).assign(event_type="purchase")
    frame["revenue"] = frame["price"]
    frame.loc[7, "revenue"] = 2e12
    events = to_spark(spark, frame)
    rest = frame.drop(index=7)
    users = rfm_segmentation(events)
    got = {r.user_id: r.monetary for r in users.collect()}
    assert got == pytest.approx(
        frame["user_id"].drop_duplicates().to_frame().merge(
            rest.groupby("user_id")["revenue"].sum().reset_index(), how="left"
        ).fillna(0).set_index("user_id")["revenue"].to_dict()
    )
    assert sum(r["count"] for r in rfm_rollup(users).collect()) == frame["user_id"].nunique()
    total = rest["revenue"].sum()
    assert sum(r.user_total_revenue or 0 for r in user_features(events).collect()) == pytest.approx(total)
    assert sum(r.session_revenue or 0 for r in session_features(events).collect()) == pytest.approx(total)
    hourly = hourly_kpis(events)
    tables = {"hourly": hourly, "events": events}
    for name, column in (("top_categories", "total_revenue"), ("raw_daily_revenue", "revenue"), ("daily_revenue", "total_revenue"), ("hourly_kpis", "total_revenue")):
        rows = run_saved_query(spark, name, tables).collect()
        assert sum(r[column] or 0 for r in rows) == pytest.approx(total, abs=0.3), name
    # A user's sum may be larger than a single amount can be.
    rich = to_spark(spark, event_frame(50, 2).assign(event_type="purchase", revenue=9e11))
    assert max(r.avg_revenue for r in rfm_rollup(rfm_segmentation(rich)).collect()) > 1e13

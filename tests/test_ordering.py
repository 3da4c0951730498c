import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import (
    RANK,
    equal_frequency_cuts,
    global_rank,
    group_number,
    order_statistics,
    over_frame,
)
from pulsetrail.operators.selection import select_ranks


def _values(spark, values):
    return spark.createDataFrame(
        pd.DataFrame({"id": range(len(values)), "v": np.asarray(values, dtype="float64")}),
        "id long, v double",
    )


def test_rank_matches_pandas_with_heavy_ties(spark):
    rng = np.random.default_rng(1)
    values = np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 50, 3000))
    df = _values(spark, values).repartition(13)
    got = {r.id: r[RANK] for r in global_rank(df, ["v", "id"]).collect()}
    want = pd.Series(values).rank(method="first").astype(int)
    assert got == dict(enumerate(want))


def test_rank_never_uses_one_partition(spark):
    plan = global_rank(_values(spark, range(100)), ["v", "id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step sums one row per shuffle partition.
    assert text.count("SinglePartition") <= 1


def test_rank_of_nothing(spark):
    assert global_rank(_values(spark, []), ["v", "id"]).count() == 0


@pytest.mark.parametrize("chunk", [24, 50, 1000])
def test_chunked_frames_match_one_window(spark, chunk):
    rng = np.random.default_rng(2)
    df = _values(spark, rng.normal(size=333)).withColumn("s", F.col("id") % 2)

    def look(rows, over):
        return rows.withColumns(
            {
                "sum": F.sum("v").over(over.rowsBetween(-7, 3)),
                "n": F.count("v").over(over.rowsBetween(-7, 3)),
                "ahead": F.lead("v", 3).over(over),
            }
        )

    ranked = global_rank(df, ["s", "id"])
    chunked = over_frame(ranked, look, 7, 3, series=["s"], chunk_rows=chunk)
    whole = look(ranked, Window.partitionBy("s").orderBy(RANK))
    a = chunked.orderBy(RANK).toPandas()[["id", "s", "sum", "n", "ahead"]]
    b = whole.orderBy(RANK).toPandas()[["id", "s", "sum", "n", "ahead"]]
    pd.testing.assert_frame_equal(a, b, rtol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_match_numpy(spark, n):
    values = np.random.default_rng(n).normal(size=n).round(1)
    p = (0.0, 0.03, 0.25, 0.5, 0.9, 1.0)
    row = order_statistics(_values(spark, values), "v", p).first()
    assert list(row)[:-1] == pytest.approx(list(np.quantile(values, p)), abs=1e-12)
    assert row.n == n


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 11, 47, 100])
def test_quintiles_match_qcut(spark, n):
    values = np.random.default_rng(n).integers(0, 6, n)
    df = _values(spark, values)
    cuts = equal_frequency_cuts(df, ["v", "id"])
    scored = df.withColumns(
        {"cuts": cuts.select("cuts").scalar(), "n": cuts.select("n").scalar()}
    ).select("id", group_number(F.col("cuts"), F.col("n"), ["v", "id"]).alias("g"))
    got = [r.g for r in scored.orderBy("id").collect()]
    if n == 1:
        assert got == [3]
    else:
        ranks = pd.Series(values).rank(method="first")
        assert got == pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


# ---- selection by radix


def _selected(df, keys, ranks, **options):
    n, found = select_ranks(df, keys, lambda n: [r for r in ranks if r <= n], **options)
    return n, [found[r] for r in sorted(found)]


EXTREMES = [
    0.0, -0.0, 5e-324, -5e-324, 1e-320, 1e-200, 1.0000001e-200, 1e-5, 1.0, math.nextafter(1.0, 2.0),
    math.nextafter(1.0, 0.0), 3.5, -3.5, 1e16, 1e300, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan, math.nan,
]


@pytest.mark.parametrize("gathered", [0, 7, 1000])
def test_selection_of_doubles_of_any_size(spark, gathered):
    values = EXTREMES * 3 + list(np.random.default_rng(1).normal(size=300) * 1e-3)
    df = _values(spark, values).repartition(7)
    ranks = [1, 2, 3, 30, 60, 61, 100, 180, 250, 300, len(values) - 7, len(values) - 5, len(values)]
    n, got = _selected(df, ["v"], ranks, gathered=gathered)
    order = sorted(values, key=lambda v: (math.isnan(v), v))
    assert n == len(values)
    np.testing.assert_array_equal([v for (v,) in got], [order[r - 1] for r in ranks])


@pytest.mark.parametrize("gathered", [0, 1000])
def test_selection_by_several_keys_with_heavy_ties(spark, gathered):
    rng = np.random.default_rng(4)
    rows = [
        (int(rng.integers(0, 4)), Decimal(int(rng.integers(0, 3))) / 8, f"user_{i:05d}"[: rng.integers(3, 11)] + "é" * (i % 2), i - 700)
        for i in range(1500)
    ]
    rows += [(2**63 - 1, Decimal("12345678901234567890.123456"), "", 0), (-(2**63), Decimal("-0.000001"), "z", 1)]
    df = spark.createDataFrame(rows, "a long, b decimal(38,6), c string, d int").repartition(5)
    ranks = [1, 2, 375, 376, 700, 900, 1200, 1501, 1502]
    for keys in (["a", "c", "d"], ["b", "d"], ["c", "d"], ["d", "b", "c"]):
        places = ["abcd".index(k) for k in keys]
        order = sorted(tuple(r[p] for p in places) for r in rows)
        assert _selected(df, keys, ranks, gathered=gathered) == (len(rows), [order[r - 1] for r in ranks])


def test_selection_sorts_and_writes_nothing(spark, monkeypatch):
    from pulsetrail.operators import selection

    seen = []
    divide = selection._divide

    def spy(df, *args):
        seen.append(df)
        return divide(df, *args)

    monkeypatch.setattr(selection, "_divide", spy)
    df = spark.range(100_000).select((F.hash("id") % 1000).cast("double").alias("v"))
    n, found = select_ranks(df, ["v"], lambda n: [n // 2], gathered=10)
    assert seen and all(d is df for d in seen)
    assert found == {n // 2: (df.agg(F.percentile("v", (n // 2 - 1) / (n - 1))).first()[0],)}


def test_selection_from_nothing(spark):
    empty = _values(spark, [])
    assert select_ranks(empty, ["v"], lambda n: [1]) == (0, {})
    assert order_statistics(empty, "v", (0.5,)).count() == 0
    assert equal_frequency_cuts(empty, ["v", "id"]).count() == 0
    with pytest.raises(TypeError):
        select_ranks(spark.sql("select current_date() as d"), ["d"], lambda n: [1])

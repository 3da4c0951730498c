import numpy as np
import pandas as pd
import pytest
from frames import to_spark

from pulsetrail.operators import comoments
from pulsetrail.operators.comoments import Moments, lagged_moments, merged

LAGS = 2


def _frame(n, seed, region):
    rng = np.random.default_rng(seed)
    return pd.DataFrame(
        {
            "hour_bucket": pd.date_range("2024-01-01", periods=n, freq="h"),
            "region": region,
            "a": 1e9 + rng.normal(size=n),
            "b": rng.normal(size=n).cumsum(),
            "flat": np.full(n, 0.1),
        }
    )


def _states(rows, ages):
    found = [
        Moments(r.n, np.array(r["mean"]), np.array(r["products"]).reshape(9, 9)) for r in rows if r["_age"] in ages
    ]
    return merged(found)


def test_merging_equals_one_matrix():
    x = np.random.default_rng(1).normal(1e8, 3.0, (500, 4))
    x[:, 3] = 0.1
    parts = merged(Moments.of(part) for part in np.split(x, [1, 7, 300]))
    whole = x - x.mean(axis=0)
    assert parts.n == 500 and parts.mean == pytest.approx(x.mean(axis=0))
    assert parts.products[:3, :3] == pytest.approx((whole.T @ whole)[:3, :3], rel=1e-8)
    assert not parts.products[3].any()  # a constant has no deviation at all
    assert merged([]) is None


@pytest.mark.parametrize("states", [1_000, 1])
def test_lagged_moments_per_series(spark, monkeypatch, states):
    monkeypatch.setattr(comoments, "STATES", states)
    frames = [_frame(90, 2, "x"), _frame(2, 3, "y"), _frame(40, 4, None)]
    df = to_spark(spark, pd.concat(frames)).repartition(4)
    found = lagged_moments(df, ["a", "b", "flat"], LAGS, ["region"], ["hour_bucket"]).collect()
    for frame in frames:
        region = frame["region"].iloc[0]
        rows = [r for r in found if r["region"] == region]
        assert sum(r["n"] for r in rows) == len(frame)
        assert {r["_age"] for r in rows} == set(range(min(len(frame), LAGS + 1)))
        full = _states(rows, {LAGS})
        if full is None:
            continue
        lagged = np.column_stack(
            [frame[m].shift(k).to_numpy()[LAGS:] for m in ("a", "b", "flat") for k in range(LAGS + 1)]
        )
        centred = lagged - lagged.mean(axis=0)
        assert full.n == len(lagged) and full.mean == pytest.approx(lagged.mean(axis=0))
        assert full.products == pytest.approx(centred.T @ centred, rel=1e-6, abs=1e-6)


def test_no_row_is_repeated_per_pair_or_lag(spark):
    df = to_spark(spark, _frame(50, 5, "x"))
    plan = lagged_moments(df, ["a", "b"], LAGS, [], ["hour_bucket"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1  # the rows that chunks borrow at their edges
    nothing = lagged_moments(df.where("false"), ["a", "b"], LAGS, ["region"], ["hour_bucket"])
    assert nothing.collect() == []

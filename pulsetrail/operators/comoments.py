"""One matrix of co-moments over all metrics and all their lags.

Correlations and lagged regressions of any pair of metrics need only counts, means and
sums of products of deviations. A task adds these up per Arrow batch with one matrix
product, around the mean of the batch, and merges them pairwise around the common mean,
so that large levels lose no digits. What is shuffled is one state per task, series and
age; no row is repeated per pair or lag.

The age of a row is the number of lags it has, at most ``max_lag``: a regression on k lags
takes the rows of age k or more.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import filled, present
from pulsetrail.operators.ordering import global_rank, over_frame

# States a task holds before it sends them on: one has (metrics * (lags + 1))^2 numbers.
STATES = 1_000
AGE, VALUES = "_age", "_values"
STATE = "n long, mean array<double>, products array<double>"


@dataclass
class Moments:
    """Count, means, and sums of products of deviations from the means."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        # From the first row on, so that a constant column has no deviation at all.
        shifted = x - x[0]
        mean = shifted.mean(axis=0)
        centred = shifted - mean
        return cls(len(x), x[0] + mean, centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)


def merged(states: Iterable[Moments]) -> Moments | None:
    total = None
    for state in states:
        total = state if total is None else total.merge(state)
    return total


def _per_task(keys: list[str], width: int):
    """Arrow batches to one state per key of the task."""

    def send(held: dict[tuple, Moments], schema: pa.Schema) -> pa.RecordBatch:
        states = list(held.values())
        columns = [pa.array([key[i] for key in held], schema.field(name).type) for i, name in enumerate(keys)]
        return pa.record_batch(
            [
                *columns,
                pa.array([s.n for s in states], pa.int64()),
                pa.array([s.mean for s in states], pa.list_(pa.float64())),
                pa.array([s.products.ravel() for s in states], pa.list_(pa.float64())),
            ],
            names=[*keys, "n", "mean", "products"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            if not batch.num_rows:
                continue
            x = batch[VALUES].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            codes = np.zeros(len(x), np.int64)
            for name in keys:
                column = batch[name].dictionary_encode(null_encoding="encode")
                codes = codes * len(column.dictionary) + column.indices.to_numpy(zero_copy_only=False)
                codes = np.unique(codes, return_inverse=True)[1]
            order = np.argsort(codes, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(codes[order])) + 1).tolist(), len(order)]
            first = batch.take(pa.array(order[edges[:-1]]))
            names = zip(*[first[name].to_pylist() for name in keys])
            for key, low, high in zip(names, edges, edges[1:]):
                state = Moments.of(x[order[low:high]])
                held[key] = held[key].merge(state) if key in held else state
            if len(held) > STATES:
                yield send(held, schema)
                held = {}
        if held:
            yield send(held, schema)

    return run


def lagged_moments(
    df: DataFrame, metrics: Sequence[str], max_lag: int, series: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """States per (series, age): n, mean and products of metric i at lag k, in order (i, k).

    Several rows may have the same series and age, to be merged. Lags that a row of that
    age does not have are zero.
    """
    keys = [*series, *[k for k in present(df, order) if k not in series]]
    names = [f"_{i}" for i in range(len(metrics))]
    rows = df.select(*keys, *[filled(m).alias(n) for m, n in zip(metrics, names)])
    lags = range(max_lag + 1)

    def lagged(frame: DataFrame, over: WindowSpec) -> DataFrame:
        before = F.count(F.lit(1)).over(over.rowsBetween(-max_lag, -1)) if max_lag else F.lit(0)
        values = [F.coalesce(F.lag(n, k).over(over), F.lit(0.0)) if k else F.col(n) for n in names for k in lags]
        return frame.withColumns({AGE: before.cast("int"), VALUES: F.array(*values)})

    ranked = global_rank(rows, keys)
    with_lags = over_frame(ranked, lagged, max_lag, series=series).select(*series, AGE, VALUES)
    kept = [*series, AGE]
    fields = [f"`{name}` {with_lags.schema[name].dataType.simpleString()}" for name in kept]
    return with_lags.mapInArrow(
        _per_task(kept, len(metrics) * len(lags)), ", ".join([*fields, STATE])
    )


# Workers need no installed copy of this package to run the functions above.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Isolation forest: hash-sampled trees built in parallel, scored by Arrow batches.

Each tree sees at most ``sample_rows`` rows, so a tree is one small task whatever the
size of the table, and the model is bounded by trees x nodes. Random numbers come
from hashes of the row ids and the seed: scores do not depend on partitioning.
Splits are axis-parallel and uniform between a feature's extremes, so standardising
the features first would not change the trees.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import filled
from pulsetrail.materialize import materialize
from pulsetrail.operators.ordering import order_statistics
from pulsetrail.operators.skew import shuffle_partitions

TREES = 100
SAMPLE_ROWS = 256
SEED = 42
_NODE_SCHEMA = "tree int, node int, feature int, split double, low int, high int, path double"
_RESOLUTION = float(1 << 53)


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 3.0)
    deep = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, deep))


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (feature, split, low child, high child, path length if a leaf)."""
    nodes: list[list] = [[-1, 0.0, -1, -1, 0.0]]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(usable):
            nodes[node][4] = depth + float(mean_path(len(rows)))
            continue
        feature = int(rng.choice(usable))
        split = float(rng.uniform(low[feature], high[feature]))
        goes_low = part[:, feature] <= split
        first = len(nodes)
        nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
        nodes[node][:4] = feature, split, first, first + 1
        todo += [(first, rows[goes_low], depth + 1), (first + 1, rows[~goes_low], depth + 1)]
    return [tuple(n) for n in nodes]


def _sample(rows: DataFrame, id_cols: Sequence[str], trees: int, size: int, seed: int) -> DataFrame:
    """(tree, row) pairs: the ``size`` rows with the smallest hashes for each tree.

    A threshold hash keeps about twice that many before the exact cut, so the window
    per tree never sees more than a few hundred rows.
    """

    def draw(tree):
        bits = F.shiftrightunsigned(F.xxhash64(tree, F.lit(seed), F.col("_id")), 11)
        return bits / F.lit(_RESOLUTION)

    share = 2.0 * size / F.greatest(rows.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    chosen = (
        rows.withColumn("_id", F.xxhash64(*id_cols))
        .withColumn("_share", share)
        .withColumn(
            "tree",
            F.explode(
                F.filter(
                    F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.col("_share")
                )
            ),
        )
    )
    # A set number of partitions: the sample is tiny, so AQE would put all trees into
    # one task, but building them is the expensive part.
    chosen = chosen.repartition(min(trees, shuffle_partitions(rows)), "tree")
    nearest = Window.partitionBy("tree").orderBy(draw(F.col("tree")), *id_cols)
    return chosen.withColumn("_place", F.row_number().over(nearest)).where(F.col("_place") <= size)


def fit(
    df: DataFrame,
    features: Sequence[str],
    id_cols: Sequence[str],
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Node table of the forest: at most ``trees * (2 * sample_rows - 1)`` rows."""
    names = [f"_f{i}" for i in range(len(features))]
    rows = df.select(*id_cols, *[filled(f).alias(n) for f, n in zip(features, names)])

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("_place")[names].to_numpy(dtype="float64")
        depth = math.ceil(math.log2(max(min(sample_rows, len(x)), 2)))
        nodes = grow_tree(x, np.random.default_rng(seed + tree), depth)
        out = pd.DataFrame(nodes, columns=["feature", "split", "low", "high", "path"])
        return out.assign(tree=tree, node=range(len(out)))[
            ["tree", "node", "feature", "split", "low", "high", "path"]
        ]

    sample = _sample(rows, id_cols, trees, sample_rows, seed).select("tree", "_place", *names)
    return sample.groupBy("tree").applyInPandas(build, _NODE_SCHEMA)


def score(
    df: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    sample_size: int,
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``anomaly_score``: near -1 for isolated rows, near -0.5 and above otherwise.

    The model goes to the executors as a broadcast; its size is fixed by the
    parameters and checked, and does not grow with the data.
    """
    limit = trees * (2 * sample_rows - 1)
    table = nodes.limit(limit + 1).toPandas().sort_values(["tree", "node"])
    if len(table) > limit:
        raise ValueError(f"forest has more than {limit} nodes")
    starts = table.groupby("tree").size().cumsum().shift(fill_value=0)
    shift = table["tree"].map(starts).to_numpy()
    inner = (table["feature"] >= 0).to_numpy()
    model = df.sparkSession.sparkContext.broadcast(
        {
            "roots": starts.to_numpy(),
            "feature": table["feature"].to_numpy(),
            "split": table["split"].to_numpy(),
            "low": np.where(inner, table["low"].to_numpy() + shift, -1),
            "high": np.where(inner, table["high"].to_numpy() + shift, -1),
            "path": table["path"].to_numpy(),
        }
    )
    normal = float(mean_path(sample_size)) or 1.0

    @F.pandas_udf("double")
    def anomaly_score(*columns: pd.Series) -> pd.Series:
        m = model.value
        x = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
        rows, depth = np.arange(len(x)), np.zeros(len(x))
        for root in m["roots"]:
            at = np.full(len(x), root)
            moving = rows if m["feature"][root] >= 0 else rows[:0]
            while len(moving):
                here = at[moving]
                goes_low = x[moving, m["feature"][here]] <= m["split"][here]
                at[moving] = np.where(goes_low, m["low"][here], m["high"][here])
                moving = moving[m["feature"][at[moving]] >= 0]
            depth += m["path"][at]
        return pd.Series(-np.exp2(-depth / (max(len(m["roots"]), 1) * normal)))

    return df.withColumn("anomaly_score", anomaly_score(*[filled(f) for f in features]))


def isolation_forest_detection(
    df: DataFrame,
    features: Sequence[str],
    contamination: float = 0.03,
    id_cols: Sequence[str] = ("hour_bucket", "region", "device"),
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Label the most isolated share of the rows.

    Adds ``anomaly_label`` (-1 or 1), ``anomaly_score`` and ``is_anomaly``. The cut
    is the ``contamination`` quantile of the scores. ``id_cols`` must identify a row.
    """
    rows = materialize(df)
    nodes = materialize(fit(rows, features, id_cols, trees, sample_rows, seed))
    sample_size = min(sample_rows, rows.count())
    scored = materialize(score(rows, nodes, features, sample_size, trees, sample_rows))
    cut = order_statistics(scored, "anomaly_score", (contamination,)).first()
    odd = F.col("anomaly_score") < F.lit(None if cut is None else cut.q0).cast("double")
    return scored.withColumn("anomaly_label", F.when(odd, -1).otherwise(1)).withColumn(
        "is_anomaly", odd
    )


# Workers need no installed copy of this package to run the functions above.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

Vectors and centroids are integers, and so are their Walsh-Hadamard coefficients. The sum
of squared differences of the coefficients is the squared distance times the number of
components, and grows with every coefficient that is added. So a centroid whose sum over
the first, coarse coefficients already exceeds the whole sum of another one is strictly
worse, and is not looked at again. Coefficients come in order of sign changes, coarse to
fine; what is left at the end has all of them, and the least distance and the smaller
number win. All sums are exact.

Spark scans the vectors once a round, in numpy per Arrow batch. A task sends one row per
centroid with the count and the sums of its vectors; the new centroids, ``clusters`` rows,
are all that comes to the driver. Nothing is grouped by vector, so vectors that repeat are
no hot group.

Defined cases: a vector is kept if it has ``DIMENSIONS`` components, none null, not a
number or infinite, or beyond +-``LARGEST`` once scaled (squared distances beyond it do
not fit a long). Rows that repeat an id are vectors of their own; a vector without an id
comes last when the first centroids are drawn, and vectors with equal hashes are drawn in
their own order. With fewer vectors than ``clusters`` there are as many centroids as
vectors; equal centroids are allowed, and the smaller number gets the vectors. An empty
table gives an empty result. A sum of distances that does not fit a long is null. Columns
other than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import bounded
from pulsetrail.materialize import materialize, release

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
LARGEST = 2**27
# Coefficients of integers up to this square and add up within 64 bits.
_LONG = 2**24
# Coefficients that are added at a time, coarse to fine.
STEPS = (4, 8, 16, 32, 64)
_ROWS = 2_048


def _butterflies(x: np.ndarray) -> np.ndarray:
    count, size = x.shape
    step = 1
    while step < size:
        halves = x.reshape(count, size // (2 * step), 2, step)
        low, high = halves[:, :, 0], halves[:, :, 1]
        x = np.stack([low + high, low - high], axis=2).reshape(count, size)
        step *= 2
    return x


_BASIS = _butterflies(np.eye(DIMENSIONS, dtype=np.int64))
_BY_SIGN_CHANGES = np.argsort((np.diff(_BASIS, axis=1) != 0).sum(axis=1))


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Coefficients of every row, by the number of sign changes."""
    return _butterflies(x)[:, _BY_SIGN_CHANGES]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every vector, and the squared distance."""
    if not len(vectors):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    peak = max(int(np.abs(vectors).max()), int(np.abs(centroids).max()))
    kind = np.int64 if peak <= _LONG else object
    v, c = walsh_hadamard(vectors.astype(kind)), walsh_hadamard(centroids.astype(kind))
    done = STEPS[0]
    coarse = ((v[:, None, :done] - c[None, :, :done]) ** 2).sum(axis=2)
    # The best by the coarse coefficients is finished at once: its sum bounds the others.
    bound = ((v - c[coarse.argmin(axis=1)]) ** 2).sum(axis=1)
    row, number = np.nonzero(coarse <= bound[:, None])
    total = coarse[row, number]
    for upto in STEPS[1:]:
        total = total + ((v[row, done:upto] - c[number, done:upto]) ** 2).sum(axis=1)
        left = total <= bound[row]
        row, number, total = row[left], number[left], total[left]
        done = upto
    if kind is np.int64:
        order = np.lexsort((number, total, row))
    else:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], total[i], number[i])))
    first = order[np.searchsorted(row[order], np.arange(len(vectors)))]
    return number[first].astype(np.int32), (total[first] // DIMENSIONS).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            part = batch.slice(low, _ROWS)
            flat = part["vector"].flatten().to_numpy(zero_copy_only=False)
            yield part, flat.astype(np.int64).reshape(part.num_rows, DIMENSIONS)


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: count and component sums of the vectors of each centroid."""

    def run(batches):
        members = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), DIMENSIONS), np.int64)
        for _, vectors in _parts(batches):
            number, _ = nearest(vectors, centroids)
            np.add.at(members, number, 1)
            np.add.at(sums, number, vectors)
        used = np.flatnonzero(members)
        yield pa.record_batch(
            {
                "cluster": pa.array(used.astype(np.int32)),
                "members": pa.array(members[used]),
                "sums": pa.array(list(sums[used]), pa.list_(pa.int64())),
            }
        )

    return run


def _labels(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for part, vectors in _parts(batches):
            number, distance = nearest(vectors, centroids)
            yield pa.record_batch(
                {"vec_id": part["vec_id"], "cluster": pa.array(number), "distance": pa.array(distance)}
            )

    return run


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``, the integers floor(scale * x), of the vectors that are kept."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    fits = F.forall("scaled", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(float(LARGEST))))
    return (
        table.where(F.size("embedding") == DIMENSIONS)
        .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("scaled"))
        .where(fits)
        .select("vec_id", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("vector"))
    )


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least hashes of their ids, in order of the hashes."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = (
        vectors.select(place.alias("place"), "vector")
        .orderBy(F.col("place").asc_nulls_last(), "vector")
        .limit(clusters)
        .collect()
    )
    return np.array([row["vector"] for row in drawn], np.int64).reshape(len(drawn), DIMENSIONS)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as floor means of their vectors; one without vectors stays."""
    added = (
        bounded(vectors)
        .mapInArrow(_sums(centroids), "cluster int, members long, sums array<long>")
        .select("cluster", "members", F.posexplode("sums").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum("members").alias("members"), F.sum("part").alias("total"))
    )
    new = centroids.copy()
    for row in added.collect():  # a row per centroid and component
        new[row["cluster"], row["at"]] = row["total"] // row["members"]
    return new


def cluster_vectors(
    table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid."""
    spark = table.sparkSession
    vectors = materialize(whole_vectors(table, scale))
    centroids = first_centroids(vectors, clusters, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids)
    if len(centroids):
        found = bounded(vectors).mapInArrow(_labels(centroids), "vec_id long, cluster int, distance long")
    else:
        found = vectors.selectExpr("vec_id", "0 as cluster", "0L as distance")
    found = materialize(found)
    release(vectors)
    # At most ``clusters`` rows.
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("own")).collect()
    whole = None if any(row["own"] is None for row in sums) else sum(row["own"] for row in sums)
    if whole is not None and whole >= 2**63:
        whole = None
    described = spark.createDataFrame(
        [(row["cluster"], row["own"], whole, centroids[row["cluster"]].tolist()) for row in sums],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return found.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )

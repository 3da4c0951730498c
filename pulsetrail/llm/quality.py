"""Quality scores: kernel ridge regression on document statistics.

Every text becomes about thirty statistics (lengths, shares of character classes, words
and repetitions). Random Fourier features, cosines of random projections of the
standardised statistics, approximate a Gaussian kernel on them. The ridge weights solve
normal equations whose matrices are summed inside each partition, so what is shuffled and
solved depends on the number of features alone. Raw scores are calibrated by isotonic
regression on counts in ``BINS`` bins of the training scores.

Learning uses every labelled row it is given; no sample is drawn. What reaches the driver
is one matrix of ``FEATURES`` squared and one row per bin.

Defined cases: a null text is the empty text, which has statistics and a score as any
other; labels without an id or a value are not used; of several labels of an id the
average counts, from 0.5 as 1; without labels every score is 0.5, and with one kind of
label it is that label; equal texts score equally; rows repeat as they come; columns other
than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import Words, map_texts, split_ascii, text_sums
from pulsetrail.materialize import materialize

FEATURES = 256
GAMMA = 0.02  # the kernel is exp(-GAMMA * squared distance)
RIDGE = 1e-3  # of the number of training rows
BINS = 2_000
SEED = 5
# Part of the raw score in the calibrated one, which orders texts of one isotonic step.
TIE_SHARE = 1e-3

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:",
    "shout": b"!?",
    "quote": b"'\"`",
    "bracket": b"()[]{}<>",
    "bar": b"|",
    "symbol": b"#$%&*@^~",
    "line": b"-_=+/\\",
    "other": bytes([*range(9), *range(14, 32), 127]),
    "wide": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros(256, np.int64)
for _number, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _number
_WORD_SHARES = 6
STATISTICS = 4 + len(_CLASSES) + _WORD_SHARES + 5


def _per_word(words: Words) -> np.ndarray:
    """Bytes of each class in the distinct words, and what kind of word it is."""
    distinct = words.distinct
    size = len(distinct)
    if not size:
        return np.zeros((0, len(_CLASSES) + _WORD_SHARES))
    offsets = np.frombuffer(distinct.buffers()[1], np.int32)[distinct.offset : distinct.offset + size + 1]
    data = np.frombuffer(distinct.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word_of = np.repeat(np.arange(size), np.diff(offsets))
    classes = len(_CLASSES)
    counts = np.bincount(word_of * classes + _CLASS_OF[data], minlength=size * classes).reshape(size, classes)
    length = np.diff(offsets)
    name = list(_CLASSES).index
    letters = counts[:, [name("lower"), name("upper"), name("wide")]].sum(axis=1)
    initial = _CLASS_OF[data[offsets[:-1]]]
    kinds = [
        initial == name("upper"),
        (counts[:, name("upper")] > 1) & (counts[:, name("lower")] == 0),
        letters == 0,
        length > 20,
        length <= 2,
        counts[:, [name("symbol"), name("shout"), name("bar")]].sum(axis=1) > 0,
    ]
    return np.concatenate([counts, np.stack(kinds, axis=1)], axis=1).astype(float)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS numbers per text."""
    words = split_ascii(texts)
    size = np.diff(words.starts)
    rows = len(size)
    count = np.maximum(size, 1)
    # One column at a time: all of them for all words would be most of the memory.
    sums = np.column_stack([text_sums(c[words.codes], words.starts) for c in _per_word(words).T])
    classes, kinds = sums[:, : len(_CLASSES)], sums[:, len(_CLASSES) :]
    letters = classes.sum(axis=1)
    bytes_ = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    lines = pc.fill_null(pc.count_substring(texts, "\n"), 0).to_numpy(zero_copy_only=False)
    text_of = np.repeat(np.arange(rows), size)
    codes = words.codes.astype(np.int64)
    same = np.zeros(len(codes))
    same[1:] = (codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])
    pair, uses = np.unique(text_of * (len(words.distinct) + 1) + codes, return_counts=True)
    owner = pair // (len(words.distinct) + 1)
    kinds_used = np.bincount(owner, minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, owner, uses)
    entropy = np.bincount(owner, weights=uses * np.log(uses), minlength=rows)
    return np.column_stack(
        [
            np.log1p(bytes_),
            np.log1p(size),
            letters / count,
            np.log1p(lines),
            np.sqrt(classes / np.maximum(letters, 1)[:, None]),
            kinds / count[:, None],
            text_sums(same, words.starts) / count,
            kinds_used / count,
            most / count,
            np.log(count) - entropy / count,
            lines / count,
        ]
    )


def _projection(features: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * GAMMA), (STATISTICS, features)), rng.uniform(0, 2 * np.pi, features)


class Kernel:
    """Standardised statistics to a constant and random Fourier features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = SEED):
        self.mean, self.scale = mean, np.where(scale > 1e-9, scale, 1.0)
        self.weights, self.phases = _projection(features, seed)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # Far outliers would only turn the cosines round: they are brought to the edge.
        z = np.clip((x - self.mean) / self.scale, -10, 10)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([np.ones(len(x)), waves])


def isotonic(position: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and levels of the best rising steps through values sorted by position."""
    steps: list[list[float]] = []
    for p, v, w in zip(position, value, weight):
        steps.append([p * w, v * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    table = np.array(steps)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def _array(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return batch[column].flatten().to_numpy().reshape(batch.num_rows, STATISTICS)


def _normal_equations(kernel: Kernel):
    """One row per cell of the summed matrix of a partition: place, sum."""

    def run(batches):
        size = len(kernel.phases) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = kernel(_array(batch))
            total += z.T @ np.column_stack([z, batch["label"].to_numpy()])
        cells = total.ravel()
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(cells[used])], names=["place", "part"])

    return run


def _raw(kernel: Kernel, weights: np.ndarray):
    def run(batches):
        for batch in batches:
            raw = pa.array(kernel(_array(batch)) @ weights)
            yield pa.RecordBatch.from_arrays([batch["label"], raw], names=["label", "raw"])

    return run


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, x: the statistics of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch["text"])
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), STATISTICS)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], lists.cast(pa.list_(pa.float64()))], names=["doc_id", "x"]
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(rows, work, "doc_id long, x array<double>")


def _constant(described: DataFrame, value: float) -> DataFrame:
    return described.select("doc_id", F.lit(value).alias("score"))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row of ``docs``, learned from ``labels`` (doc_id, quality)."""
    described = materialize(describe(docs))
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    )
    training = materialize(described.join(known, "doc_id"))
    columns = [F.get("x", F.lit(i)) for i in range(STATISTICS)]
    moments = training.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("label").alias("share"),
        F.array(*[F.avg(c) for c in columns]).alias("mean"),
        F.array(*[F.stddev_pop(c) for c in columns]).alias("scale"),
    ).first()
    if not moments["n"]:
        return _constant(described, 0.5)
    if moments["share"] in (0.0, 1.0):
        return _constant(described, moments["share"])
    kernel = Kernel(np.array(moments["mean"]), np.array(moments["scale"]))
    size = len(kernel.phases) + 1
    cells = (
        training.select("x", "label")
        .mapInArrow(_normal_equations(kernel), "place long, part double")
        .groupBy("place")
        .agg(F.sum("part").alias("total"))
        .toPandas()
    )
    total = np.zeros(size * (size + 1))
    total[cells["place"]] = cells["total"]
    total = total.reshape(size, size + 1)
    penalty = np.full(size, RIDGE * moments["n"] / size)
    penalty[0] = 0.0
    weights = np.linalg.solve(total[:, :size] + np.diag(penalty + 1e-9), total[:, size])
    raw = training.select("x", "label").mapInArrow(_raw(kernel, weights), "label double, raw double")
    # Raw scores are near 0 and 1; what is beyond -0.5 and 1.5 shares the outer bins.
    bin_ = F.floor(F.least(F.greatest((F.col("raw") + 0.5) / 2, F.lit(0.0)), F.lit(1.0)) * BINS)
    binned = (
        raw.groupBy(bin_.alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).alias("n"))
        .toPandas()
        .sort_values("bin")
    )
    centres, levels = isotonic(binned["raw"].to_numpy(), binned["label"].to_numpy(), binned["n"].to_numpy())

    def run(batches):
        for batch in batches:
            raw = kernel(_array(batch)) @ weights
            rank = 1.0 / (1.0 + np.exp(-8 * (np.clip(raw, -10, 10) - 0.5)))
            score = (1 - TIE_SHARE) * np.interp(raw, centres, levels) + TIE_SHARE * rank
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.clip(score, 0.0, 1.0))], names=["doc_id", "score"]
            )

    return described.mapInArrow(run, "doc_id long, score double")

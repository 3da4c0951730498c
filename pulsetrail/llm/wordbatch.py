"""Arrow batches of texts as codes into the batch's distinct words.

Words repeat, so work per word is done once per distinct word of a batch and spread to
the texts by array operations. Memory is that of one batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pulsetrail.session import ship_package

# Spark sends rows of about this many bytes at once, and they are worked on in parts of
# about this size: that bounds the memory of a task on both sides.
BATCH_CHARS = 8_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@dataclass
class Words:
    """``distinct[codes]`` are the words; text t has those from ``starts[t]`` on."""

    codes: np.ndarray
    distinct: pa.Array
    starts: np.ndarray  # one more than texts


def _whole(array) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def split_ascii(texts: pa.Array) -> Words:
    """Runs of characters other than ASCII white space; a null text has none."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    return _coded(pc.ascii_split_whitespace(trimmed), drop_empty=True)


def split_on(texts: pa.Array, separator: str) -> Words:
    """The pieces between separators, empty ones included."""
    return _coded(pc.split_pattern(pc.fill_null(texts, ""), separator), drop_empty=False)


def _coded(lists: pa.Array, drop_empty: bool) -> Words:
    lists = _whole(lists)
    starts = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(starts[0], starts[-1] - starts[0])
    starts = starts - starts[0]
    if drop_empty:
        full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        if not full.all():
            starts = np.concatenate([[0], np.cumsum(full)])[starts]
            flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(), coded.dictionary, starts)


def text_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of per-word values (words, ...) over the words of each text."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def give_back() -> None:
    """Return what Arrow and numpy have freed to the system.

    Workers stay for later stages, and would hold the memory of their largest part.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(
    batch: pa.RecordBatch, column: str = "text", part_chars: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``part_chars`` (BATCH_CHARS) bytes of text each."""
    part_chars = part_chars or BATCH_CHARS
    size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // part_chars
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), len(size)]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def per_slice(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    column: str = "text",
    part_chars: int = BATCH_CHARS,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that runs ``work`` on every part of every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = out = None
            for part in slices(batch, column, part_chars):
                out = work(part)
                if out is not None:
                    yield out
            del batch, part, out
            give_back()

    return run


def bounded(df: DataFrame) -> DataFrame:
    """``df``, in a session whose workers have this package and get bounded batches.

    The setting changes how many rows travel at once, never a result.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_CHARS))
    return df


def map_texts(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    part_chars: int = BATCH_CHARS,
) -> DataFrame:
    """``df`` through ``work``, in parts of bounded size."""
    return bounded(df).mapInArrow(per_slice(work, part_chars=part_chars), schema)


def ragged_take(values: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenated lists of ``codes``; list c is ``lengths[c]`` long, all are in ``values``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values))
    return lists.take(pa.array(codes)).flatten().to_numpy()

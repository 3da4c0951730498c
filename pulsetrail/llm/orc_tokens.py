"""Token ids of a corpus in ORC files.

One row per document, in ascending order of id over all files: ``doc_id``, ``row`` (the
place in its file) and ``ids``. ORC stores the ids of a stripe with integer run-length
encoding, keeps an index per row group and a Bloom filter on ``doc_id``: a reader takes
stripes in parallel, and a lookup by id skips files, stripes and row groups by their
metadata.

Texts are range-partitioned by id first and encoded after that, so nothing but the texts
is shuffled, and each task streams its range into one file. A text is cut at ASCII white
space, which no token of the vocabulary spans; every distinct piece of a batch is encoded
by the library once, and pieces seen before come from a bounded cache.

Defined cases: a null text is the empty text and has the end id alone; rows without an id
come first; rows that repeat an id are kept, next to each other; the empty table gives
files without rows; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import Words, bounded, per_slice, ragged_take, split_ascii
from pulsetrail.materialize import materialize

END_ID = 1
CACHE_WORDS = 300_000
_JOINED = 2_000
_PLAIN = r"^[a-zA-ZÀ-ÖØ-öø-ÿ]+$"
_MARKS = ".,!?;:"
_BEFORE_MARKS = r"^[a-zA-ZÀ-ÖØ-öø-ÿ]+"
SCHEMA = "doc_id long, row long, ids array<int>"


class Encoder:
    """Ids of white-space separated pieces, by the library, with a bounded cache.

    A piece of Latin letters and closing marks is encoded as its lower-cased letters and
    its marks, which the tokenizer separates too; the letters of many pieces go through
    the library at once and are told apart by the ids that end a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(one.ids, self.width) for one in found]

    def _letters(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(group) and (not len(ids) or stops[-1] == len(ids)):
                raw, step = ids.tobytes(), ids.itemsize
                edges = [0, *(stops * step).tolist()]
                found.update(zip(group, map(raw.__getitem__, map(slice, edges, edges[1:]))))
            else:
                found.update((w, ids.tobytes()) for w, ids in zip(group, self._encode(group)))
        return found

    def _table(self, plain: list[str], odd: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letters, then of other pieces, on end, and how many each has."""
        known = self.cache
        new = self._letters([w for w in plain if w not in known])
        others = [w for w in odd if w not in known]
        new.update((w, ids.tobytes()) for w, ids in zip(others, self._encode(others)))
        if len(known) + len(new) <= CACHE_WORDS:
            known.update(new)
            new = {}
        get, other = known.get, new.get
        parts = [get(w) or other(w, b"") for w in plain] + [get(w) or other(w, b"") for w in odd]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(self.width).itemsize
        return np.frombuffer(b"".join(parts), self.width), lengths

    def encode_words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces on end, and how many each has."""
        cores = pc.utf8_rtrim(pieces, _MARKS)
        plain = pc.match_substring_regex(cores, _PLAIN).to_numpy(zero_copy_only=False)
        letters = pc.utf8_lower(cores.filter(pa.array(plain))).dictionary_encode()
        # What follows the letters, or the whole piece if it is not plain.
        rest = pc.if_else(pa.array(plain), pc.replace_substring_regex(pieces, _BEFORE_MARKS, ""), pieces)
        rest = rest.dictionary_encode()
        values, lengths = self._table(letters.dictionary.to_pylist(), rest.dictionary.to_pylist())
        # Every piece is two entries of the table: letters, of which a piece may have none,
        # and the rest, which may be empty.
        size = len(letters.dictionary)
        lengths = np.append(lengths, 0)
        codes = np.full((len(pieces), 2), len(lengths) - 1)
        codes[plain, 0] = letters.indices.to_numpy()
        codes[:, 1] = rest.indices.to_numpy() + size
        return ragged_take(values, lengths, codes.ravel()), lengths[codes].sum(axis=1)

    def encode_texts(self, words: Words, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the offsets of the texts."""
        values, lengths = self.encode_words(words.distinct)
        ids = ragged_take(values.astype(np.int32), lengths, words.codes)
        offsets = np.concatenate([[0], np.cumsum(lengths[words.codes])])[words.starts]
        if end is not None:
            ids = np.insert(ids, offsets[1:], end)
            offsets = offsets + np.arange(len(offsets))
        return ids.astype(np.int32), offsets


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One per Python worker, so that its cache serves all tasks of the worker."""
    return Encoder(path)


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the ORC files. ``tokenizer`` must exist on all executors."""

    def encode(batches):
        row = 0

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal row
            ids, offsets = _encoder(tokenizer).encode_texts(split_ascii(batch["text"]), end_id)
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            return pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(rows), lists], names=["doc_id", "row", "ids"]
            )

        return per_slice(work)(batches)

    (
        bounded(docs)
        .select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(encode, SCHEMA)
        .write.mode("overwrite")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows: doc_id, row, ids, and ``part``, the number of their file."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return spark.read.schema(SCHEMA).orc(path).select("doc_id", "row", "ids", part.alias("part"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored rows of a few documents; the filter reaches the ORC reader."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids))


def _checksums(batches):
    for batch in batches:
        lists = batch["ids"]
        at = lists.offsets.to_numpy()
        values = lists.values.to_numpy().astype("<u4")
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["part"],
                batch["row"],
                pa.array(np.diff(at).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "part", "row", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start (ids before it), n_tokens, ids_crc32.

    Only the sums of the files are ordered in one task; places inside a file are windows
    over the rows of that file.
    """
    schema = "doc_id long, part long, row long, n_tokens long, ids_crc32 long"
    read = materialize(read_token_ids(spark, path).mapInArrow(_checksums, schema))
    files = read.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        files.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        read.withColumn("earlier", earlier)
        .join(offsets, "part")
        .select("doc_id", (F.col("offset") + F.col("earlier")).alias("start"), "n_tokens", "ids_crc32")
    )

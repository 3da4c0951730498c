"""Ranked lexical search without random access (NRA).

Documents are indexed once: per document its number of terms and the terms that some item
asks for, with their counts. A shard is an Arrow batch of the index. In a shard, every term
has a list of its documents, highest impact (score contribution) first. An item reads the
lists of its terms from the top, all in step. After each step a document's score is at least
what was read of it, and at most that plus, for every list where it was not met, the impact
that the list goes on with. A document is out once its upper bound is below the item's
50th-best lower bound; reading ends when every document that is left has equal bounds. Then
membership, ties and scores are settled. A task carries the best of its earlier shards over
to the next one, whose reads can so end early.

Shards are parts of the table as it lies, so no posting is shuffled; a task's result is 50
rows an item. Items are taken in blocks of about ``BLOCK_TERMS`` terms, by a hash of their
id, and only one block's terms are sent to the tasks at a time. Scores are whole numbers.

Defined cases: a null text, or one without terms, is no document of the index; rows of
documents that repeat are documents of their own; a document without an id comes last among
equal scores; items that repeat an id are one item with the terms of all its rows, so is an
item without an id; an item without terms, or whose terms no document has, has no rows;
documents whose score is 0 are not listed; empty tables give an empty result. Columns
other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import Words, bounded, map_texts, split_ascii
from pulsetrail.materialize import materialize, release

DEPTH = 50
BLOCK_TERMS = 500_000
# Postings of every list that are read in the first step; each step reads four times as many.
FIRST_READ = 64

# Bytes of UTF-8: ASCII other than letters and digits separates, A-Z are lower-cased.
_BYTES = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BYTES[_low : _high + 1] = np.arange(_low, _high + 1)
_BYTES[0x41:0x5B] += 0x20


# ---- index


def split_terms(texts: pa.Array) -> Words:
    """Maximal runs of ASCII letters, digits and all other characters beyond ASCII."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(_BYTES[raw].tobytes())
    )
    return split_ascii(plain)


def _postings(vocabulary: list[str]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    known = pa.array(vocabulary, pa.large_string())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_terms(batch["text"])
        n = np.diff(words.starts)
        number = pc.fill_null(pc.index_in(words.distinct, known), -1).to_numpy(zero_copy_only=False)
        term = number.astype(np.int64)[words.codes]
        row = np.repeat(np.arange(len(n)), n)
        pairs, tf = np.unique((row * len(known) + term)[term >= 0], return_counts=True)
        edges = pa.array(np.searchsorted(pairs, np.arange(len(n) + 1) * len(known)).astype(np.int32))
        out = pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "n": pa.array(n),
                "terms": pa.ListArray.from_arrays(edges, pa.array((pairs % len(known)).astype(np.int32))),
                "tfs": pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32))),
            }
        )
        return out.filter(pa.array(n > 0))

    return work


def build_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Documents with a term: doc_id, n, and the numbers and counts of the known terms."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(texts, _postings(vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>")


def query_terms(text: Column) -> Column:
    """Distinct terms of a text, as ``split_terms`` has them."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.array_distinct(F.transform(found, lambda term: F.translate(term, upper, lower)))


# ---- search in a shard


def _sums(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of whole numbers by place."""
    if not len(values) or int(values.max()) * len(values) < 2**53:
        return np.bincount(places, weights=values, minlength=size).astype(np.int64)
    total = np.zeros(size, np.int64)
    np.add.at(total, places, values)
    return total


class Shard:
    """Lists of one batch of the index, by term, highest impact first."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, docs: int, length: int):
        self.ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
        self.no_id = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
        self.size = len(self.ids)
        n = batch["n"].to_numpy()
        share = 100 - 50 + (50 * n * docs) // length
        counts = pc.list_value_length(batch["terms"]).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(self.size), counts)
        term = batch["terms"].flatten().to_numpy().astype(np.int64)
        tf = batch["tfs"].flatten().to_numpy().astype(np.int64)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * share[row]))
        order = np.lexsort((-impact, term))
        self.row, self.impact = row[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))

    def best(self, terms: np.ndarray, floor: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of all documents that may be among the ``depth`` best.

        ``floor`` is a score that ``depth`` documents elsewhere reach.
        """
        at, end = self.starts[terms], self.starts[terms + 1]
        kept = at < end
        at, end = at[kept], end[kept]
        lower = np.zeros(self.size, np.int64)
        rows, lists, width = [], [], FIRST_READ
        while True:
            upto = np.minimum(at + width, end)
            taken = upto - at
            place = np.repeat(upto - np.cumsum(taken), taken) + np.arange(taken.sum())
            rows.append(self.row[place])
            lists.append(np.repeat(np.arange(len(at)), taken))
            lower += _sums(rows[-1], self.impact[place], self.size)
            at, width = upto, width * 4
            # What a list goes on with bounds what it has left for any document.
            ahead = np.where(at < end, self.impact[np.minimum(at, len(self.impact) - 1)], 0) if len(at) else at
            met = _sums(np.concatenate(rows), ahead[np.concatenate(lists)], self.size)
            upper = lower + ahead.sum() - met
            least = max(floor, 1)
            if self.size >= depth:
                least = max(least, int(np.partition(lower, self.size - depth)[self.size - depth]))
            left = np.flatnonzero(upper >= least)
            if (lower[left] == upper[left]).all():
                return left, lower[left]


def _search(
    items: list[tuple[int, np.ndarray]], weights: np.ndarray, docs: int, length: int, depth: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``depth`` best of each item among the documents of a task."""

    def run(batches):
        best = {item: (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),) for item, _ in items}
        for batch in batches:
            shard = Shard(batch, weights, docs, length)
            for item, terms in items:
                scores, ids, no_id = best[item]
                rows, more = shard.best(terms, int(scores[-1]) if len(scores) == depth else 0, depth)
                if len(rows):
                    scores = np.concatenate([scores, more])
                    ids = np.concatenate([ids, shard.ids[rows]])
                    no_id = np.concatenate([no_id, shard.no_id[rows]])
                    first = np.lexsort((ids, no_id, -scores))[:depth]
                    best[item] = scores[first], ids[first], no_id[first]
        for item, (scores, ids, no_id) in best.items():
            if len(scores):
                yield pa.record_batch(
                    {
                        "item": pa.array(np.full(len(scores), item, np.int32)),
                        "doc_id": pa.array(ids, mask=no_id),
                        "score": pa.array(scores),
                    }
                )

    return run


# ---- search


def rank_documents(
    docs: DataFrame, benchmark: DataFrame, depth: int = DEPTH, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """The ``depth`` best documents of every item: item_id, rank, doc_id, score."""
    wanted = materialize(
        benchmark.select("item_id", F.explode(query_terms(F.col("text"))).alias("term")).distinct()
    )
    blocks = -(-wanted.count() // block_terms)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    found = [
        _rank_block(docs, wanted.where(number == block) if blocks > 1 else wanted, depth)
        for block in range(blocks)
    ]
    found = [ranked for ranked in found if ranked is not None]
    release(wanted)
    if not found:
        nothing = f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        return docs.sparkSession.createDataFrame([], nothing)
    result = found[0]
    for ranked in found[1:]:
        result = result.unionByName(ranked)
    return result


def _rank_block(docs: DataFrame, wanted: DataFrame, depth: int) -> DataFrame | None:
    spark = docs.sparkSession
    # About BLOCK_TERMS rows: the terms of a block of items.
    items = wanted.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
    vocabulary = sorted({term for row in items for term in row["terms"]})
    if not vocabulary:
        return None
    index = materialize(build_index(docs, vocabulary))
    n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weights = np.zeros(len(vocabulary), np.int64)
    for row in df.select("term", weight.alias("weight")).collect():  # a row per term of the block
        weights[row["term"]] = row["weight"]
    place = {term: i for i, term in enumerate(vocabulary)}
    asked = [(i, np.array([place[term] for term in row["terms"]], np.int64)) for i, row in enumerate(items)]
    ids = spark.createDataFrame(
        [(i, row["item_id"]) for i, row in enumerate(items)],
        f"item int, item_id {wanted.schema['item_id'].dataType.simpleString()}",
    )
    best = bounded(index).mapInArrow(
        _search(asked, weights, n_docs, n_terms, depth), "item int, doc_id long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)
    ranked = materialize(ranked)
    release(index)
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")

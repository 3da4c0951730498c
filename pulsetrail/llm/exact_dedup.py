"""Exact duplicates by progressive refinement.

Three steps, each on the rows the step before left over: rows whose text has a length
that others have too, then rows whose opening characters hash alike as well, then rows
whose whole text has the same SHA-256. Every step moves narrow rows (ids, lengths,
hashes); a text is never shuffled to be compared. Counting per key combines on the map
side, so a group with a third of all rows adds one row per task.

Defined cases: a null text is the empty text; rows without an id are never merged, nor
counted as copies; rows that repeat an id and a text are copies of each other, count in
``group_size`` and share ``keep_id``, and one of them stays; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are not read. Texts are compared as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize, release

PREFIX_CHARS = 128


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def candidates(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``doc_id`` of the rows that share length and opening with another row."""
    keys = materialize(
        _texts(docs)
        .where("doc_id is not null")
        .select(
            "doc_id",
            F.octet_length("text").alias("n"),
            F.xxhash64(F.substring("text", 1, prefix_chars)).alias("opening"),
        )
    )
    shared = F.count(F.lit(1)) > 1
    lengths = keys.groupBy("n").agg(shared.alias("shared")).where("shared").select("n")
    same_length = keys.join(lengths, "n", "left_semi")
    openings = (
        same_length.groupBy("n", "opening").agg(shared.alias("shared")).where("shared").drop("shared")
    )
    found = materialize(keys.join(openings, ["n", "opening"], "left_semi").select("doc_id"))
    release(keys)
    return found


def exact_duplicates(
    docs: DataFrame, prefix_chars: int = PREFIX_CHARS, digest_all: bool = False
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest ``doc_id`` stays. ``text_sha256`` is the digest of the
    rows that survive to the last step; ``digest_all`` computes it for every row, for
    callers that want the digest itself, and then no text is read a second time.
    """
    rows = _texts(docs)
    digest = F.sha2("text", 256).alias("text_sha256")
    found = candidates(docs, prefix_chars)
    if digest_all:
        hashed = materialize(rows.select("doc_id", digest))
        survivors = hashed.join(found, "doc_id", "left_semi")
    else:
        survivors = materialize(rows.join(found, "doc_id", "left_semi").select("doc_id", digest))
        hashed = survivors
    groups = materialize(
        survivors.groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )
    one = F.lit(1).cast("long")
    merged = F.col("doc_id").isNotNull() & F.col("keep_id").isNotNull()
    compared = hashed.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(merged, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(merged, F.col("group_size")).otherwise(one).alias("group_size"),
        F.when(merged, F.col("keep_id") == F.col("doc_id")).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )
    # Rows that repeat the id and the text of a row that stays: one of them does.
    twins = materialize(
        survivors.join(groups.select("text_sha256", F.col("keep_id").alias("doc_id")), ["doc_id", "text_sha256"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    if not twins.isEmpty():
        again = twins.join(groups, "text_sha256").select(
            "doc_id", "keep_id", "group_size", F.explode(F.sequence(one, "rows")).alias("copy"), "text_sha256"
        )
        names = compared.columns
        compared = compared.join(twins, ["doc_id", "text_sha256"], "left_anti").select(*names).unionByName(
            again.withColumn("kept", F.col("copy") == 1).select(*names)
        )
    if digest_all:
        return compared
    alone = rows.select("doc_id").join(found, "doc_id", "left_anti")
    return compared.unionByName(
        alone.select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            one.alias("group_size"),
            F.lit(True).alias("kept"),
            F.lit(None).cast("string").alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``docs`` without the rows whose text another row with a larger id has.

    Every text is hashed where it is read: to hash the survivors alone, the texts would
    have to be moved to the join that tells which rows survive, which costs more.
    """
    found = materialize(exact_duplicates(docs, prefix_chars, digest_all=True).where("group_size > 1"))
    pairs = materialize(
        found.groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    )
    dropped = pairs.where("not stays")
    ids = materialize(dropped.select("doc_id").distinct())
    # If no row that stays has the id of one that goes, ids alone tell them apart: the
    # list is narrow, and no text is hashed or moved where it is small enough to broadcast.
    gone_rows = dropped.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if docs.select("doc_id").join(ids, "doc_id", "left_semi").count() == gone_rows:
        rest = docs.join(ids, "doc_id", "left_anti")
    else:
        gone = dropped.select("doc_id", "text_sha256")
        same = "d.doc_id = g.doc_id and sha2(coalesce(d.text, ''), 256) = g.text_sha256"
        rest = docs.alias("d").join(gone.alias("g"), F.expr(same), "left_anti")
    repeated = materialize(pairs.where("stays and rows > 1").select("doc_id").distinct())
    if repeated.isEmpty():
        return rest
    # Rows that repeat an id and a text: the only ones that must be compared as rows.
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, "doc_id", "left_anti").unionByName(once)

"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed share of the hash range, so its size
follows the document and sketches merge by union: the sketch of a union is the union of
the sketches. Shares of common hashes estimate resemblance and, for documents of very
unequal length, containment. The least hash is kept as well even when it is above the
threshold, so that short texts have a sketch too; of a union it is the least of the
least.

All work is SQL functions. A shingle is five consecutive words (runs of characters other
than ASCII white space); a text of fewer words is one shingle.

Defined cases: a null text is the empty text; a text without words has an empty sketch,
which is like another empty sketch and unlike all others; equal texts have equal
sketches; columns other than those named are not read; an empty table gives an empty
result. ``compare_edited`` takes rows in descending order of id, then digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize, release
from pulsetrail.operators.ordering import RANK, global_rank

SHINGLE_WORDS = 5
FRACTION = 0.25


def _threshold(fraction: float) -> int:
    """Signed hashes below this are the given fraction of all."""
    return int(-(2**63) + fraction * 2**64) if fraction < 1 else 2**63 - 1


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def with_sketch(
    rows: DataFrame, text: str, sketch: str, fraction: float = FRACTION, size: int = SHINGLE_WORDS
) -> DataFrame:
    """Add ``sketch``, the sorted array of kept shingle hashes of the column ``text``."""
    # Words and hashes are columns of their own, as a function inside a lambda is
    # evaluated once per element.
    split = rows.withColumn("_words", words(F.col(text)))
    last = F.greatest(F.size("_words") - size, F.lit(0))
    shingle = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(size)])
    hashed = split.withColumn(
        "_hashes",
        F.when(F.size("_words") > 0, F.transform(F.sequence(F.lit(0), last), shingle)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    low = F.filter("_hashes", lambda h: h < F.lit(_threshold(fraction)))
    least = F.array_compact(F.array(F.array_min("_hashes")))
    kept = F.sort_array(F.array_union(low, least))
    return hashed.withColumn(sketch, kept).drop("_words", "_hashes")


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge(sketches: DataFrame, keys: list[str], sketch: str = "sketch", fraction: float = FRACTION) -> DataFrame:
    """Sketch of the union of the documents of each group.

    Distinct (group, hash) pairs are counted out by a shuffle on both, so a hot group is
    spread; the final array is as long as the group's sketch, which is the result.
    """
    each = sketches.select(*keys, F.explode(sketch).alias("_h")).distinct()
    least = each.groupBy(*keys).agg(F.min("_h").alias("_least"))
    low = each.where(F.col("_h") < F.lit(_threshold(fraction)))
    arrays = low.groupBy(*keys).agg(F.collect_list("_h").alias("_low"))
    joined = least.join(arrays, keys, "left")
    both = F.array_union(F.coalesce("_low", F.array().cast("array<bigint>")), F.array("_least"))
    return joined.select(*keys, F.sort_array(both).alias(sketch))


def _neighbours(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Per document: key and id, the key of the document before it, and that one's cut.

    Only ids, keys and lengths are ordered. Rows that repeat an id and a text are one
    document here, with their number as ``_copies``; the second value tells whether any do.
    """
    keyed = rows.groupBy("doc_id", "_key", F.length("text").alias("_n")).agg(F.count(F.lit(1)).alias("_copies"))
    ranked = materialize(global_rank(keyed, [F.col("doc_id").desc_nulls_last(), F.col("_key")]))
    total, most = ranked.agg(F.count(F.lit(1)), F.max("_copies")).first()
    repeated = (most or 0) > 1
    reader = ranked.select(
        F.when(F.col(RANK) == total, F.lit(1)).otherwise(F.col(RANK) + 1).cast("long").alias(RANK),
        F.col("_key").alias("_to"),
        F.floor(F.col("_n") / 3).cast("int").alias("_cut"),
    )
    pairs = materialize(ranked.select("_key", "doc_id", "_copies", RANK).join(reader, RANK).drop(RANK))
    release(ranked)
    return pairs, repeated


def compare_edited(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprint every text and an edited copy of it, and compare.

    The edited text has its last floor(n/3) code points replaced by the first as many of
    the next document in descending order of id; the next of the last is the first.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (resemblance) and containment_edited. Rows that repeat an id
    and a text stand next to each other: all but the last of them are followed by their own
    text.

    Texts are shuffled once, by a key of their own: every document sends its opening and
    its sketch to the one document that reads them, where the same shuffle has put it.
    """
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_key", F.md5(identity)
    )
    pairs, repeated = _neighbours(rows)
    # Both uses of the texts ask for the same columns, so that one shuffle serves them.
    placed = rows.select("_key", "text").join(pairs, "_key")
    openings = with_sketch(placed, "text", "next_sketch", fraction).select(
        F.col("_to").alias("_key"),
        F.substring(F.col("text"), F.lit(1), F.col("_cut")).alias("_opening"),
        "next_sketch",
    )
    if repeated:
        openings = openings.dropDuplicates(["_key"])
        placed = placed.dropDuplicates(["_key"])
    n = F.length("text")
    followed = placed.select("_key", "doc_id", "text").join(openings, "_key")
    if repeated:
        twins = with_sketch(placed.where("_copies > 1"), "text", "next_sketch", fraction)
        followed = followed.unionByName(
            twins.select(
                "_key",
                "doc_id",
                "text",
                F.substring(F.col("text"), F.lit(1), F.floor(n / 3).cast("int")).alias("_opening"),
                "next_sketch",
                F.explode(F.sequence(F.lit(2).cast("long"), "_copies")).alias("_copy"),
            ).drop("_copy")
        )
    joined = (
        followed.withColumn("n_chars", n.cast("long"))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 3)).cast("int")), "_opening"
            ),
        )
    )
    both = with_sketch(with_sketch(joined, "text", "sketch", fraction), "edited", "edited_sketch", fraction)
    sketch, edited = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(sketch).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        resemblance(sketch, edited).alias("near_edited"),
        resemblance(sketch, F.col("next_sketch")).alias("near_next"),
        containment(sketch, edited).alias("containment_edited"),
    )

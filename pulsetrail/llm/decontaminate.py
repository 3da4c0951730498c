"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item (an item of fewer words is one
window). A document is contaminated where it has all words of a window in a row.

Of every window of words, on both sides, the least hash of its runs of five words is kept:
the fingerprint. Equal windows have equal fingerprints, so every shared span of ten words
or more is found. Neighbouring windows mostly share theirs, so a document keeps one
fingerprint per stretch of windows, about two in seven words; these are joined to the
fingerprints of the items. Hits are extended: the windows of the stretch are compared word
by word with the windows of the items, and the words under equal ones are hit. Shorter
windows are winnowed in the same way with shorter runs.

All work is SQL functions. Texts are read once and never shuffled. A bit map of the items'
fingerprints, of bounded size, turns down most stretches where the text is read; what is left
takes the words of its stretch along to the join on fingerprints, which settles the rest.
Sides of a join are written first, so that the planner knows their size; nothing is broadcast
by a hint. Items that share a window are counted out through sets of items, so that a passage
of many items adds one row per window.

Defined cases: a null text has no words, and a text without words is not contaminated;
rows of documents that repeat are answered each; items that repeat an id are one item with
all their windows; an item without an id counts as the item ``""``; empty tables give no
rows, or no hits. Columns other than doc_id, item_id and text are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize, release

WINDOW_WORDS = 10
# Characters between words, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Largest bit map of the items' fingerprints: 2 MB.
MAP_BITS = 1 << 24


def words(text: Column) -> Column:
    lowered = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    return F.filter(F.split(lowered, BETWEEN), lambda word: word != "")


def _with_stretches(rows: DataFrame, length: int, column: str) -> DataFrame:
    """Add the fingerprints of the windows of ``length`` words of ``_words``.

    ``column`` is an array of (length, first, until, print): windows that start at first,
    ..., until - 1 have the fingerprint ``print``.
    """
    run = (length + 1) // 2
    span = length - run + 1  # runs in a window
    hashed = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(run)])
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn(
        "_least",
        F.when(
            F.size("_words") >= length,
            F.transform(F.sequence(F.lit(0), F.size("_words") - run), hashed),
        ).otherwise(none),
    )
    # The least of 1, 2, 4, ... runs from each place on, and at last of all in a window.
    covered = 1
    while covered < span:
        step = min(covered, span - covered)
        later = F.slice("_least", F.lit(step + 1), F.size("_least"))
        rows = rows.withColumn("_least", F.zip_with("_least", later, lambda a, b: F.least(a, b)))
        covered += step
    rows = rows.withColumn("_least", F.slice("_least", F.lit(1), F.greatest(F.size("_words") - length + 1, F.lit(0))))
    new = lambda value, i: F.when(
        (i == 0) | (value != F.get("_least", i - 1)), F.struct(i.alias("first"), value.alias("print"))
    )
    rows = rows.withColumn("_starts", F.filter(F.transform("_least", new), lambda s: s.isNotNull()))
    stretch = lambda s, i: F.struct(
        F.lit(length).alias("length"),
        s["first"].alias("first"),
        F.coalesce(F.get("_starts", i + 1)["first"], F.size("_least")).alias("until"),
        s["print"].alias("print"),
    )
    return rows.withColumn(column, F.transform("_starts", stretch)).drop("_least", "_starts")


def with_fingerprints(rows: DataFrame, lengths: list[int], column: str = "_every") -> DataFrame:
    """Add the stretches of the text in ``_words``, for windows of each length."""
    columns = []
    for length in lengths:
        columns.append(f"_of{length}")
        rows = _with_stretches(rows, length, columns[-1])
    every = F.concat(*columns) if len(columns) > 1 else F.col(columns[0])
    return rows.withColumn(column, every).drop(*columns)


def fingerprints(rows: DataFrame, keep: list[str], lengths: list[int]) -> DataFrame:
    """Stretches of every text as rows; ``keep`` names the columns that stay."""
    # Outer: for an inner one the optimizer puts a filter with a copy of the whole
    # expression under every step, where lambdas evaluate it once per element.
    return with_fingerprints(rows, lengths).select(*keep, F.inline_outer("_every"))


def _bit_map(prints: DataFrame) -> tuple[DataFrame, int]:
    """One row with the bits of all prints in an array of longs, and the number of its bits.

    Some thirty bits a print, but never more than MAP_BITS.
    """
    size = 64
    while size < min(32 * prints.count(), MAP_BITS):
        size *= 2
    place = F.pmod("print", F.lit(size))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    found = prints.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(bit).alias("bits")
    )
    every = prints.sparkSession.range(size // 64).select(F.col("id").alias("at")).join(found, "at", "left")
    listed = F.sort_array(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return materialize(every.agg(F.transform(listed, lambda word: word["bits"]).alias("map"))), size


def _window_text(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("_words", first + 1, length), " ")


def item_windows(benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (length, window, set) and the items of each set (set, item).

    Windows that the same items have share a set, named by one of them.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("_words")
    ).where(F.size("_words") > 0)
    length = F.least(F.size("_words"), F.lit(window_words))
    starts = F.sequence(F.lit(0), F.size("_words") - F.col("length"))
    pairs = materialize(
        items.withColumn("length", length)
        .select("item", "length", F.explode(F.transform(starts, lambda s: _window_text(s, F.col("length")))).alias("window"))
        .distinct()
    )
    # Which items: their number and two combined hashes, without gathering them.
    signed = pairs.groupBy("length", "window").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("item")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("set"), "item")).alias("b"),
    )
    same = ["n", "a", "b"]
    sets = signed.groupBy(*same).agg(F.min(F.struct("length", "window")).alias("set"))
    windows = materialize(signed.join(sets, same).select("length", "window", F.md5(_named("set")).alias("set")))
    named = sets.select(F.col("set.length").alias("length"), F.col("set.window").alias("window"))
    members = materialize(
        pairs.join(named, ["length", "window"], "left_semi").select(
            F.md5(F.concat_ws(":", "length", "window")).alias("set"), "item"
        )
    )
    release(pairs)
    return windows, members


def _named(window: str) -> Column:
    return F.concat_ws(":", F.col(f"{window}.length"), F.col(f"{window}.window"))


def contamination(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans, items.

    ``spans`` lists the first and last word (from 0) of every run of hit words, ``items``
    the ids, as sorted strings, of the items that have a window in the document.
    """
    windows, members = item_windows(benchmark, window_words)
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))
    split = docs.select("doc_id", key.alias("_key"), words(F.col("text")).alias("_words"))
    n_words = F.size("_words").cast("long").alias("n_words")
    if not lengths:
        spans = "cast(array() as array<struct<first: int, last: int>>)"
        return split.select(
            "doc_id", n_words, F.lit(0).cast("long").alias("n_hit"), F.expr(spans).alias("spans"),
            F.array().cast("array<string>").alias("items"),
        )
    prints = _item_prints(windows, lengths)
    read = materialize(_candidates(split, prints, lengths).select("doc_id", "_key", n_words, "_candidates"))
    hits = _hits(read, prints, windows, members)
    return read.join(hits, "_key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _item_prints(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct (length, print) of all windows of the items."""
    as_words = windows.select(F.col("length").alias("_own"), F.split("window", " ").alias("_words"))
    prints = fingerprints(as_words, ["_own"], lengths).where("length = _own")
    return materialize(prints.select("length", "print").distinct())


def _candidates(split: DataFrame, prints: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``_candidates``: the stretches whose print is in the bit map, with their words."""
    bits, size = _bit_map(prints)
    with_map = with_fingerprints(split, lengths).withColumn("_map", bits.scalar())

    def known(s: Column) -> Column:
        place = F.pmod(s["print"], F.lit(size))
        word = F.get("_map", F.shiftright(place, 6).cast("int"))
        return F.getbit(word, (place % 64).cast("int")) == 1

    stretch = lambda s: F.struct(
        s["length"].alias("length"),
        s["print"].alias("print"),
        s["first"].alias("first"),
        _window_text(s["first"], s["until"] - s["first"] + s["length"] - 1).alias("text"),
    )
    return with_map.withColumn("_candidates", F.transform(F.filter("_every", known), stretch))


def _hits(read: DataFrame, prints: DataFrame, windows: DataFrame, members: DataFrame) -> DataFrame:
    """Per document with a hit: _key, n_hit, spans, items."""
    shared = (
        read.where(F.size("_candidates") > 0)
        .select("_key", F.inline("_candidates"))
        .join(prints, ["length", "print"], "left_semi")
        .select("_key", "length", "first", F.split("text", " ").alias("_words"))
    )
    # Extend: every window that starts in the stretch, as text.
    starts = F.sequence(F.lit(0), F.size("_words") - F.col("length"))
    each = F.transform(
        starts,
        lambda at: F.struct((F.col("first") + at).alias("at"), _window_text(at, F.col("length")).alias("window")),
    )
    found = materialize(
        shared.select("_key", "length", F.explode(each).alias("w"))
        .select("_key", "length", F.col("w.at").alias("first"), "w.window")
        .join(windows, ["length", "window"])
        .groupBy("_key", "first", "length", "set")
        .agg(F.lit(1))
        .select("_key", "first", "length", "set")
    )
    release(prints)
    # Windows that overlap or touch are one run of hit words.
    starts = found.groupBy("_key", "first").agg(F.max(F.col("first") + F.col("length") - 1).alias("last"))
    earlier = Window.partitionBy("_key").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_key").orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (
        starts.withColumn("_reached", F.max("last").over(earlier))
        .withColumn("_new", F.expr("CASE WHEN first <= _reached + 1 THEN 0 ELSE 1 END"))
        .withColumn("_run", F.sum("_new").over(upto))
        .groupBy("_key", "_run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    spans = runs.groupBy("_key").agg(
        F.sum((F.col("last") - F.col("first") + 1).cast("long")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"),
    )
    items = (
        found.select("_key", "set")
        .distinct()
        .join(members, "set")
        .groupBy("_key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return materialize(spans.join(items, "_key"))

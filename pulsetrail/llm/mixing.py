"""Mix sources to target weights by weighted fair queueing.

Each document of a source, in shuffled order, finishes at the virtual time
(words of its source up to and including it) / (target words of the source); a second
and third pass over the source follow on. All passes of all sources, sorted by finish
time, form one sequence, which is cut where its words reach the total budget. At virtual
time 1 every source has delivered its target, so at the cut each is within about one
document of it.

Nothing is ordered in one task. The shuffled order of a source is a hash order: a source
is cut into hash ranges of about ``ROWS_PER_TASK`` rows, sums per range give each range
its start, and only rows of one range are put in order. The cut is found the same way:
words per slot of virtual time, then the order inside the one slot where the budget runs
out. Tables per source, range or slot are the only ones that a single task sees.

Defined cases: a null text has size 0; documents of size 0 are never taken; sources are
numbered in code point order with null last and weigh 1, 2, 3, repeating; equal rows are
separate documents; ties in the hash are broken by id, then size; an empty table gives an
empty result; columns other than ``doc_id``, ``text`` and ``source`` are not read, and
``mix`` returns all columns of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize, release

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
ROWS_PER_TASK = 5_000
MAX_SLOTS = 100_000
SEED = 17
_HASH_DIGITS = 13  # of 16 bits less than a long: exact as a double


def words(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Per source: ``no_source, src, docs, source_size, target``.

    Shares are by weight, and no target is above ``max_passes`` times its source. The
    excess goes to the others by weight: with one factor f, a source gets
    min(f * weight, limit). Sorted by limit / weight the limited sources come first, and f
    follows from the sums before and after each.
    """
    per_source = sizes.groupBy("no_source", "src").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    number = F.row_number().over(Window.orderBy("no_source", "src")) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(number, F.lit(len(weights))))
    numbered = per_source.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_passes)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "no_source", "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    leveled = numbered.withColumn("level", level).withColumn(
        "open", F.col("level") <= F.col("limit") / F.col("weight")
    )
    # All sources from the first open one on share that one's level.
    factor = F.min_by("level", F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "no_source", "src"))).over(everything)
    target = F.when(
        F.col("open"), F.least(factor * F.col("weight"), F.col("limit").cast("double"))
    ).otherwise(F.col("limit").cast("double"))
    return leveled.select("no_source", "src", "docs", "source_size", target.alias("target"))


def _hash(seed: int) -> Column:
    # The text as well: rows without an id, or with one id, would share one place.
    own = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))
    digest = F.md5(own)
    return F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("long")


def plan_mix(docs: DataFrame, seed: int = SEED, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, finish.

    ``copies`` is how often the mix has the document, ``finish`` the virtual time of its
    first pass.
    """
    sizes = materialize(
        docs.select(
            "doc_id",
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("src"),
            words(F.col("text")).alias("size"),
            _hash(seed).alias("place"),
            _mark(F.col("text")).alias("mark"),
        )
    )
    key = ["no_source", "src"]
    # One row per source, written, so that the planner knows its size before it broadcasts.
    sources = materialize(source_targets(sizes, weights, max_passes))
    ranges = F.ceil(F.col("docs") / ROWS_PER_TASK)
    part = F.floor(F.col("place") / F.lit(float(16**_HASH_DIGITS)) * ranges)
    rows = sizes.join(sources, key).withColumn("part", part)
    part_words = rows.groupBy(*key, "part").agg(F.sum("size").alias("part_words"))
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        part_words.select(*key, "part", F.coalesce(F.sum("part_words").over(earlier), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy(*key, "part").orderBy("place", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = materialize(
        rows.join(starts, [*key, "part"]).withColumn("upto", F.col("start") + running).drop("part", "start", "docs")
    )
    release(sizes, starts)
    last = _last_taken(queued, max_passes)
    copies = F.lit(0)
    if last is not None:
        taken = F.filter(_passes(max_passes), lambda finish: _order(finish) <= _literal(last))
        copies = F.when(F.col("size") > 0, F.size(taken)).otherwise(0)
    return queued.withColumn("finish", _finish(F.lit(0))).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
        "finish",
        "no_source",
        "src",
        "mark",
    )


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _literal(key: Row) -> Column:
    kinds = {"finish": "double", "no_source": "boolean", "src": "string"}
    fields = key.asDict().items()
    return F.struct(*[F.lit(v).cast(kinds.get(name, "long")).alias(name) for name, v in fields])


def _finish(done: Column) -> Column:
    return F.try_divide(done * F.col("source_size") + F.col("upto"), F.col("target"))


def _passes(max_passes: int) -> Column:
    return F.array(*[_finish(F.lit(p)) for p in range(max_passes)])


def _order(finish: Column) -> Column:
    return F.struct(
        finish.alias("finish"),
        F.col("no_source").alias("no_source"),
        F.col("src").alias("src"),
        F.col("place").alias("place"),
        F.coalesce("doc_id", F.lit(-1).cast("long")).alias("doc_id"),
        F.col("size").alias("size"),
    )


def _last_taken(queued: DataFrame, max_passes: int) -> Row | None:
    """Order key of the last pass within the budget; None if there is none."""
    entries = queued.where("size > 0 and target > 0").withColumn("finish", F.explode(_passes(max_passes)))
    budget, count = queued.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not budget:
        return None
    slots = max(16, min(MAX_SLOTS, count // ROWS_PER_TASK))
    # What finishes after virtual time 4 shares one slot: by then every budget is spent
    # unless nothing but single documents larger than the whole budget is left.
    slot = F.least(F.floor(F.col("finish") * slots), F.lit(4 * slots)).cast("long")
    entries = entries.withColumn("slot", slot)
    whole = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_slot = entries.groupBy("slot").agg(F.sum("size").alias("words"))
    reached = per_slot.withColumn("reached", F.sum("words").over(whole))
    crossing = reached.where(F.col("reached") > budget).orderBy("slot").first()
    if crossing is None:
        return entries.agg(F.max(_order(F.col("finish")))).first()[0]
    room = budget - (crossing["reached"] - crossing["words"])
    here = entries.where(F.col("slot") == crossing["slot"]).withColumn("key", _order(F.col("finish")))
    upto = F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    fits = here.withColumn("upto_here", upto).where(F.col("upto_here") <= room).agg(F.max("key")).first()[0]
    if fits is None:
        fits = entries.where(F.col("slot") < crossing["slot"]).agg(F.max(_order(F.col("finish")))).first()[0]
    return fits


def mix(
    docs: DataFrame,
    seed: int = SEED,
    weights=WEIGHTS,
    max_passes: int = MAX_PASSES,
    ordered: bool = True,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    ``ordered`` sorts it by finish time, in range partitions.
    """
    plan = materialize(
        plan_mix(docs, seed, weights, max_passes)
        .where("copies > 0")
        .groupBy("doc_id", "no_source", "src", "mark")
        .agg(
            F.sum("copies").alias("copies"),
            F.count(F.lit(1)).alias("equal_rows"),
            F.min("finish").alias("finish"),
            F.min(F.try_divide("source_size", "target")).alias("step"),
        )
    )
    same = (
        "d.doc_id <=> p.doc_id and (d.source is null) = p.no_source"
        " and coalesce(d.source, '') = p.src and xxhash64(coalesce(d.text, '')) = p.mark"
    )
    columns = [f"d.`{name}`" for name in docs.columns]

    def attach(rows: DataFrame, entries: DataFrame) -> DataFrame:
        times = F.expr("transform(sequence(0, cast(p.copies as int) - 1), i -> p.finish + i * p.step)")
        return (
            rows.alias("d")
            .join(entries.alias("p"), F.expr(same))
            .select(F.struct(*columns).alias("row"), F.explode(times).alias("finish"))
        )

    mixed = attach(docs, plan.where("equal_rows = 1"))
    equal = plan.where("equal_rows > 1")
    if not equal.isEmpty():
        # Equal rows are interchangeable: one of them stands for all their copies.
        twins = docs.alias("d").join(equal.alias("p"), F.expr(same), "left_semi")
        mixed = mixed.unionByName(attach(twins.dropDuplicates(["doc_id", "source", "text"]), equal))
    if ordered:
        mixed = mixed.orderBy("finish", "row.doc_id")
    return mixed.select("row.*")

"""Near-duplicates by ProbMinHash.

A document is the bag of its shingles, five words each; repeats are weights. Similarity is
the probability Jaccard index of two bags. Each shingle sends arrivals of a Poisson process
whose rate is its weight to the registers of a signature, each to a register drawn at
random; a register keeps its first arrival. The share of equal registers estimates the
index. A shingle's later arrivals are drawn only while they come before the latest
register, so that most shingles stop after one.

Candidates are documents with an equal band of ``ROWS`` registers. Texts with the same
sequence of words are one member from the start. Pairs are verified on the shingle bags
themselves (32-bit shingle hashes), and classes are the connected components of the pairs
with an index of at least ``THRESHOLD``.

Nobody lists the pairs of a bucket. In a round a bucket that holds several classes names
pivots outside its first class, at first about ``PAIRS`` / size and at least one, and all
its members of other classes are compared with them; equal pairs of different buckets and
of earlier rounds are compared once. A group of near copies is joined by its first pivot;
what stays apart from it names ``GROWTH`` times as many pivots each round, until every
member outside the first class has been one. No bucket is capped and no pair that could
join two classes is left out.

Hot keys: rows of buckets and classes are a few numbers each. Pairs that cannot pass are turned
down inside the join, by an exact bound on small maps of the shingles, and one that meets in
several bands is made in the least of them, so that the rows made follow the links and not
the square of the bucket. The one join that carries shingles by
pivot splits a pivot's members over tasks of ``PER_TASK``.

Defined cases: a null text is the empty text; a text of fewer than five words is one
shingle of them all; texts without words are equal to each other; rows may repeat, and a
null id is a class member like any other but never its name unless all are null; the empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import Words, bounded, map_texts, split_ascii
from pulsetrail.materialize import materialize, release

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS = 25
ROWS = 5
REGISTERS = BANDS * ROWS
PAIRS = 64
GROWTH = 8
PER_TASK = 2_000
# Text that is worked on at a time: its shingles take some fifty times as much memory.
PART_CHARS = 2_000_000
MAP_LONGS = 32  # 2,048 bits: beyond about as many shingles the maps tell little
OFTEN = 4
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def _word_hashes(words: Words) -> np.ndarray:
    tokens = words.distinct.to_pylist()
    each = np.fromiter((xxhash.xxh64_intdigest(t) for t in tokens), np.uint64, len(tokens))
    return each[words.codes] if len(tokens) else np.zeros(0, np.uint64)


def _chain(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word."""
    out = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        out = _mix(out ^ hashes[k : k + len(out)])
    return out


def shingles(texts: pa.Array, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts on end, their weights, text bounds, text digests."""
    words = split_ascii(texts)
    hashes, starts = _word_hashes(words), words.starts
    size = np.diff(starts)
    rows = len(size)
    whole = _chain(hashes, SHINGLE_WORDS)
    text_of = np.repeat(np.arange(rows), size)
    inside = np.flatnonzero(text_of[: len(whole)] == text_of[SHINGLE_WORDS - 1 :]) if len(whole) else []
    owner, value = text_of[inside], whole[inside]
    short = np.flatnonzero((size > 0) & (size < SHINGLE_WORDS))
    if len(short):
        tails = [_chain(hashes[starts[t] : starts[t + 1]], size[t])[0] for t in short]
        owner = np.concatenate([owner, short])
        value = np.concatenate([value, np.array(tails, np.uint64)])
    value = value >> np.uint64(64 - bits)
    # Sort by text, then shingle: equal ones become neighbours.
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    weights = np.diff(np.concatenate([first, [len(value)]]))
    bounds = np.searchsorted(owner[first], np.arange(rows + 1))
    # The digest is of the sequence of words: places enter the sum.
    with np.errstate(over="ignore"):
        place = (np.arange(len(hashes)) - np.repeat(starts[:-1], size)).astype(np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(hashes ^ _mix(place)), dtype=np.uint64)])
        digest = _mix(sums[starts[1:]] - sums[starts[:-1]] + size.astype(np.uint64))
    return value[first], weights.astype(np.int64), bounds, digest


def signatures(value: np.ndarray, weights: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """The shingle that reached each register of each text first; 0 for an empty text."""
    rows = len(bounds) - 1
    first = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, np.uint64)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    alive, time, state = np.arange(len(value)), np.zeros(len(value)), value.copy()
    while len(alive):
        state = _mix(state)
        step = (state >> np.uint64(11)).astype(float) * 2.0**-53
        time = time - np.log1p(-step) / weights[alive]
        state = _mix(state)
        slot = owner[alive] * registers + (state % np.uint64(registers)).astype(np.int64)
        # Of several arrivals at a register, the earliest; the others come later in order.
        order = np.lexsort((time, slot))
        lead = np.ones(len(order), bool)
        lead[1:] = slot[order][1:] != slot[order][:-1]
        best = order[lead]
        sooner = best[time[best] < first[slot[best]]]
        first[slot[sooner]], winner[slot[sooner]] = time[sooner], value[alive[sooner]]
        latest = first.reshape(rows, registers).max(axis=1)
        on = time < latest[owner[alive]]
        alive, time, state = alive[on], time[on], state[on]
    return winner.reshape(rows, registers)


def _bands(signature: np.ndarray) -> np.ndarray:
    out = []
    for band in range(BANDS):
        total = np.full(len(signature), band, np.uint64)
        for column in signature[:, band * ROWS : (band + 1) * ROWS].T:
            total = _mix(total ^ column)
        out.append(total)
    return np.stack(out, axis=1).view(np.int64)


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    value, weights, bounds, digest = shingles(batch["text"])
    signature = signatures(value, weights, bounds, REGISTERS)
    bands = _bands(signature)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], batch["mark"], pa.array(digest.view(np.int64)), lists],
        names=["doc_id", "mark", "digest", "bands"],
    )


def _bag(batch: pa.RecordBatch) -> pa.RecordBatch:
    value, weights, bounds, digest = shingles(batch["text"], 32)
    offsets = pa.array(bounds.astype(np.int32))
    owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    map_ = np.zeros((batch.num_rows, MAP_LONGS), np.uint64)
    place = value % np.uint64(64 * MAP_LONGS)
    np.bitwise_or.at(map_, (owner, (place >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (place & np.uint64(63)))
    # The shingles that a bag repeats often: a hash of their set, and at least how much
    # they weigh beyond one each.
    often = np.flatnonzero(weights >= OFTEN)
    heavy, least = np.zeros(batch.num_rows, np.uint64), np.full(batch.num_rows, 1 << 40)
    with np.errstate(over="ignore"):
        np.add.at(heavy, owner[often], _mix(value[often]))
    np.minimum.at(least, owner[often], weights[often])
    weight = (least - 1) * np.bincount(owner[often], minlength=batch.num_rows)
    total = np.bincount(owner, weights=weights, minlength=batch.num_rows).astype(np.int64)
    maps = pa.FixedSizeListArray.from_arrays(pa.array(map_.view(np.int64).ravel()), MAP_LONGS)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(digest.view(np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.uint32).view(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(weights.astype(np.int32))),
            maps.cast(pa.list_(pa.int64())),
            pa.array(np.diff(bounds)),
            pa.array(total),
            pa.array(heavy.view(np.int64)),
            pa.array(weight),
            batch["halves"],
        ],
        names=["member", "value", "weight", "map", "kinds", "total", "heavy", "most", "halves"],
    )


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Of two bags: distinct shingles and their weights, as counts.

    The sum over common shingles i of 1 / sum over all j of max(x_j / x_i, y_j / y_i).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = x.astype(float), y.astype(float)
    xi, yi = x[at_a], y[at_b]
    # A common j counts x_j / x_i where x_j / y_j >= x_i / y_i, else y_j / y_i: with the
    # common ones sorted by that ratio, both sums are running sums. Shingles of one side
    # alone have an infinite or zero ratio.
    order = np.argsort(xi / yi, kind="stable")
    xs, ys = xi[order], yi[order]
    below = np.cumsum(ys) + (y.sum() - yi.sum())
    above = np.cumsum(xs[::-1])[::-1] - xs + (x.sum() - xi.sum())
    return float(np.sum(1.0 / (below / ys + above / xs)))


def _verify(batches):
    for batch in batches:
        frame = batch.to_pandas()
        found = [
            probability_jaccard(a, x, b, y)
            for a, x, b, y in zip(frame["value"], frame["weight"], frame["value2"], frame["weight2"])
        ]
        kept = frame.loc[np.array(found, float) >= THRESHOLD, ["member", "pivot"]]
        yield pa.RecordBatch.from_pandas(kept.astype("int64"), preserve_index=False)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``member, label`` of every node (member, label): labels joined along the edges.

    Edges (a, b) join labels. Every label points to the least it is linked to; pointers
    are followed to their ends, and links between ends that differ go on, until there are
    none. Each step at least halves the linked labels.
    """
    links = materialize(edges.where("a <> b").distinct())
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        parent = materialize(least.select(F.col("a").alias("label"), F.least("a", "b").alias("up")))
        while not parent.join(_follow(parent), "label").where("top <> up").isEmpty():
            further = materialize(_follow(parent).select("label", F.col("top").alias("up")))
            release(parent)
            parent = further
        old = nodes
        nodes = materialize(
            nodes.join(parent, "label", "left").select("member", F.coalesce("up", "label").alias("label"))
        )
        release(old)
        ends = [parent.select(F.col("label").alias(x), F.col("up").alias(f"{x}_up")) for x in ("a", "b")]
        rest = links.join(ends[0], "a").join(ends[1], "b").where("a_up <> b_up")
        rest = materialize(rest.select(F.col("a_up").alias("a"), F.col("b_up").alias("b")).distinct())
        release(links, parent)
        links = rest
    release(links)
    return nodes


def _follow(parent: DataFrame) -> DataFrame:
    """label, top: the pointer of each pointer, three steps at once."""
    out = parent.select("label", F.col("up").alias("top"))
    for _ in range(3):
        step = parent.select(F.col("label").alias("top"), F.col("up").alias("next"))
        out = out.join(step, "top").select("label", F.col("next").alias("top"))
    return out


def _buckets(sketches: DataFrame) -> DataFrame:
    """band, number of the band among a member's, member: the buckets with several members."""
    members = sketches.groupBy("digest").agg(F.first("bands").alias("bands"))
    each = members.select(F.posexplode("bands").alias("number", "band"), F.col("digest").alias("member"))
    full = each.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return materialize(each.join(full, "band"))


def _halves(buckets: DataFrame) -> DataFrame:
    """digest, halves: of each member 32 bits of its bucket in every band, which no other bucket
    of that band has; null where it has no bucket, or another bucket has the same."""
    half = F.shiftright("band", 32).cast("int").alias("half")
    each = buckets.select("number", half, "band", "member")
    shared = materialize(
        each.groupBy("number", "half").agg((F.min("band") < F.max("band")).alias("shared")).where("shared")
    )
    own = F.when(F.col("shared").isNull(), F.col("half"))
    found = each.join(shared, ["number", "half"], "left").groupBy(F.col("member").alias("digest")).agg(
        F.map_from_entries(F.collect_list(F.struct("number", own.alias("half")))).alias("found")
    )
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return found.select("digest", F.transform(numbers, lambda k: F.try_element_at("found", k)).alias("halves"))


def _bags(rows: DataFrame, sketches: DataFrame, buckets: DataFrame) -> DataFrame:
    """member, value, weight of every member of a bucket, from one row that has its text."""
    chosen = (
        sketches.select("digest", "mark")
        .groupBy("digest")
        .agg(F.min("mark").alias("mark"))
        .join(_halves(buckets), "digest")
        .select("mark", "halves")
    )
    chosen = materialize(chosen)
    texts = rows.select("mark", "text").join(chosen, "mark")
    schema = "member long, value array<int>, weight array<int>, map array<long>, "
    schema += "kinds long, total long, heavy long, most long, halves array<int>"
    bags = materialize(map_texts(texts, _bag, schema, PART_CHARS))
    release(chosen)
    if bags.count() == bags.select("member").distinct().count():
        return bags
    once = materialize(bags.dropDuplicates(["member"]))  # rows that repeat an id and a text
    release(bags)
    return once


def _open_rows(state: DataFrame, budget: int) -> DataFrame:
    """The rows of the buckets that hold several classes, with this round's pivots marked.

    A bucket is searched when all its members outside its first class have been pivots.
    Of those that have not, the one with the largest label is one now, and others drawn
    by a hash: about budget / size, and never fewer than the rounds so far allow.
    """
    label, member, fresh = F.col("label"), F.col("member"), ~F.col("done")
    agg = state.groupBy("band").agg(
        F.min(label).alias("low"), F.max(F.when(fresh, F.struct("label", "member"))).alias("last")
    )
    still = agg.where("last.label > low").select("band", "low", F.col("last.member").alias("last"))
    share = F.greatest(F.floor(F.lit(budget) / F.col("size")), F.lit(budget // PAIRS))
    drawn = F.pmod(F.xxhash64("member", F.lit(budget)), F.col("size")) < share
    pivot = fresh & ((drawn & (label != F.col("low"))) | (member == F.col("last")))
    return materialize(
        state.join(still, "band").select("band", "number", "member", "size", "label", "done", pivot.alias("pivot"))
    )


def _may_be_similar() -> Column:
    """False only for a pair whose index is below the threshold.

    With the bags' weights x and y, a common shingle i adds at most max(x_i, y_i) over the
    sum of max(x_j, y_j) over all shingles, so the index is at most 1 less the share of that
    sum that is on one side alone; for bags without repeats that is the index. With c of k1
    and k2 shingles in common, at least k1 + k2 - 2c is on one side alone, and the sum is
    both totals less what is in common: at least c, and the repeats of the shingles that
    both repeat often if these are the same. That asks for a least c, and the bit maps of the shingles tell how large c can be:
    a bit that only one map has is a shingle that only one bag has.
    """
    k1, k2 = F.col("kinds"), F.col("kinds2")
    shared = F.when(F.col("heavy") == F.col("heavy2"), F.least("most", "most2")).otherwise(0)
    most = (F.col("total") + F.col("total2") - shared) * (1 - THRESHOLD)
    needed = (k1 + k2 - most) / (1 + THRESHOLD) - 1e-6
    only = lambda a, b: reduce(
        add, [F.bit_count(F.col(f"{a}{i}").bitwiseAND(F.bitwise_not(f"{b}{i}"))) for i in range(MAP_LONGS)]
    )
    return (k1 - only("m", "w") >= needed) & (k2 - only("w", "m") >= needed)


def _meets_first() -> Column:
    """A pair meets in every band it shares; it is made in the first one that the pivot leads.

    Earlier bands are compared by halves of 32 bits, which tell the buckets of a band apart;
    a bucket that they do not tell has none, and a pair in it is made again at worst.
    """
    earlier = F.sequence(F.lit(0), F.col("number"))
    same = lambda k: F.coalesce(F.get("halves", k) == F.get("halves2", k), F.lit(False))
    return ~F.exists(earlier, lambda k: (k < F.col("number")) & (F.getbit("led", k) == 1) & same(k))


def _pairs(rows: DataFrame, bags: DataFrame, compared: DataFrame | None) -> DataFrame:
    """member, pivot: the pairs of a pivot and a member of another class, once each.

    Rows carry bit maps of their shingles into the join, so that pairs that cannot pass
    are not made.
    """
    each = [F.get("map", F.lit(i)).alias(f"m{i}") for i in range(MAP_LONGS)]
    about = ("kinds", "total", "heavy", "most")
    carried = rows.join(bags.select("member", "halves", *about, *each), "member")
    # Of each pivot, a bit for every number of a band that it leads.
    bit = F.expr("shiftleft(1, number)")
    led = F.bit_or(bit).over(Window.partitionBy("member"))
    pivots = carried.where("pivot").select(
        F.col("band").alias("band2"),
        F.col("member").alias("hub"),
        F.col("label").alias("hub_label"),
        *[F.col(f"m{i}").alias(f"w{i}") for i in range(MAP_LONGS)],
        *[F.col(c).alias(f"{c}2") for c in about],
        F.col("halves").alias("halves2"),
        led.alias("led"),
    )
    across = (F.col("band") == F.col("band2")) & (F.col("label") != F.col("hub_label"))
    both = carried.join(pivots, across & _may_be_similar() & _meets_first())
    pairs = both.groupBy(
        F.least("member", "hub").alias("low"), F.greatest("member", "hub").alias("high")
    ).agg(F.min("hub").alias("pivot"))
    if compared is not None:
        pairs = pairs.join(compared, ["low", "high"], "left_anti")
    member = F.when(F.col("pivot") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    return materialize(pairs.select("low", "high", member.alias("member"), "pivot"))


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (member, pivot) that pass the threshold."""
    # Few pivots have more partners than a task should: their bags are copied.
    uses = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("uses"))
    hot = materialize(uses.where(F.col("uses") > PER_TASK).select("pivot", F.ceil(F.col("uses") / PER_TASK).alias("fan")))
    one = F.lit(1).cast("long")
    salted = (
        pairs.select("member", "pivot")
        .join(hot, "pivot", "left")
        .select("member", "pivot", F.pmod(F.xxhash64("member"), F.coalesce("fan", one)).alias("salt"))
    )
    hubs = (
        bags.select(F.col("member").alias("pivot"), F.col("value").alias("value2"), F.col("weight").alias("weight2"))
        .join(pairs.select("pivot").distinct(), "pivot")
        .join(hot, "pivot", "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("fan", one) - 1)))
        .drop("fan")
    )
    joined = salted.join(bags, "member").join(hubs, ["pivot", "salt"])
    found = materialize(bounded(joined.drop("salt")).mapInArrow(_verify, "member long, pivot long"))
    release(hot)
    return found


def _classes(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """member, label of all members of buckets."""
    buckets = _buckets(sketches)
    labels = materialize(buckets.select("member").distinct().withColumn("label", F.col("member")))
    if labels.isEmpty():
        return labels
    bags = _bags(rows, sketches, buckets)
    state = buckets.withColumns({"label": F.col("member"), "done": F.lit(False)})
    compared, budget = None, PAIRS
    while True:
        rows_open = _open_rows(state, budget)
        if rows_open.isEmpty():
            break
        pairs = _pairs(rows_open, bags, compared)
        found = _similar(pairs, bags)
        side = lambda x: labels.select(F.col("member").alias(x), F.col("label").alias(f"{x}_label"))  # noqa: B023, E731
        edges = found.join(side("member"), "member").join(side("pivot"), "pivot")
        labels = components(labels, edges.select(F.col("member_label").alias("a"), F.col("pivot_label").alias("b")))
        release(found)
        past = pairs.select("low", "high")
        compared = past if compared is None else compared.unionByName(past)
        state = rows_open.select("band", "number", "member", "size", (F.col("done") | F.col("pivot")).alias("done")).join(
            labels, "member"
        )
        budget *= GROWTH
    release(buckets, bags)
    return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, mark.

    ``class_id`` is the least id of the class, whose row stays; an id with two texts may
    name two classes. ``mark`` is a hash of id
    and text, which tells apart rows that share an id.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id"), text).alias("mark"), text.alias("text")
    )
    sketches = materialize(
        map_texts(rows, _sketch, "doc_id long, mark long, digest long, bands array<long>", PART_CHARS)
    )
    labels = _classes(rows, sketches).withColumnRenamed("member", "digest")
    named = sketches.select("doc_id", "mark", "digest").join(labels, "digest", "left")
    named = materialize(
        named.select("doc_id", "mark", F.coalesce("label", "digest").alias("label"))
    )
    # Of rows that share the least id of a class, the one with the least mark stays.
    classes = named.groupBy("label").agg(
        F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("least"),
    )
    return named.join(classes, "label").select(
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        "class_size",
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("mark") == F.col("least.mark"))).alias("kept"),
        "mark",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class."""
    found = materialize(near_duplicates(docs))
    gone = found.where("not kept").select("mark").distinct()
    same = "xxhash64(d.doc_id, coalesce(d.text, '')) = g.mark"
    rest = docs.alias("d").join(gone.alias("g"), F.expr(same), "left_anti")
    repeated = materialize(found.where("kept").groupBy("mark").count().where("count > 1").select("mark"))
    if repeated.isEmpty():
        return rest
    repeated = repeated.alias("g")
    once = rest.alias("d").join(repeated, F.expr(same), "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.alias("d").join(repeated, F.expr(same), "left_anti").unionByName(once)

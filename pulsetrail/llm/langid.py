"""Language identification by interpolated Kneser-Ney character models.

Per language, counts of character 4-grams inside words (lower case, letters only) are
gathered from the training texts. Lower orders use continuation counts, the number of
different symbols that precede a gram; grams at the start of a word, which nothing
precedes, keep their counts. The model of all languages is one sorted array of gram hashes
per order, with a row of discounted probabilities, one per language, and one sorted array
of context hashes with the interpolation weights.

A text gets the language with the lowest cross-entropy per symbol. ``score`` is its share
of the evidence, with at most ``EVIDENCE`` symbols counted, so that long texts do not all
score 1. A text is rejected when its cross-entropy is further above those of the training
texts of its language than ``MARGIN`` bits beyond their ``QUANTILE`` quantile, or when it has
no letter.

Discounts, continuation counts and context totals are computed by Spark over all grams, also
those seen once. Every symbol is in the model. Of each higher order, all grams are, up to
``MODEL_GRAMS`` of all languages, which bounds what the driver gathers and broadcasts. Where
there are more, those with the smallest counts (below a power of two) have no entry of their
own there, and their mass is added to the weight with which their context goes to the lower
order, so that the broadcast model by itself still adds up to 1. Texts are scored exactly all
the same: all grams stay in Spark tables, and a symbol whose grams are not all broadcast is
scored by joins with them, once for each different gram.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows with a
null language are not learned from; without any training row every text is ``und``, and
only those without a letter are rejected;
equal texts get equal results; rows repeat as they come; columns other than ``doc_id``,
``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.ngrams import Grams, distinct_rows, find, hash_columns
from pulsetrail.llm.wordbatch import Words, map_texts, split_ascii, text_sums
from pulsetrail.materialize import materialize, release

ORDER = 4
MODEL_GRAMS = 1 << 20
CACHE_WORDS = 200_000
BLOCK_WORDS = 20_000
SYMBOLS = 1 << 16  # an unseen symbol is one of so many
EVIDENCE = 50
QUANTILE = 0.999
MARGIN = 2.0
UNDEFINED = "und"
_COLUMNS = [f"s{k}" for k in range(ORDER - 1, -1, -1)]
_LOST = pa.struct([*[(c, pa.int64()) for c in _COLUMNS], ("uses", pa.int64())])


def _letters(words: Words) -> tuple[np.ndarray, list[str]]:
    """What is left of the words in lower case: runs of letters, parted by a space.

    The first value is the number of each word's remains in the second.
    """
    lower = pc.utf8_lower(words.distinct)
    kept = pc.utf8_trim(pc.replace_substring_regex(lower, r"\P{L}+", " "), " ").dictionary_encode()
    return kept.indices.to_numpy()[words.codes], kept.dictionary.to_pylist()


def _grams(remains: list[str]) -> tuple[Grams, np.ndarray]:
    """Grams of all runs, and whose remains each predicted symbol is of."""
    runs = [r.split(" ") if r else [] for r in remains]
    source = np.repeat(np.arange(len(runs)), np.fromiter(map(len, runs), np.int64, len(runs)))
    grams = Grams([run for found in runs for run in found])
    return grams, source[grams.word[grams.predicted]] if len(source) else source


def _count_grams(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = split_ascii(batch["text"])
    codes, remains = _letters(words)
    grams, source = _grams(remains)
    columns = grams.columns(ORDER)
    languages = batch["lang"].dictionary_encode()
    row_of = np.repeat(np.arange(batch.num_rows), np.diff(words.starts))
    language_of = languages.indices.to_numpy()[row_of]
    out = []
    for number, language in enumerate(languages.dictionary.to_pylist()):
        counts = np.bincount(codes[language_of == number], minlength=len(remains))[source]
        used = np.flatnonzero(counts)
        kept, sums = distinct_rows([c[used] for c in columns], counts[used])
        out.append(pa.RecordBatch.from_arrays(
            [pa.repeat(language, len(sums)), *map(pa.array, kept), pa.array(sums)],
            names=["lang", *_COLUMNS, "n"],
        ))
    return pa.concat_batches(out)


@dataclass
class Model:
    """Sorted hash arrays; row k - 1 of each list is order k."""

    languages: list[str]
    grams: list[np.ndarray]
    shares: list[np.ndarray]  # grams + 1 rows, the last 0
    contexts: list[np.ndarray]
    weights: list[np.ndarray]  # contexts + 1 rows, the last 1
    base: np.ndarray
    #: Weights of contexts whose grams outside the model are looked up; None if the order has all grams.
    exact: list[np.ndarray | None] = field(default_factory=lambda: [None] * ORDER)
    known: dict[str, int] = field(default_factory=dict)  # rows of the two below
    costs: np.ndarray | None = None
    sizes: np.ndarray | None = None

    def words_and_lost(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Costs in bits by language, and numbers of symbols, of remains of words; numbers of
        words with grams to be looked up, whose cost is left out, and the symbols of each.

        The first CACHE_WORDS without such grams that a Python worker sees are remembered.
        """
        if self.costs is None:
            self.costs = np.zeros((CACHE_WORDS, len(self.languages)), np.float32)
            self.sizes = np.zeros(CACHE_WORDS, np.int32)
        rows = np.fromiter((self.known.get(w, -1) for w in distinct), np.int64, len(distinct))
        costs, sizes = self.costs[rows], self.sizes[rows]
        missing = np.flatnonzero(rows < 0)
        owners, lost = [np.zeros(0, np.int64)], [[np.zeros(0, np.int64)] * ORDER]
        for at in np.split(missing, range(BLOCK_WORDS, len(missing), BLOCK_WORDS)):
            costs[at], sizes[at], owner, columns = self._fresh([distinct[i] for i in at])
            owners.append(at[owner])
            lost.append(columns)
            at = np.delete(at, owner)
            room = CACHE_WORDS - len(self.known)
            first = len(self.known)
            self.known.update(zip([distinct[i] for i in at[:room]], range(first, first + room)))
            last = len(self.known)
            self.costs[first:last], self.sizes[first:last] = costs[at[:room]], sizes[at[:room]]
        return costs, sizes, np.concatenate(owners), [np.concatenate(c) for c in zip(*lost)]

    def words(self, distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Costs and numbers of symbols alone."""
        costs, sizes, *_ = self.words_and_lost(distinct)
        return costs, sizes

    def _fresh(self, remains: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        out = np.zeros((len(remains), len(self.languages)))
        grams, source = _grams(remains)
        if not len(source):
            nothing = np.zeros(0, np.int64)
            return out, np.zeros(len(remains), np.int64), nothing, [nothing] * ORDER
        sure = self.sure(grams)
        bits = np.where(sure[:, None], self.bits(grams, True), 0.0)
        for number in range(out.shape[1]):
            out[:, number] = np.bincount(source, weights=bits[:, number], minlength=len(out))
        columns = [c[~sure] for c in grams.columns(ORDER)]
        return out, np.bincount(source, minlength=len(out)), source[~sure], columns

    def sure(self, grams: Grams) -> np.ndarray:
        """Whether the model has all grams that end at each predicted symbol, or all of their order."""
        columns = grams.columns(ORDER)
        depth = grams.depth[grams.predicted]
        out = np.ones(len(depth), bool)
        for k in range(2, ORDER + 1):
            if self.exact[k - 1] is not None:
                at = np.flatnonzero(depth >= k - 1)
                found = find(self.grams[k - 1], hash_columns([c[at] for c in columns[-k:]]))
                out[at] &= found < len(self.grams[k - 1])
        return out

    def bits(self, grams: Grams, exact: bool = False) -> np.ndarray:
        """Cost of each predicted symbol in each language.

        ``exact``: as by the model of all grams, where a symbol is sure.
        """
        columns = grams.columns(ORDER)
        depth = grams.depth[grams.predicted]
        chance = self.base[None, :] + self.shares[0][find(self.grams[0], hash_columns(columns[-1:]))]
        for k in range(2, ORDER + 1):
            at = np.flatnonzero(depth >= k - 1)
            part = [c[at] for c in columns[-k:]]
            weights = self.exact[k - 1] if exact and self.exact[k - 1] is not None else self.weights[k - 1]
            weight = weights[find(self.contexts[k - 1], hash_columns(part[:-1]))]
            share = self.shares[k - 1][find(self.grams[k - 1], hash_columns(part))]
            chance[at] = share + weight * chance[at]
        return -np.log2(chance)


def join_orders(by_language: dict[str, list[tuple]]) -> Model:
    """One model from the orders of each language."""
    languages = sorted(by_language)
    orders = [by_language[language] for language in languages]
    model = Model(languages, [], [], [], [], np.array([o[0][3][0] / SYMBOLS for o in orders]))
    for k in range(ORDER):
        for hashes, tables, column, default in (
            (model.grams, model.shares, 0, 0.0),
            (model.contexts, model.weights, 2, 1.0),
        ):
            keys = np.unique(np.concatenate([o[k][column] for o in orders]))
            table = np.full((len(keys) + 1, len(languages)), default)
            for number, o in enumerate(orders):
                table[np.searchsorted(keys, o[k][column]), number] = o[k][column + 1]
            hashes.append(keys)
            tables.append(table)
        if orders[0][k][4] is not None:
            model.exact[k] = np.full_like(model.weights[k], 1.0)
            for number, o in enumerate(orders):
                model.exact[k][np.searchsorted(model.contexts[k], o[k][2]), number] = o[k][4]
    return model


def train(docs: DataFrame) -> Model | None:
    """Learn from all rows of ``docs`` (text, lang) that have a language."""
    return train_tables(docs)[0]


def train_tables(docs: DataFrame) -> tuple[Model | None, list[tuple[DataFrame, DataFrame]]]:
    """The model; if it lacks grams, for each order all of them with their shares (lang,
    symbols, share), and all contexts with their weights (lang, symbols, weight)."""
    rows = docs.select("text", "lang").where("lang is not null and text is not null")
    schema = ", ".join(["lang string", *[f"{c} long" for c in _COLUMNS], "n long"])
    counted = materialize(
        map_texts(rows, _count_grams, schema)
        .groupBy("lang", *_COLUMNS)
        .agg(F.sum("n").alias("n"))
    )
    languages = [r.lang for r in counted.select("lang").distinct().collect()]
    if not languages:
        return None, []
    by_language: dict[str, list[tuple]] = {language: [] for language in languages}
    tables = []
    orders = _orders(counted)
    shortened = any(grams.count() > MODEL_GRAMS for grams in orders[1:])
    for order, grams in enumerate(orders, 1):
        parts, table = _listed(grams, order, languages, shortened)
        tables.append(table)
        for language, part in parts.items():
            by_language[language].append(part)
    release(counted)
    return join_orders(by_language), tables if shortened else []


def _orders(counted: DataFrame) -> list[DataFrame]:
    """lang, symbols and count c of the grams of each order.

    Of the longest grams how often they occur; below, how many different symbols come
    before a gram, and how often it occurs where it starts a word, as nothing precedes it.
    """
    found = [counted.where(F.col(_COLUMNS[0]) > 0).select("lang", *_COLUMNS, F.col("n").alias("c"))]
    for k in range(ORDER - 1, 0, -1):
        columns, front = _COLUMNS[ORDER - k :], _COLUMNS[ORDER - k - 1]
        # One per different symbol in front, and what starts a word as it is.
        uses = found[-1].select("lang", *columns, F.lit(1).cast("long").alias("c"))
        if k > 1:
            begun = counted.where((F.col(front) == 0) & (F.col(columns[0]) > 0))
            uses = uses.unionByName(begun.select("lang", *columns, F.col("n").alias("c")))
        found.append(materialize(uses.groupBy("lang", *columns).agg(F.sum("c").alias("c"))))
    return found[::-1]


def _listed(
    grams: DataFrame, order: int, languages: list[str], shortened: bool
) -> tuple[dict[str, tuple], tuple[DataFrame, DataFrame] | None]:
    """Per language: hashes and discounted shares of grams, hashes and weights of contexts,
    and these contexts' weights in the model of all grams, if that is another.

    Second value, if ``shortened``: shares of all grams, weights of all contexts.
    """
    columns = _COLUMNS[ORDER - order :]
    context = columns[:-1]
    sizes = grams.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos"))
    discount = dict.fromkeys(languages, 0.5)
    for r in sizes.collect():
        if r.ones + r.twos:
            discount[r.lang] = min(max(r.ones / (r.ones + 2 * r.twos), 0.1), 0.9)
    least = 1
    if order > 1 and shortened:
        tops = materialize(grams.groupBy(*columns).agg(F.max("c").alias("top"), F.count(F.lit(1)).alias("rows")))
        least = _least(tops)
    if least > 1:
        # A gram is listed in all languages or in none.
        marked = grams.alias("g").join(tops.alias("t"), _same("g", "t", columns))
        grams = materialize(marked.select("g.*", (F.col("t.top") >= least).alias("listed")))
    else:
        grams = grams.withColumn("listed", F.lit(True))
    contexts = materialize(grams.groupBy("lang", *context).agg(
        F.sum("c").alias("total"),
        F.count(F.lit(1)).alias("kinds"),
        F.sum(F.when(F.col("listed"), 0).otherwise(F.col("c"))).alias("left_out"),
        F.count_if(~F.col("listed")).alias("left_kinds"),
    ))
    joined = grams.alias("g").join(contexts.alias("t"), _same("g", "t", ["lang", *context])).select("g.*", "t.total")
    table = None
    if shortened:
        pairs = [F.lit(x) for language in languages for x in (language, discount[language])]
        d = F.create_map(*pairs)[F.col("lang")]
        share = ((F.col("c") - d) / F.col("total")).alias("share")
        weight = (d * F.col("kinds") / F.col("total")).alias("weight")
        table = (
            materialize(joined.select("lang", *columns, share)), materialize(contexts.select("lang", *context, weight))
        )
    if least > 1:
        # Without a listed gram all mass goes to the lower order, as for an unseen context.
        some = F.max(F.col("kinds") > F.col("left_kinds")).over(Window.partitionBy(*context))
        contexts = contexts.withColumn("some", some).where("some").drop("some")
    listed, contexts = joined.where("listed").drop("listed").toArrow(), contexts.toArrow()
    out = {}
    for language in languages:
        g, t = (table_.filter(pc.equal(table_["lang"], language)) for table_ in (listed, contexts))
        symbols = [g[c].to_numpy() for c in columns]
        before = [t[c].to_numpy() for c in context]
        total, d = t["total"].to_numpy(), discount[language]
        keys = hash_columns(before) if before else np.zeros(len(total), np.uint64)
        left = t["left_out"].to_numpy() - d * t["left_kinds"].to_numpy()
        weight = (d * t["kinds"].to_numpy() + left) / total
        share = (g["c"].to_numpy() - d) / g["total"].to_numpy()
        whole = d * t["kinds"].to_numpy() / total if least > 1 else None
        out[language] = (hash_columns(symbols), share, keys, weight, whole)
    return out, table


def _same(a: str, b: str, columns: list[str]) -> Column:
    return reduce(and_, [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in columns], F.lit(True))


def _least(tops: DataFrame) -> int:
    """The smallest count, 1 or another power of two, with at most MODEL_GRAMS grams.

    ``tops`` has the largest count of a gram in any language, and the number of languages.
    """
    sizes = tops.groupBy(F.floor(F.log2("top")).alias("power")).agg(F.sum("rows").alias("rows")).collect()
    room, least = MODEL_GRAMS, 1 << (max((r.power for r in sizes), default=0) + 1)
    for r in sorted(sizes, reverse=True):
        room -= r["rows"]
        if room < 0:
            break
        least = 1 << r.power
    return 1 if room >= 0 else least


def _look_up(grams: DataFrame, model: Model, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """The symbols of each gram, and ``bits``: the cost of its last one in every language."""
    spark = grams.sparkSession
    bases = [(language, number, float(base)) for number, (language, base) in enumerate(zip(model.languages, model.base))]
    found = grams.crossJoin(F.broadcast(spark.createDataFrame(bases, "lang string, number int, chance double")))
    for k, (shares, weights) in enumerate(tables, 1):
        columns = ["lang", *_COLUMNS[ORDER - k :]]
        found = found.join(shares, columns, "left")
        if k == 1:
            chance = F.coalesce("share", F.lit(0.0)) + F.col("chance")
        else:
            found = found.join(weights, columns[:-1], "left")
            longer = F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("chance")
            # Beyond the start of the word there is no symbol.
            chance = F.when(F.col(columns[1]) > 0, longer).otherwise(F.col("chance"))
        found = found.select("lang", *_COLUMNS, "number", chance.alias("chance"))
    each = F.array_sort(F.collect_list(F.struct("number", (-F.log2("chance")).alias("bits"))))
    return found.groupBy(*_COLUMNS).agg(each["bits"].alias("bits"))


def _lost_of_rows(codes: np.ndarray, starts: np.ndarray, owner: np.ndarray, columns: list[np.ndarray]) -> pa.Array:
    """Per text the grams to be looked up, with their uses; word ``owner`` has each of them."""
    rows, kinds = len(starts) - 1, int(codes.max(initial=0)) + 1
    order = np.argsort(owner, kind="stable")
    first, last = (np.searchsorted(owner[order], np.arange(kinds), side) for side in ("left", "right"))
    some = (last > first)[codes]
    pair, uses = np.unique(np.repeat(np.arange(rows), np.diff(starts))[some] * kinds + codes[some], return_counts=True)
    size = (last - first)[pair % kinds]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    gram = order[np.repeat(first[pair % kinds], size) + inside]
    edges = np.concatenate([[0], np.cumsum(np.bincount(pair // kinds, weights=size, minlength=rows))])
    values = [pa.array(c[gram]) for c in columns] + [pa.array(np.repeat(uses, size))]
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.StructArray.from_arrays(values, fields=list(_LOST)))


def _predict_exactly(
    docs: DataFrame, model: Model, keep: list[str], tables: list[tuple[DataFrame, DataFrame]]
) -> DataFrame:
    """``predict`` for a model that lacks grams."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_ascii(batch["text"])
        codes, remains = _letters(words)
        costs, symbols, owner, columns = shared.value.words_and_lost(remains)
        count = text_sums(symbols[codes].astype(np.int64), words.starts)
        sums = np.column_stack([text_sums(c[codes].astype(float), words.starts) for c in costs.T])
        edges = np.arange(batch.num_rows + 1) * sums.shape[1]
        return pa.RecordBatch.from_arrays(
            [
                *[batch[c] for c in [*keep, "_text"]],
                pa.array(count),
                pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(sums.ravel())),
                _lost_of_rows(codes, words.starts, owner, columns),
            ],
            names=[*keep, "_text", "symbols", "costs", "lost"],
        )

    types = dict(docs.dtypes)
    lost = ", ".join(f"{c}: long" for c in [*_COLUMNS, "uses"])
    schema = ", ".join(
        [*[f"`{c}` {types[c]}" for c in keep], f"_text long, symbols long, costs array<double>, lost array<struct<{lost}>>"]
    )
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text")
    scored = materialize(map_texts(docs.select(*keep, mark, "text"), work, schema))
    shared.destroy()
    # Equal texts lack the same grams.
    once = scored.where(F.size("lost") > 0).select("_text", "lost").dropDuplicates(["_text"])
    each = materialize(once.select("_text", F.explode("lost").alias("l")).select("_text", "l.*"))
    bits = materialize(_look_up(each.select(*_COLUMNS).distinct(), model, tables))
    sums = [F.sum(F.col("uses") * F.get("bits", F.lit(i))) for i in range(len(model.languages))]
    more = each.join(bits, _COLUMNS).groupBy("_text").agg(F.array(*sums).alias("more"))
    whole = F.zip_with("costs", "more", lambda a, b: (a + F.coalesce(b, F.lit(0.0))) / F.greatest("symbols", F.lit(1)))
    entropy = F.when(F.col("more").isNull(), F.transform("costs", lambda a: a / F.greatest("symbols", F.lit(1)))).otherwise(whole)
    counted = F.least("symbols", F.lit(EVIDENCE))
    evidence = F.transform("each", lambda e: F.pow(F.lit(2.0), -(e - F.array_min("each")) * counted))
    total = F.aggregate(evidence, F.lit(0.0), lambda a, b: a + b)
    names = F.array(*[F.lit(language) for language in model.languages])
    best = F.get(names, (F.array_position("each", F.array_min("each")) - 1).cast("int"))
    known = F.col("symbols") > 0
    return scored.join(more, "_text", "left").withColumn("each", entropy).select(
        *[F.col(c) for c in keep],
        F.when(known, best).otherwise(F.lit(UNDEFINED)).alias("lang_pred"),
        F.when(known, 1 / total).otherwise(F.lit(0.0)).alias("score"),
        F.when(known, F.array_min("each")).alias("entropy"),
        "symbols",
    )


def predict(
    docs: DataFrame, model: Model | None, keep: list[str], tables: list[tuple[DataFrame, DataFrame]] = ()
) -> DataFrame:
    """The columns ``keep`` of ``docs``, and lang_pred, score, entropy, symbols.

    ``tables`` has what the model lacks, if it does.
    """
    kept = [F.col(c) for c in keep]
    if model is None:
        return docs.select(
            *kept,
            F.lit(UNDEFINED).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("entropy"),
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\p{L}")).cast("long").alias("symbols"),
        )
    if tables:
        return _predict_exactly(docs, model, keep, tables)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        words = split_ascii(batch["text"])
        codes, remains = _letters(words)
        costs, symbols = model.words(remains)
        count = text_sums(symbols[codes].astype(float), words.starts)
        entropy = np.column_stack([text_sums(c[codes].astype(float), words.starts) for c in costs.T])
        entropy /= np.maximum(count, 1)[:, None]
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(best)), best]
        weight = np.exp2(-(entropy - least[:, None]) * np.minimum(count, EVIDENCE)[:, None])
        names = np.where(count > 0, np.array(model.languages, object)[best], UNDEFINED)
        return pa.RecordBatch.from_arrays(
            [
                *[batch[c] for c in keep],
                pa.array(names.tolist(), pa.string()),
                pa.array(np.where(count > 0, 1 / weight.sum(axis=1), 0.0)),
                pa.array(least, mask=count == 0),
                pa.array(count.astype(np.int64)),
            ],
            names=[*keep, "lang_pred", "score", "entropy", "symbols"],
        )

    types = dict(docs.dtypes)
    schema = ", ".join(
        [*[f"`{c}` {types[c]}" for c in keep], "lang_pred string, score double, entropy double, symbols long"]
    )
    found = map_texts(docs.select(*kept, "text"), work, schema)
    found._pulsetrail_model = shared
    return found


def _written(predicted: DataFrame) -> DataFrame:
    """Predictions as a table; executors need not hold the model any longer."""
    copy = materialize(predicted)
    shared = getattr(predicted, "_pulsetrail_model", None)
    if shared is not None:
        shared.destroy()
    return copy


def with_rejection(predicted: DataFrame, lang: str, learned: str) -> DataFrame:
    """Add ``rejected``. Limits come from the rows where ``learned`` holds and ``lang`` is right.

    ``predicted`` is read twice: pass a written table.
    """
    limits = (
        predicted.where(F.col(learned) & (F.col(lang) == F.col("lang_pred")))
        .groupBy("lang_pred")
        .agg((F.percentile_approx("entropy", QUANTILE, 10_000) + MARGIN).alias("limit"))
    )
    # A language nobody was right about has no limit, and nothing is rejected for it.
    beyond: Column = F.coalesce(F.col("entropy") > F.col("limit"), F.lit(False))
    return (
        predicted.join(materialize(limits), "lang_pred", "left")
        .withColumn("rejected", (F.col("symbols") == 0) | beyond)
        .drop("limit")
    )


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per row: doc_id, mark, held_out, lang_pred, score, entropy, rejected.

    Learns from the rows outside ``held_out``. ``mark`` is a hash of the text, which
    tells apart rows that share an id.
    """
    rows = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        "text",
        F.col("lang").alias("lang"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    model, tables = train_tables(rows.where("not held_out"))
    predicted = _written(predict(rows, model, ["doc_id", "mark", "lang", "held_out"], tables))
    release(*[t for pair in tables for t in pair])
    judged = with_rejection(predicted.withColumn("learned", ~F.col("held_out")), "lang", "learned")
    return judged.select("doc_id", "mark", "held_out", "lang_pred", "score", "entropy", "rejected")


def drop_rejected(docs: DataFrame, held_out: Column) -> DataFrame:
    """``docs`` without the rows that are rejected."""
    gone = identify(docs, held_out).where("rejected").select("doc_id", "mark").distinct()
    same = "d.doc_id <=> g.doc_id and xxhash64(coalesce(d.text, '')) = g.mark"
    return docs.alias("d").join(materialize(gone).alias("g"), F.expr(same), "left_anti")

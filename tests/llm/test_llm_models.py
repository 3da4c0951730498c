"""Language ID, quality, suffix tree: brute-force versions, sums to 1, held-out accuracy."""

import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llmdata import CLASHES, EDGES, edges, empty, prose, rows_of, table
from pyspark.sql import functions as F

from pulsetrail.llm import langid, quality, suffix_tree
from pulsetrail.llm.ngrams import END, START, Grams, distinct_rows, hash_columns
from pulsetrail.llm.queries import fold
from pulsetrail.llm.wordbatch import Words, split_ascii, split_on

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_folds(spark):
    rows = documents(spark).select("doc_id", fold(7).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 7 for r in rows)


# ---- language ID


class PlainKneserNey:
    """The textbook recursion over dictionaries."""

    def __init__(self, words, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for word, uses in words.items():
            symbols = [START, *word, END]
            for i in range(1, len(symbols)):
                self.counts[order][tuple(symbols[max(i - order + 1, 0) : i + 1])] += uses
        top = self.counts[order]
        self.counts[order] = Counter({g: n for g, n in top.items() if len(g) == order})
        begun = {g: n for g, n in top.items() if len(g) < order}
        for k in range(order - 1, 0, -1):
            for gram in self.counts[k + 1]:
                self.counts[k][gram[1:]] += 1
            self.counts[k].update({g: n for g, n in begun.items() if len(g) == k})
        self.discount, self.totals, self.kinds = [0] * (order + 1), [None], [None]
        for k in range(1, order + 1):
            values = list(self.counts[k].values())
            ones, twos = values.count(1), values.count(2)
            self.discount[k] = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5
            totals, kinds = Counter(), Counter()
            for gram, n in self.counts[k].items():
                totals[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            self.totals.append(totals)
            self.kinds.append(kinds)

    def chance(self, gram):
        k = len(gram)
        if not k:
            return 1 / langid.SYMBOLS
        total = self.totals[k][gram[:-1]]
        if not total:
            return self.chance(gram[1:])
        d = self.discount[k]
        own = max(self.counts[k][gram] - d, 0) / total
        return own + d * self.kinds[k][gram[:-1]] / total * self.chance(gram[1:])

    def bits(self, word):
        symbols = [START, *word, END]
        return [
            -math.log2(self.chance(tuple(symbols[max(i - self.order + 1, 0) : i + 1])))
            for i in range(1, len(symbols))
        ]


def letter_words(seed, n, size):
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("abcdefghij"), rng.integers(1, 8))) for _ in range(size)]
    return [pool[int(i)] for i in rng.integers(size, size=n)]


def model_of(spark, words):
    return langid.train(table(spark, [(1, " ".join(words.elements()), "xx", None)]))


def test_kneser_ney_against_the_recursion(spark):
    words = Counter(letter_words(4, 3000, 90))
    words.update({"a": 5, "aa": 3, "aaaa": 2, "b": 1, "äö": 4})
    plain, model = PlainKneserNey(words, langid.ORDER), model_of(spark, words)
    for word in [*list(words)[:60], "zzz", "aaaaab", "éé", "q"]:
        got = model.bits(Grams([word]))[:, 0]
        assert got == pytest.approx(plain.bits(word)), word


def test_kneser_ney_sums_to_one(spark):
    words = Counter(letter_words(5, 2000, 60))
    model = model_of(spark, words)
    letters = sorted({c for w in words for c in w})
    for start in ["", letters[0], letters[1] + letters[2], next(iter(words))[:3]]:
        total = sum(2.0 ** -model.bits(Grams([start + c]))[len(start), 0] for c in letters)
        total += 2.0 ** -model.bits(Grams([start]))[-1, 0]
        unseen = langid.SYMBOLS - len(letters) - 1
        total += unseen * 2.0 ** -model.bits(Grams([start + "λ"]))[len(start), 0]
        assert total == pytest.approx(1, abs=2e-4)


def test_trained_model_counts_what_is_rare(spark):
    # 1.6 million grams, so that one use is less than a millionth of them.
    text, rare = " ".join(letter_words(1, 10_000, 500)), "ñandú zyxwv abzzé"
    docs = table(spark, [(i, text, "xx", None) for i in range(36)] + [(99, rare, "xx", None), (100, "a bc", "yy", None)])
    model = langid.train(docs)
    for number, words in enumerate([Counter({w: 36 * n for w, n in Counter(text.split()).items()}) + Counter(rare.split()), Counter(["a", "bc"])]):
        plain = PlainKneserNey(words, langid.ORDER)
        for word in ["ñandú", "zyxwv", "abzz", "dúa", "q", *text.split()[:20]]:
            assert model.bits(Grams([word]))[:, number] == pytest.approx(plain.bits(word)), word


def test_shortened_model_sums_to_one(spark, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_GRAMS", 150)
    words = Counter(letter_words(2, 3000, 300) + ["é"])
    text = " ".join(words.elements())
    model = langid.train(table(spark, [(1, text, "xx", None)]))
    assert 0 < len(model.grams[3]) <= 150 and len(model.grams[0]) == 12
    letters = sorted({c for w in words for c in w})
    for start in ["", "a", "ab", "é", next(iter(words))[:3]]:
        total = sum(2.0 ** -model.bits(Grams([start + c]))[len(start), 0] for c in letters)
        total += 2.0 ** -model.bits(Grams([start]))[-1, 0]
        total += (langid.SYMBOLS - len(letters) - 1) * 2.0 ** -model.bits(Grams([start + "λ"]))[len(start), 0]
        assert total == pytest.approx(1, abs=2e-4)


def test_shortened_model_scores_as_the_whole_one(spark, monkeypatch):
    rows = [(i, " ".join(letter_words(i, 60, 300)) + (" Ünï" if i % 5 == 0 else ""), "xyz"[i % 3], None) for i in range(30)]
    rows += [(40, " ".join(letter_words(2, 60, 900)), None, None), (40, None, "x", None), (41, "", "y", None), rows[3], rows[3]]
    docs = table(spark, rows)
    order = ["doc_id", "mark", "lang_pred"]
    want = langid.identify(docs, F.col("doc_id") > 24).orderBy(*order).collect()
    monkeypatch.setattr(langid, "MODEL_GRAMS", 150)
    model, tables = langid.train_tables(docs)
    assert len(model.grams[3]) <= 150 and tables[3][0].count() > 500
    got = langid.identify(docs, F.col("doc_id") > 24).orderBy(*order).collect()
    same = ("doc_id", "mark", "held_out", "lang_pred", "rejected")
    assert [[r[c] for c in same] for r in got] == [[r[c] for c in same] for r in want]
    for column in ("score", "entropy"):
        assert [r[column] or 0 for r in got] == pytest.approx([r[column] or 0 for r in want], rel=1e-4)


def test_held_out_languages(spark):
    docs = documents(spark)
    found = langid.identify(docs, fold(4) == 2).where("held_out").join(docs, "doc_id")
    right, n, rejected = found.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("lang"), F.count_if("rejected")
    ).first()
    assert n > 200 and right > 0.99 and rejected <= 0.005 * n


def test_rejection(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    noise = spark.createDataFrame(
        [(-1, " ".join("qxzjkvwq" for _ in range(60)), None), (-2, "1234 !!", None), (-3, None, None), (-4, "ΩЖ中 " * 50, None)],
        "doc_id long, text string, lang string",
    )
    kept = langid.drop_rejected(docs.unionByName(noise), F.lit(False))
    gone = docs.unionByName(noise).join(kept, "doc_id", "left_anti")
    assert {r.doc_id for r in gone.select("doc_id").where("doc_id < 0").collect()} == {-1, -2, -3, -4}
    assert gone.where("doc_id >= 0").count() <= 2


def test_langid_edges(spark):
    rows = langid.identify(edges(spark), F.lit(False)).collect()
    assert len(rows) == len(EDGES)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert all(by_id[i][0].lang_pred == "und" and by_id[i][0].score == 0 for i in (1, 2, 3))
    assert {r.lang_pred for r in rows} <= {"en", "fr", "und"}
    untrained = langid.identify(edges(spark), F.lit(True)).collect()
    assert {r.lang_pred for r in untrained} == {"und"}
    assert {r.doc_id for r in untrained if r.rejected} == {1, 2, 3}
    kept = langid.drop_rejected(edges(spark), F.lit(False))
    assert kept.columns == edges(spark).columns and kept.count() == len(EDGES) - 3
    assert langid.identify(empty(spark), F.lit(False)).count() == 0


def test_word_cache_changes_nothing(spark, monkeypatch):
    model = model_of(spark, Counter(letter_words(6, 500, 80)))
    words = sorted(set(letter_words(7, 800, 300)))
    costs, sizes = model.words(words)
    again, _ = model.words(words[::-1])
    monkeypatch.setattr(langid, "CACHE_WORDS", 10)
    monkeypatch.setattr(langid, "BLOCK_WORDS", 7)
    small = model_of(spark, Counter(letter_words(6, 500, 80)))
    for _ in range(2):
        other, lengths = small.words(words)
        assert np.allclose(other, costs) and (lengths == sizes).all()
    assert (again[::-1] == costs).all() and len(small.known) == 10


# ---- quality


def test_held_out_quality(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = quality.score_quality(docs, labels.where(fold(3) != 1)).join(labels, "doc_id").where(fold(3) == 1)
    rows = scored.select("quality", "score").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(bad) > 100 and wins > 0.99
    assert np.mean([(r.score >= 0.5) == r.quality for r in rows]) > 0.98


def plain_isotonic(values, weights):
    """Min-max formula."""
    n = len(values)
    mean = lambda i, j: np.average(values[i : j + 1], weights=weights[i : j + 1])
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(2)
    value, weight = rng.random(25), rng.integers(1, 9, 25)
    centres, levels = quality.isotonic(np.arange(25.0), value, weight)
    want = plain_isotonic(value, weight)
    assert levels == pytest.approx(sorted(set(np.round(want, 12)))) and (np.diff(centres) > 0).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20, quality.STATISTICS))
    kernel = quality.Kernel(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS), features=20_000)
    z = kernel(x)[:, 1:]
    want = np.exp(-quality.GAMMA * ((x[:, None] - x) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_statistics_by_hand():
    (row,) = quality.statistics(pa.array(["Aa bb! bb!\n12 | x"]))
    names = list(quality._CLASSES)
    share = lambda name: row[4 + names.index(name)] ** 2
    letters = 2 + 3 + 3 + 2 + 1 + 1
    assert row[1] == pytest.approx(math.log(7)) and row[3] == pytest.approx(math.log(2))
    assert share("upper") == pytest.approx(1 / letters) and share("shout") == pytest.approx(2 / letters)
    repeats, kinds, most = row[-5:-2]
    assert (repeats, kinds, most) == pytest.approx((1 / 6, 5 / 6, 2 / 6))


def test_quality_edges(spark):
    docs = edges(spark)
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (5, 1), (6, 1), (8, 0), (9, 0), (None, 1), (7, None), (99, 1), (4, 1)], "doc_id long, quality int"
    )
    scores = quality.score_quality(docs, labels)
    assert scores.count() == len(EDGES) and all(0 <= r.score <= 1 for r in scores.collect())
    none = quality.score_quality(docs, labels.where("false"))
    assert {r.score for r in none.collect()} == {0.5}
    one = quality.score_quality(docs, labels.where("quality = 1"))
    assert {r.score for r in one.collect()} == {1.0}
    assert quality.score_quality(empty(spark), labels).count() == 0


# ---- suffix tree


LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_base(texts, training):
    tokens = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in texts.items()}
    counts = Counter(t for i in training for t in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        for i, ts in tokens.items()
    }


@pytest.mark.parametrize("common", [2e-7, 1e-3])
def test_base_scores(spark, monkeypatch, common):
    monkeypatch.setattr(suffix_tree, "COMMON_SHARE", common)
    docs = documents(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = plain_base(texts, [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2])
    rows = suffix_tree.score_texts(docs, fold(7) == 2).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (*want[r.doc_id][:3], pytest.approx(want[r.doc_id][3]))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def chained(n, seed):
    """Texts in which the next word depends on the two before it."""
    rng = np.random.default_rng(seed)
    out, state = [], (0, 1)
    for _ in range(n):
        step = (state[0] * 2 + state[1]) % 5 if rng.random() < 0.9 else rng.integers(5)
        out.append("abcde"[step])
        state = (state[1], int(step))
    return " ".join(out)


def plain_next(text_tokens, model, symbols):
    """Probability of every token after the given ones, by the definition."""
    stream = np.array([suffix_tree._START, *[symbols[t] for t in text_tokens], suffix_tree._OTHER])
    root = model.root()
    total = 0.0
    for symbol in range(len(root)):
        if symbol == suffix_tree._START:
            continue
        stream[-1] = symbol
        gain = model.gains(stream, np.arange(len(stream)))[-1]
        total += root[symbol] * 10**gain
    return total


def test_tree_keeps_what_predicts(spark):
    docs = table(spark, [(i, chained(400, i), None, None) for i in range(40)])
    model, _ = suffix_tree.train(docs)
    assert len(model.levels) == 3 and len(model.levels[1].moves) > 50
    words = split_ascii(pa.array(["a b c d e"]))
    at = suffix_tree.find(model.common, suffix_tree._hashes(words))
    symbols = dict(zip(words.distinct.to_pylist(), model.symbol[at]))
    for context in ("", "a", "b a", "a b c", "e e e e"):
        assert plain_next(context.split(), model, symbols) == pytest.approx(1, abs=1e-6)
    scored = suffix_tree.score_texts(docs, F.col("doc_id") >= 30).where("held_out").collect()
    per_token = sum(r.score for r in scored) / sum(r.n_tokens for r in scored)
    # 0.92 right and 0.02 for each of the others: entropy 0.17 in log10, uniform 0.7.
    assert -0.2 < per_token < -0.165
    assert all(r.score > r.base_score + 100 for r in scored)


def test_tree_of_independent_words_is_its_root(spark):
    words = prose(1, 20_000, 50).split()
    docs = table(spark, [(i, " ".join(words[i * 500 : i * 500 + 500]), None, None) for i in range(40)])
    model, _ = suffix_tree.train(docs)
    assert [len(level.moves) for level in model.levels] == [0] * len(model.levels)
    assert model.root().sum() == pytest.approx(1)


def plain_tree(training):
    """Probability of a token after a context, by counting; None stands for both ends."""
    streams = [["<", *WORD.findall(t.translate(LOWER)), None] for t in training]
    grams = Counter(tuple(s[i : i + k]) for s in streams for k in range(1, 5) for i in range(len(s) - k + 1))
    listed = defaultdict(dict)
    for gram, n in grams.items():
        if len(gram) > 1 and n >= suffix_tree.PAIR_COUNT and grams[gram[:-1]] >= suffix_tree.CONTEXT_COUNT:
            listed[gram[:-1]][gram[-1]] = n
    tokens = sum(len(s) - 1 for s in streams)
    new = max(sum(n == 1 and len(g) == 1 and g[0] is not None for g, n in grams.items()), 1)
    kept = {}

    def chance(context, token):
        if not context:
            return grams.get((token,), new) / (tokens + new)
        shorter = chance(context[1:], token)
        if not kept.get(context):
            return shorter
        total, rest = grams[context], grams[context] - sum(listed[context].values())
        weight = suffix_tree.STRENGTH + rest
        return (listed[context].get(token, 0) + weight * shorter) / (total + suffix_tree.STRENGTH)

    for context in sorted(listed, key=len):
        total, n = grams[context], listed[context]
        before = {t: chance(context[1:], t) for t in n}
        rest = total - sum(n.values())
        bits = sum(c * math.log2(c / total / before[t]) for t, c in n.items())
        if rest:
            bits += rest * math.log2(rest / total / max(1 - sum(before.values()), 1e-12))
        named = len(n) * math.log2(len({g for g in grams if len(g) == 1} - {("<",)}))
        kept[context] = bits > suffix_tree.DIVERGENCE_BITS * (len(n) + (rest > 0)) + named
    return chance, kept


@pytest.mark.parametrize("head", [5e-7, 2e-3])
def test_tree_holds_every_context_of_the_fixed_count(spark, monkeypatch, head):
    # Where a phrase goes to depends on the third token before; each context of three is seen
    # 30 times among 90,000 tokens, which is less than 0.1 %.
    monkeypatch.setattr(suffix_tree, "HEAD_SHARE", head)
    phrase = " ".join(f"from{i} via over to{i}" for i in range(12))
    rows = [(i, prose(i, 3000) + " " + phrase, None, None) for i in range(30)] + [(99, phrase + " " + prose(99, 50), None, None)]
    chance, kept = plain_tree([r[1] for r in rows[:30]])
    assert sum(len(c) == 3 for c, k in kept.items() if k) >= 12
    docs = table(spark, rows)
    got = {r.doc_id: r.score for r in suffix_tree.score_texts(docs, F.col("doc_id") == 99).collect()}
    for i in (0, 99):
        stream = ["<", *rows[i if i < 30 else -1][1].split(), None]
        want = sum(math.log10(chance(tuple(stream[max(j - 3, 0) : j]), stream[j])) for j in range(1, len(stream)))
        assert got[i] == pytest.approx(want)


def test_token_hashes_depend_on_bytes_alone():
    tokens = ["a", "b", "ab", "ba", "a\0", "é", "abcdefgh", "abcdefghi", "abcdefgh\0", "x" * 16, "x" * 24, "ü" * 9, ""]
    alone = [suffix_tree._hashes(split_on(pa.array([t]), " "))[0] for t in tokens]
    together = suffix_tree._hashes(Words(np.zeros(0, int), pa.array(["-", *tokens, "+"]).slice(1, len(tokens)), None))
    assert together.tolist() == alone and len(set(alone)) == len(tokens)


def test_what_is_joined_is_rare_by_count(spark, monkeypatch):
    # It was rare by its share of all places, so that a growing part was joined as texts grew.
    monkeypatch.setattr(suffix_tree, "HEAD_SHARE", 1e-3)
    keys = lambda counts: spark.createDataFrame([(n,) for n in counts], "n long")
    head = lambda counts: sorted(r.n for r in keys(counts).where(suffix_tree._head(keys(counts))).collect())
    few, rare, more = [2] * 40, [2, 3, 19] * 300, [20] * 500 + [31, 32, 10**6] * 100
    assert head(few) == few and head([]) == []
    assert head(rare) == [] and head(rare * 9 + more) == sorted(more)
    assert head(rare + more * 3) == [32] * 300 + [10**6] * 300  # at most 1 / HEAD_SHARE


@pytest.mark.parametrize("length, parts, spread", [(1, 1, False), (1, 5, True), (2, 5, False), (3, 70_000, True)])
def test_transitions_travel_packed(length, parts, spread):
    # One row for each transition and task took more disk than the texts.
    texts = [prose(seed, 300, 12) for seed in range(4)] + ["", "one", None]
    streams = [["<", *WORD.findall((t or "").translate(LOWER)), ">"] for t in texts]
    grams = Counter(tuple(s[i : i + length + 1]) for s in streams for i in range(len(s) - length))
    words = sorted({t for s in streams for t in s[1:-1]})
    keys = dict(zip(words, suffix_tree._hashes(Words(np.zeros(0, int), pa.array(words), None)).tolist()))
    keys |= {"<": int(suffix_tree._HASHES[suffix_tree._START]), ">": int(suffix_tree._HASHES[suffix_tree._END])}

    def key(tokens):
        out = np.array([keys[tokens[0]] if tokens else 0])
        for t in tokens[1:]:
            out = suffix_tree._follow(out, np.array([keys[t]]))
        return int(out[0])

    common = np.sort([keys[w] for w in words[::2]])
    hot = np.sort([key(g[:-1]) for g in list(grams)[::3]]) if spread else np.zeros(0, np.int64)
    bits = np.full(1 << (suffix_tree.MAP_BITS - 6), -1, np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.string())], names=["text"]) for x in (texts[:3], texts[3:])]
    packed = pa.Table.from_batches([r for b in batches for r in suffix_tree._count_moves(iter([b]), length, bits, common, hot, parts)])
    assert packed.num_rows <= 2 * parts
    got = {}
    for part in suffix_tree._whole_parts(packed.sort_by("part").to_batches(max_chunksize=3)):
        for r in suffix_tree._add_moves(part, common).to_pylist():
            assert got.setdefault(r["move"], r) is r
    want = {key(g): n for g, n in grams.items() if n >= suffix_tree.PAIR_COUNT}
    assert {k: r["n"] for k, r in got.items()} == want
    for g in grams:
        if key(g) in got:
            r = got[key(g)]
            low = key(g[1:]) if length > 1 else keys[g[1]]
            assert (r["context"], r["low"], r["ends"]) == (key(g[:-1]), low, g[-1] == ">")


def test_tree_is_the_same_in_any_number_of_parts(spark, monkeypatch):
    docs = table(spark, [(i, prose(i % 20, 400, 30), None, None) for i in range(40)])
    scores = lambda: {r.doc_id: r.score for r in suffix_tree.score_texts(docs, F.col("doc_id") > 30).collect()}
    want = scores()
    monkeypatch.setattr(suffix_tree, "PART_BYTES", 5_000)
    assert scores() == pytest.approx(want)


def test_suffix_tree_edges(spark):
    docs = edges(spark)
    rows = suffix_tree.score_texts(docs, F.col("doc_id") == 9).collect()
    assert len(rows) == len(EDGES)
    texts = list(enumerate(t for _, t, *_ in EDGES))
    want = plain_base(dict(texts), [i for i, (d, *_) in enumerate(EDGES) if d != 9])
    got = sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert got == sorted((n, k, round(b, 6)) for n, k, _, b in want.values())
    twins = [r for r in rows if r.doc_id == 5]
    assert len(twins) == 2 and twins[0] == twins[1]
    untrained = suffix_tree.score_texts(docs, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in untrained)
    assert suffix_tree.score_texts(empty(spark), F.lit(False)).count() == 0


def test_hash_columns_and_names():
    assert len(set(CLASHES)) == len(CLASHES)
    grams = Grams(["ab", "", "abc"])
    columns = grams.columns(3)
    keys = hash_columns(columns)
    seen = {tuple(int(c[i]) for c in columns): k for i, k in enumerate(keys)}
    assert len(seen) == len(set(keys)) == 6  # ^a, ^ab, abE, ^E, abc, bcE

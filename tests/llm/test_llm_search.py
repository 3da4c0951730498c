"""Centroid clustering, decontamination and ranked search against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llmdata import CLASHES, EDGES, LONG, edges, empty, prose, table
from pyspark.sql import functions as F

from pulsetrail.llm import centroids, decontaminate, lexical_search
from pulsetrail.llm.centroids import cluster_vectors, nearest, walsh_hadamard
from pulsetrail.llm.decontaminate import contamination
from pulsetrail.llm.lexical_search import Shard, rank_documents

ITEMS = "item_id long, text string"
MORE = "window length first until print last spans items item set item_id term terms tfs rank score at _least".split()


def clashing(df):
    names = [n for n in (*CLASHES, *MORE) if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- centroids


def vectors(count, seed=5, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, 64)) * spread
    return centres[rng.integers(0, 7, count)] + rng.normal(size=(count, 64)) * 0.3 * spread


def plain_clusters(rows, clusters, rounds, seed=2):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
        and all(abs(256 * x) <= 2**27 for x in v)
    ]
    place = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    c = [v for _, v in sorted(kept, key=place)[:clusters]]

    def closest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), k) for k, x in enumerate(c))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[closest(v)[1]].append(v)
        c = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if groups[k] else v for k, v in enumerate(c)]
    found = [(i, *closest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, k, d in found:
        per[k] += d
    return Counter((i, k, d, per[k], sum(per.values()), tuple(c[k])) for i, k, d in found)


def clustered(df, **options):
    found = cluster_vectors(df, **options).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
    return Counter((*tuple(r)[:5], tuple(r["centroid"])) for r in found.collect())


def test_transform_keeps_distances_and_orders_by_sign_changes():
    x = np.random.default_rng(1).integers(-300, 300, (20, 64))
    h = walsh_hadamard(x)
    assert ((h**2).sum(axis=1) == 64 * (x**2).sum(axis=1)).all()
    basis = walsh_hadamard(np.eye(64, dtype=np.int64)).T
    assert ((np.diff(basis, axis=1) != 0).sum(axis=1) == np.arange(64)).all()


@pytest.mark.parametrize("peak", [1, 300, 2**24, 2**27])
def test_nearest_is_exact_with_ties(peak):
    rng = np.random.default_rng(peak)
    v, c = rng.integers(-peak, peak + 1, (60, 64)), rng.integers(-peak, peak + 1, (9, 64))
    c[5] = c[2]
    v[:10] = c[5]
    number, distance = nearest(v, c)
    for i in range(len(v)):
        want = min((sum((int(a) - int(b)) ** 2 for a, b in zip(v[i], x)), k) for k, x in enumerate(c))
        assert (int(distance[i]), int(number[i])) == want


def test_clusters_against_plain_python(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(300))]
    rows += [(3, rows[3][1]), (None, rows[5][1]), (900, [0.0] * 64), (901, [0.0] * 64)]
    rows += [
        (902, None), (903, []), (904, [0.5] * 63), (905, [0.5] * 63 + [None]), (906, [0.5] * 65),
        (907, [float("nan")] + [0.0] * 63), (908, [float("inf")] + [0.0] * 63), (909, [1e30] * 64),
    ]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    assert clustered(df, clusters=11, rounds=4) == plain_clusters(rows, 11, 4)


@pytest.mark.parametrize("count", [0, 1, 3])
def test_fewer_vectors_than_clusters(spark, count):
    rows = [(i, [float(i % 2)] * 64) for i in range(count)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert clustered(df) == plain_clusters(rows, 40, 5)


def test_wide_vectors_are_exact(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors(40, spread=1e5))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert clustered(df, clusters=6, rounds=3) == plain_clusters(rows, 6, 3)


# ---- decontamination

SPLIT = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = SPLIT.findall(lowered(text))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i : i + m])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = Counter()
    for doc_id, text in docs:
        w, hit, found = SPLIT.findall(lowered(text)), set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if (gram := tuple(w[i : i + m])) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[gram]
        runs = []
        for at in sorted(hit):
            if runs and runs[-1][1] == at - 1:
                runs[-1][1] = at
            else:
                runs.append([at, at])
        out[(doc_id, len(w), len(hit), tuple(map(tuple, runs)), tuple(sorted(found)))] += 1
    return out


def contaminated(docs, items, **options):
    found = contamination(docs, items, **options).select("doc_id", "n_words", "n_hit", "spans", "items").collect()
    return Counter((r[0], r[1], r[2], tuple(map(tuple, r[3])), tuple(r[4])) for r in found)


def check_contamination(spark, docs, items):
    rows = [(i, t, None, None) for i, t in docs]
    got = contaminated(clashing(table(spark, rows).repartition(4)), clashing(spark.createDataFrame(items, ITEMS)))
    assert got == plain_contamination(docs, items)


def test_planted_passages(spark):
    passage = [prose(100 + i, 30) for i in range(6)]
    cut = lambda i, a, b: " ".join(passage[i].split()[a:b])
    items = [(i, p) for i, p in enumerate(passage)]
    items += [(7, passage[0]), (8, cut(1, 0, 9)), (9, "Short ITEM"), (9, "other words of the same item"), (None, cut(2, 5, 20))]
    items += [(10, None), (11, "..."), (12, " ".join(["ha"] * 25)), (13, "ÉTÉ été Ünder")]
    docs = [
        (1, prose(1, 50) + " " + cut(0, 0, 10) + " " + prose(2, 50)),  # exactly one window
        (2, prose(1, 50) + " " + cut(0, 3, 12) + " " + prose(2, 50)),  # one word short
        (3, cut(0, 0, 30).upper().replace(" ", ", ")),  # other case and marks
        (4, cut(1, 0, 30) + " " + cut(1, 0, 30) + " x " + cut(3, 12, 28)),  # twice, and another
        (5, cut(4, 0, 15) + " different " + cut(4, 16, 30)),  # a changed word
        (6, "a short item, and a Short.Item"),
        (7, " ".join(["ha"] * 200)),
        (8, "été ünder ÉTÉ été Ünder été été ünder"),
        (9, cut(2, 0, 25)),
        (10, prose(77, 3_000) + " " + passage[5] + " " + prose(78, 3_000)),
        *[(20 + i, passage[3]) for i in range(30)],
    ]
    docs += [(i, t) for i, t, *_ in EDGES] + [(6, "a short item, and a Short.Item")]
    check_contamination(spark, docs, items)


def test_few_word_language_has_ties(spark):
    # With three words most runs repeat, so least hashes tie all the time.
    texts = [prose(i, 60, vocabulary=3) for i in range(40)]
    items = [(i, prose(i, 14, vocabulary=3)) for i in range(8)] + [(50, prose(9, 4, vocabulary=3))]
    check_contamination(spark, list(enumerate(texts)), items)


def test_every_window_and_its_copies_share_a_fingerprint(spark):
    text = prose(4, 400, vocabulary=12)
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string").select(
        "doc_id", decontaminate.words(F.col("text")).alias("_words")
    )
    for length in (1, 2, 3, 7, 10):
        found = sorted(tuple(r) for r in decontaminate.fingerprints(rows, ["doc_id"], [length]).collect())
        words = text.split()
        # Stretches cover all windows once, and equal windows have equal fingerprints.
        assert [r[2] for r in found] == [0] + [r[3] for r in found][:-1]
        assert found[-1][3] == len(words) - length + 1
        of = {}
        for _, _, first, until, least in found:
            for i in range(first, until):
                assert of.setdefault(tuple(words[i : i + length]), least) == least


def test_no_items_or_documents(spark):
    none = spark.createDataFrame([], ITEMS)
    got = contaminated(edges(spark), none)
    assert got == plain_contamination([(i, t) for i, t, *_ in EDGES], [])
    wordless = spark.createDataFrame([(1, "?!"), (2, None)], ITEMS)
    assert contaminated(edges(spark), wordless) == got
    assert contamination(empty(spark), spark.createDataFrame([(1, LONG)], ITEMS)).count() == 0


# ---- ranked search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_ranking(docs, items, depth=50):
    held = [(i, Counter(lowered(t) for t in TERM.findall(text or ""))) for i, text in docs]
    held = [(i, c) for i, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= {lowered(t) for t in TERM.findall(text or "")}
    out = []
    for item, terms in asked.items():
        scored = []
        for doc_id, c in held:
            m = 50 + (50 * sum(c.values()) * count) // length
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:depth], 1):
            out.append((item, rank, None if missing else doc_id, -score))
    return sorted(out, key=repr)


def ranked(docs, items, **options):
    return sorted((tuple(r) for r in rank_documents(docs, items, **options).collect()), key=repr)


def search_tables():
    docs = [(i, prose(i, 5 + i % 90, vocabulary=60)) for i in range(300)]
    docs += [(i, t) for i, t, *_ in EDGES] + [(400 + i, "same text for a tie") for i in range(70)]
    docs += [(None, "same text for a tie"), (500, "ÉTÉ; été-Ünder\x00x7 ÜNDER")]
    items = [(i, prose(1000 + i, 12, vocabulary=60)) for i in range(6)]
    items += [(6, "a TIE: for the Same, same text"), (7, None), (8, "!"), (9, "nowherefound"), (10, "ÜNDER x7")]
    items += [(6, "text two"), (None, "one two"), (None, "three")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"depth": 3}, {"block_terms": 20}])
def test_ranking_against_plain_python(spark, options):
    docs, items = search_tables()
    df = clashing(table(spark, [(i, t, None, None) for i, t in docs]).repartition(6))
    got = ranked(df, clashing(spark.createDataFrame(items, ITEMS)), **options)
    assert got == plain_ranking(docs, items, options.get("depth", 50))


def test_no_terms_or_documents(spark):
    docs, items = search_tables()
    asked = spark.createDataFrame(items, ITEMS)
    assert ranked(empty(spark), asked) == []
    assert ranked(edges(spark), spark.createDataFrame([], ITEMS)) == []
    assert ranked(edges(spark), spark.createDataFrame([(1, None)], ITEMS)) == []
    assert ranked(table(spark, [(1, None, None, None), (2, "?", None, None)]), asked) == []


def test_reading_ends_early_below_a_floor(monkeypatch):
    monkeypatch.setattr(lexical_search, "FIRST_READ", 4)
    rng = np.random.default_rng(3)
    tfs = [list(map(int, rng.integers(1, 30, 5))) for _ in range(2_000)]
    batch = pa.record_batch(
        {
            "doc_id": pa.array(range(2_000)),
            "n": pa.array([sum(t) for t in tfs]),
            "terms": pa.array([list(range(5))] * 2_000, pa.list_(pa.int32())),
            "tfs": pa.array(tfs, pa.list_(pa.int32())),
        }
    )
    shard = Shard(batch, np.array([700, 20, 300, 5, 90]), 2_000, sum(map(sum, tfs)))
    terms = np.arange(5)
    every, scores = shard.best(terms, 0, depth=2_000)
    assert len(every) == 2_000
    want = sorted(zip(-scores, every))[:10]
    rows, found = shard.best(terms, 0, depth=10)
    assert sorted(zip(-found, rows))[:10] == want
    reads = []
    sums = lexical_search._sums
    monkeypatch.setattr(lexical_search, "_sums", lambda p, v, n: reads.append(len(p)) or sums(p, v, n))
    rows, _ = shard.best(terms, 3 * int(scores.max()), depth=10)
    assert len(rows) == 0 and max(reads) < 10_000 // 2
    rows, found = shard.best(terms, int(scores.max()), depth=10)
    assert list(found) == [scores.max()] * len(found) and len(found)


def test_long_lists_of_impacts_add_up_exactly():
    values = np.full(10, 2**52, np.int64)
    assert lexical_search._sums(np.zeros(10, np.int64), values, 2).tolist() == [10 * 2**52, 0]
    assert centroids.STEPS[-1] == centroids.DIMENSIONS

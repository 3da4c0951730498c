"""Near-duplicates and the pipeline."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from llmdata import EDGES, edges, empty, prose, rows_of, table
from pyspark.sql import functions as F

import corpus_pipeline
from pulsetrail.llm import probminhash as near
from pulsetrail.llm import sentencepiece_scan as scan

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def plain_index(a, b):
    if not a or not b:
        return float(a == b)
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))


def plain_classes(texts):
    bags = {i: bag(t) for i, t in texts.items()}
    leader = {i: i for i in texts}

    def root(i):
        while leader[i] != i:
            i = leader[i]
        return i

    for a, b in combinations(texts, 2):
        if root(a) != root(b) and (bags[a].keys() & bags[b].keys() or bags[a] == bags[b]):
            if plain_index(bags[a], bags[b]) >= near.THRESHOLD:
                leader[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in texts}


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for place in rng.sample(range(len(words)), changes):
        words[place] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


def test_index_of_bags():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = Counter(dict(zip(rng.integers(0, 12, 9).tolist(), rng.integers(1, 5, 9).tolist())))
        b = Counter(dict(zip(rng.integers(0, 12, 9).tolist(), rng.integers(1, 5, 9).tolist())))
        x, y = ((np.array(sorted(c)), np.array([c[k] for k in sorted(c)])) for c in (a, b))
        assert near.probability_jaccard(*x, *y) == pytest.approx(plain_index(a, b))
        assert near.probability_jaccard(x[0], 3 * x[1], *y) == pytest.approx(plain_index(a, b))


def test_registers_estimate_the_index():
    base = prose(1, 400)
    texts = [base, edited(base, 10, 1), edited(base, 60, 2), base + " " + base, prose(2, 30), "few words"]
    value, weights, bounds, _ = near.shingles(pa.array(texts))
    found = near.signatures(value, weights, bounds, 4_000)
    for i, j in combinations(range(len(texts)), 2):
        want = plain_index(bag(texts[i]), bag(texts[j]))
        assert (found[i] == found[j]).mean() == pytest.approx(want, abs=0.04)


def test_classes_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    long = prose(77, 300)
    chain = [long]
    for i in range(6):  # each step is near the one before, the ends are not near
        chain.append(edited(chain[-1], 5, i))
    planted = [*chain, *(edited(long, 4, 100 + i) for i in range(30)), "a b", "a b", "a  b\n", "", None]
    extra = spark.createDataFrame(list(enumerate(planted, 10**6)), "doc_id long, text string")
    both = docs.unionByName(extra)
    want = plain_classes({r.doc_id: r.text for r in both.collect()})
    rows = near.near_duplicates(both).collect()
    assert {r.doc_id: r.class_id for r in rows} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in rows)


def test_buckets_of_several_classes(spark, monkeypatch):
    """Candidates that mostly fail: every bucket must still be searched to the end."""
    monkeypatch.setattr(near, "ROWS", 1)
    monkeypatch.setattr(near, "BANDS", 12)
    monkeypatch.setattr(near, "REGISTERS", 12)
    monkeypatch.setattr(near, "PAIRS", 2)
    monkeypatch.setattr(near, "PER_TASK", 3)
    shared = prose(5, 60)
    texts = {}
    for group in range(12):
        own = shared + " " + prose(50 + group, 90)
        texts.update({group * 10 + k: edited(own, 1, group * 10 + k) for k in range(4)})
    rows = near.near_duplicates(table(spark, [(i, t, None, None) for i, t in texts.items()])).collect()
    assert {r.doc_id: r.class_id for r in rows} == plain_classes(texts)


def test_buckets_with_equal_halves_lose_no_pair(spark):
    # Members 1 and 2 meet in band 1; in band 0 they have buckets that agree in 32 bits.
    one, two = (7 << 32) + 1, (7 << 32) + 2
    rows = [(one, 0, 1), (one, 0, 3), (two, 0, 2), (two, 0, 4), (9 << 32, 1, 1), (9 << 32, 1, 2)]
    buckets = spark.createDataFrame(rows, "band long, number int, member long")
    halves = {r.digest: r.halves for r in near._halves(buckets).collect()}
    assert halves[1][:3] == halves[2][:3] == [None, 9, None] and halves[3][:2] == [None, None]
    pair = spark.createDataFrame([(1, halves[1], halves[2], 3)], "number int, halves array<int>, halves2 array<int>, led int")
    assert pair.where(near._meets_first()).count() == 1
    pair = spark.createDataFrame([(2, halves[1], halves[2], 3)], "number int, halves array<int>, halves2 array<int>, led int")
    assert pair.where(near._meets_first()).count() == 0


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    nodes = {i for p in pairs for i in p}
    frame = spark.createDataFrame([(i, i) for i in nodes], "member long, label long")
    found = dict(rows_of(near.components(frame, spark.createDataFrame(pairs, "a long, b long")), "member", "label"))
    leader = {i: i for i in nodes}
    for _ in nodes:
        for a, b in pairs:
            leader[a] = leader[b] = min(leader[a], leader[b])
    assert found == leader


def test_near_edges(spark):
    rows = near.near_duplicates(edges(spark)).collect()
    assert len(rows) == len(EDGES)
    classes = defaultdict(list)
    for r in rows:
        classes[(r.class_id, r.class_size)].append(r.doc_id)
    got = sorted(sorted(map(str, c)) for c in classes.values())
    assert got == sorted([["1", "2", "3"], ["4", "5", "5"], ["6", "7"], ["8", "8"], ["9"], ["None"]])
    kept = near.drop_near_duplicates(edges(spark))
    assert kept.columns == edges(spark).columns
    assert rows_of(kept, "doc_id") == sorted([(1,), (4,), (6,), (8,), (8,), (9,), (None,)], key=repr)
    twins = table(spark, [(1, "one two", None, None)] * 3)
    assert near.drop_near_duplicates(twins).count() == 1
    assert near.near_duplicates(empty(spark)).count() == near.drop_near_duplicates(empty(spark)).count() == 0


# ---- pipeline


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = docs.where("length(text) between 800 and 3000").orderBy("doc_id").limit(3).collect()
    planted = [(10**6 + i, r.text, r.lang, r.source, r.n_chars) for i, r in enumerate(base)]
    planted += [(10**6 + 10 + i, edited(r.text, 1, i), r.lang, r.source, r.n_chars) for i, r in enumerate(base)]
    planted += [(10**6 + 20, None, "en", "src1", 0), (10**6 + 21, "12 34", "en", None, 5)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        out[name] = docs
        if name != "sentencepiece":
            assert docs.columns == before.columns
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in out.items()}
    assert {10**6 + 20, 10**6 + 21}.isdisjoint(ids["language_id"])
    assert len(ids["language_id"]) >= docs_count(spark) + 6 - 2
    assert set(ids["exact_dedup"]) < set(ids["language_id"])
    texts = [r.text for r in out["exact_dedup"].select("text").collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r.text for r in out["language_id"].select("text").collect()}
    classes = near.near_duplicates(out["exact_dedup"]).select("class_id").distinct().count()
    assert len(ids["near_dedup"]) == classes
    for i, r in enumerate(base):
        assert sum(d in ids["near_dedup"] for d in (r.doc_id, 10**6 + i, 10**6 + 10 + i)) <= 1
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and max(Counter(ids["mixing"]).values()) <= 3
    assert Counter(ids["sentencepiece"]) == Counter(ids["mixing"])
    decoded = scan.decode(out["sentencepiece"], corpus_pipeline.MODEL)
    assert rows_of(decoded, "doc_id", "text") == rows_of(out["mixing"], "doc_id", "text")


def docs_count(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_edges(spark):
    for docs in (edges(spark), empty(spark)):
        docs = docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert {"doc_id", "ids", "n_tokens"} == set(docs.columns)
        docs.count()

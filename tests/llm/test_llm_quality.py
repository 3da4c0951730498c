"""The quality query end to end, against plain Python and least squares."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llmdata import table
from pyspark.sql import functions as F

from pulsetrail.llm import quality
from pulsetrail.llm.queries import fold, op5_quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text)
    count = max(len(words), 1)
    of = {}
    for name, members in quality._CLASSES.items():
        of |= dict.fromkeys(members, name)
    counts = Counter(of[b] for w in words for b in w.encode())
    size = sum(counts.values())
    kinds = [0] * 6
    for w in words:
        here = Counter(of[b] for b in w.encode())
        letters = here["lower"] + here["upper"] + here["wide"]
        kinds[0] += of[w.encode()[0]] == "upper"
        kinds[1] += here["upper"] > 1 and here["lower"] == 0
        kinds[2] += letters == 0
        kinds[3] += len(w.encode()) > 20
        kinds[4] += len(w.encode()) <= 2
        kinds[5] += here["symbol"] + here["shout"] + here["bar"] > 0
    uses = Counter(words)
    entropy = -sum(n / count * math.log(n / count) for n in uses.values())
    lines = text.count("\n")
    return [
        math.log1p(len(text.encode())), math.log1p(len(words)), size / count, math.log1p(lines),
        *[math.sqrt(counts[name] / max(size, 1)) for name in quality._CLASSES],
        *[k / count for k in kinds],
        sum(a == b for a, b in zip(words, words[1:])) / count,
        len(uses) / count, max(uses.values(), default=0) / count, entropy, lines / count,
    ]


def plain_isotonic(values, weights):
    """The level at i: the largest over a <= i of the least over b >= i of the mean of a..b."""
    n = len(values)
    mean = lambda a, b: np.average(values[a : b + 1], weights=weights[a : b + 1])
    return np.array([max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def plain_scores(texts, labels, bins):
    """Score of every text; ``labels`` has one of them, or None."""
    x = np.array([plain_statistics(t) for t in texts])
    learned = [i for i, label in enumerate(labels) if label is not None]
    y = np.array([labels[i] for i in learned], float)
    mean, scale = x[learned].mean(axis=0), x[learned].std(axis=0)
    z = np.clip((x - mean) / np.where(scale > 1e-9, scale, 1.0), -10, 10)
    project, phases = quality._projection(quality.FEATURES, quality.SEED)
    waves = np.array([[math.cos(v) for v in row @ project + phases] for row in z]) * math.sqrt(2 / quality.FEATURES)
    design = np.column_stack([np.ones(len(x)), waves])
    # Ridge as least squares with one more row per penalised weight.
    size = design.shape[1]
    penalty = np.full(size, quality.RIDGE * len(y) / size + 1e-9)
    penalty[0] = 1e-9
    stacked = np.vstack([design[learned], np.diag(np.sqrt(penalty))])
    weights = np.linalg.lstsq(stacked, np.concatenate([y, np.zeros(size)]), rcond=None)[0]
    raw = design @ weights
    place = np.floor(np.clip((raw[learned] + 0.5) / 2, 0, 1) * bins)
    used = np.unique(place)
    n = np.array([(place == b).sum() for b in used])
    centre = np.array([raw[learned][place == b].mean() for b in used])
    level = plain_isotonic(np.array([y[place == b].mean() for b in used]), n)
    steps = [np.flatnonzero(np.isclose(level, v, atol=1e-12)) for v in sorted(set(np.round(level, 12)))]
    centres = [np.average(centre[s], weights=n[s]) for s in steps]
    levels = [level[s[0]] for s in steps]
    rank = 1 / (1 + np.exp(-8 * (np.clip(raw, -10, 10) - 0.5)))
    return (1 - quality.TIE_SHARE) * np.interp(raw, centres, levels) + quality.TIE_SHARE * rank


def test_statistics_against_plain_python():
    import pyarrow as pa

    texts = ["", " \n", "A word WORD, word word 12 (x) || é日本 \x01 a_b #tag! averyveryverylongwordindeed", "x\ny\n\nz z z"]
    got = quality.statistics(pa.array(texts))
    for row, text in zip(got, texts):
        assert row == pytest.approx(plain_statistics(text))


def test_query_against_plain_least_squares(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(fold(3) != 1)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.collect()
    want = plain_scores([r.text for r in rows], [known.get(r.doc_id) for r in rows], quality.BINS)
    assert len(known) > 40
    got = {r.doc_id: r for r in op5_quality(spark, SF).collect()}
    assert len(got) == len(rows)
    for row, score in zip(rows, want):
        assert got[row.doc_id].score == pytest.approx(score, abs=1e-6)
        assert got[row.doc_id].predicted == int(score >= 0.5) or abs(score - 0.5) < 1e-6


def test_held_out_of_a_null_id(spark):
    docs = table(spark, [(None, "text", None, None), (1, "text", None, None)])
    assert all(r[0] is not None for r in docs.select(F.coalesce(fold(3) == 1, F.lit(False))).collect())

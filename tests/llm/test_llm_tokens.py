"""Token files and SentencePiece against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llmdata import EDGES, LONG, edges, empty, prose, rows_of, table
from pyspark.sql import functions as F

from pulsetrail.llm import orc_tokens, wordbatch
from pulsetrail.llm import sentencepiece_scan as scan
from pulsetrail.llm.queries import TOKENIZERS
from pulsetrail.materialize import scratch_path

SF = "/root/testdata/sf0.001"
WORDS = f"{TOKENIZERS}/word_bpe_49k.json"
MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"

ODD = [
    "It's  he'll THEY'RE o'clock, don't!? ... a,b;c:d e.f",
    "ÀÉÎ ÿŸß straße ﬁ ½ ² é ạ̀ ẛ̣",
    "日本語テキスト 한국어 עברית ΑΣ Σ <|endoftext|>x <|startoftext|> a<|endoftext|>.",
    "tab\tnew\nline\x0bvt\x0cff\rcr \x1c\x85   end  ",
    "\x00\x01 ﻿😀😀 👩‍👩‍👧 1234 x1y2 ___ --- !!! ,. .,",
    "a" * 5000 + " " + "." * 3000,
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---- ORC


def test_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    path = scratch_path(spark, "test-orc")
    orc_tokens.write_token_ids(docs, path, WORDS)
    start, want = 0, []
    for row in docs.orderBy("doc_id").collect():
        ids = library.encode(row.text, add_special_tokens=False).ids + [1]
        want.append((row.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = orc_tokens.token_index(spark, path)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_files_are_ranges_in_order(spark):
    docs = table(spark, [(i * 7919 % 5000, prose(i, 6), None, None) for i in range(3000)]).repartition(6)
    path = scratch_path(spark, "test-orc")
    orc_tokens.write_token_ids(docs, path, WORDS)
    rows = orc_tokens.read_token_ids(spark, path).select("part", "row", "doc_id").collect()
    ids = [r.doc_id for r in sorted(rows)]
    assert ids == sorted(ids) and len(ids) == 3000
    wanted = ids[::500]
    found = orc_tokens.lookup(spark, path, wanted)
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == wanted
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_a_full_cache_changes_nothing(monkeypatch):
    texts = pa.array([prose(1, 300), *ODD, prose(2, 300)])
    whole = orc_tokens.Encoder(WORDS).encode_texts(wordbatch.split_ascii(texts), 1)
    monkeypatch.setattr(orc_tokens, "CACHE_WORDS", 5)
    small = orc_tokens.Encoder(WORDS)
    for _ in range(2):
        got = small.encode_texts(wordbatch.split_ascii(texts), 1)
        assert all((a == b).all() for a, b in zip(whole, got)) and len(small.cache) <= 5


def test_orc_edges(spark):
    path = scratch_path(spark, "test-orc")
    orc_tokens.write_token_ids(edges(spark), path, WORDS)
    rows = sorted(tuple(r) for r in orc_tokens.token_index(spark, path).select("start", "n_tokens", "doc_id", "ids_crc32").collect())
    assert len(rows) == len(EDGES) and rows[0][2] is None
    assert [r[0] for r in rows] == [sum(x[1] for x in rows[:i]) for i in range(len(rows))]
    assert {r[1:] for r in rows if r[2] in (1, 2, 3)} == {(1, i, crc([1])) for i in (1, 2, 3)}
    nothing = scratch_path(spark, "test-orc")
    orc_tokens.write_token_ids(empty(spark), nothing, WORDS)
    assert orc_tokens.token_index(spark, nothing).count() == 0


# ---- word batches


def test_slices_cover_every_row(monkeypatch):
    monkeypatch.setattr(wordbatch, "BATCH_CHARS", 10)
    texts = ["", None, "abcdefghijklmnop", "a b", "", "c" * 9, "d" * 11, None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(wordbatch.slices(batch))
    assert [t for p in parts for t in p["text"].to_pylist()] == texts and len(parts) > 2
    for part in parts:
        words = wordbatch.split_ascii(part["text"])
        spelled = words.distinct.to_pylist()
        for i, text in enumerate(part["text"].to_pylist()):
            codes = words.codes[words.starts[i] : words.starts[i + 1]]
            assert [spelled[c] for c in codes] == (text or "").split()


# ---- SentencePiece


@pytest.fixture(scope="module")
def pieces():
    return scan.Pieces(MODEL)


@pytest.fixture(scope="module")
def library():
    """The library's unigram encoder over the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:  # the library adds in single precision
        if piece.score < -1e8:
            piece.score = -100_000
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def solve(pieces, texts):
    split = scan._word_split(scan._spaced(pa.array(texts, pa.string())))
    ids, at = pieces.encode_words(split)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_pieces_equal_the_library(spark, pieces, library):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["", "  two  leading", "trailing  ", "x", ODD[0], ODD[3]]
    assert solve(pieces, texts) == library.encode(texts, num_threads=1)


def test_chunks_give_the_whole_path(pieces):
    rng = random.Random(3)
    alphabet = ["th", "e", " ", " ", "  ", "ing", "\n", "日", "本", "é", "x" * 9, "0x", "..."]
    for trial in range(40):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 120)))
        marked = scan.MARK + text.replace(" ", scan.MARK)
        (whole,) = solve(pieces, [text])
        size = rng.randint(pieces.longest, 50)
        parts = [marked[i : i + size] for i in range(0, len(marked), size)]
        after = [p[: pieces.longest - 1] for p in [*parts[1:], ""]]
        chunks = [scan.Chunk(p, a) for p, a in zip(parts, after)]
        matrices = [c.matrix(pieces, pieces.longest) for c in chunks]
        states = scan.resolve(matrices, 0, 0)
        found = b"".join(c.ids(pieces, i, j) for c, (i, j) in zip(chunks, states))
        got = np.frombuffer(found, np.int32).tolist()
        assert sum(pieces.id_score[got]) == sum(pieces.id_score[whole])
        assert pieces.decode(np.array(got), np.array([0, len(got)])) == [text.encode()]


def test_known_words_are_bounded_by_size(monkeypatch):
    monkeypatch.setattr(scan, "CACHE_CHARS", 1000, raising=False)
    pieces = scan.Pieces(MODEL)
    words = [scan.MARK + "日本x" * 50 + str(i) for i in range(30)]
    want = [pieces.word(w) for w in words]
    for _ in range(2):
        assert pieces.solve(words) == want
        held = sum(len(w) + len(ids) // 4 for w, ids in pieces.cache.items())
        assert 0 < held <= 1000


def test_chunks_are_worked_on_in_parts(pieces, monkeypatch):
    monkeypatch.setattr(scan, "PART_CHARS", 40, raising=False)
    parts = [scan.MARK + f"part{scan.MARK}{i}{scan.MARK}of a text" for i in range(9)]
    zeros = pa.array([0] * 9, pa.int32())
    columns = [pa.array(["k"] * 9), pa.array(range(9)), pa.array(parts), pa.array([""] * 9), zeros, zeros]
    batch = pa.RecordBatch.from_arrays(columns, names=["key", "part", "text", "ahead", "entry", "leave"])
    whole = [np.frombuffer(scan.Chunk(p, "").ids(pieces, 0, 0), np.int32).tolist() for p in parts]
    ids = list(scan._chunk_ids(MODEL)(iter([batch])))
    assert [x for b in ids for x in b["ids"].to_pylist()] == whole and len(ids) > 2
    cells = list(scan._matrix_rows(MODEL)(iter([batch])))
    assert [x for b in cells for x in b["part"].to_pylist()] == list(range(9)) and len(cells) > 2


def test_product_is_associative(pieces):
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random((9, 9)) < 0.5, -np.inf, -rng.integers(0, 99, (9, 9)).astype(float)) for _ in range(3))
    left, right = scan.combine(scan.combine(a, b), c), scan.combine(a, scan.combine(b, c))
    assert (left == right).all()


@pytest.mark.parametrize("fan", [2, 64])
def test_giant_texts_across_levels(spark, pieces, monkeypatch, fan):
    monkeypatch.setattr(scan, "FAN", fan)
    texts = [prose(i, 60) + " ñ日本 " + "z" * 70 + "  " + prose(9, 40) for i in range(3)]
    docs = table(spark, [(i, t, None, None) for i, t in enumerate([*texts, texts[0], "short"])])
    got = {r.doc_id: r.ids for r in scan.encode(docs, MODEL, chunk_chars=37).collect()}
    want = solve(pieces, [*texts, texts[0], "short"])
    for i, ids in enumerate(want):  # a run of one letter has several best paths
        assert sum(pieces.id_score[got[i]]) == sum(pieces.id_score[ids])
        assert pieces.decode(np.array(got[i]), np.array([0, len(got[i])])) == [[*texts, texts[0], "short"][i].encode()]
    assert got[3] == got[0] and got[4] == want[4]


def test_round_trip_and_edges(spark):
    docs = edges(spark)
    encoded = scan.encode(docs, MODEL)
    assert encoded.count() == len(EDGES)
    decoded = scan.decode(encoded, MODEL)
    want = sorted([(d, t or "") for d, t, *_ in EDGES], key=repr)
    assert rows_of(decoded, "doc_id", "text") == want
    digests = rows_of(scan.digests(encoded, MODEL), "doc_id", "decoded_sha256")
    texts = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    assert digests == rows_of(texts, "doc_id", "h")
    assert len(LONG) > scan.CHUNK_CHARS
    assert scan.encode(empty(spark), MODEL).count() == 0


def test_mark_in_a_text_reads_as_a_space(spark):
    docs = table(spark, [(1, "a▁b", None, None), (2, "a b", None, None)])
    rows = scan.encode(docs, MODEL).collect()
    assert rows[0].ids == rows[1].ids

"""SentencePiece encoding and decoding as a max-plus scan.

The best segmentation of a text has the largest sum of piece scores, so encoding is a
shortest-path problem over the places in the text, in the max-plus semiring. A piece has
the word mark only at its start or is a run of marks (checked when the model is read), so
no piece spans the place between another character and a mark. A word is a run of marks
and what follows: the best path of a text is those of its words on end, and each distinct
word of a batch is solved once.

A giant text is cut into chunks of ``chunk_chars`` at fixed places, with no regard to
words. At a cut the only state is how many characters of the next chunk the piece that
spans the cut takes, less than the length of the longest piece. A chunk gives a matrix of
best scores from each state at its left end to each at its right end. Matrices combine
associatively, ``FAN`` neighbours at a time, up to one block per text; on the way down
the two states of a block fix those of its members, and then the pieces of each chunk are
read off independently of the other chunks.

The scores are those of the model file, taken as unigram scores; sums are whole numbers,
exact in doubles. Equal sums: the longer last piece wins inside a chunk, the smaller
state at a cut. A character that no piece covers costs ``UNKNOWN_PENALTY`` more than the
worst ordinary piece and becomes its UTF-8 byte pieces.

Defined cases: a null text is the empty text, without ids; a space in front is added
before encoding and dropped after decoding; the word mark U+2581 itself decodes to a
space; equal giant texts are solved once; ids may be null or repeat, each row gets its
result; the empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.wordbatch import Words, map_texts, per_slice, ragged_take, split_on
from pulsetrail.materialize import materialize

MARK = "▁"
_MARKS = ".,!?;:)]}\"'|&%$#*"
UNKNOWN_PENALTY = 10
CHUNK_CHARS = 32_768
FAN = 64
CACHE_WORDS = 200_000
# Characters and ids that the known words hold, at most: without spaces a word has up to a chunk.
CACHE_CHARS = 4_000_000
# Bytes of chunks that a worker holds as Python's strings and lists at once.
PART_CHARS = 2_000_000
IDS = "doc_id long, ids array<int>"


class Pieces:
    """Scores and ids of the model file, and best paths of single words."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        ordinary = [(i, p) for i, p in enumerate(model.pieces) if p.type == 1]
        self.score = {p.piece: float(p.score) for _, p in ordinary}
        self.id = {p.piece: i for i, p in ordinary}
        self.longest = max(map(len, self.score))
        # Every start of a piece, with the score of those that are pieces.
        self.starts = {p[:n]: None for p in self.score for n in range(1, len(p))} | self.score
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.unknown = min(s for p, s in self.score.items() if p.strip(MARK)) - UNKNOWN_PENALTY
        odd = [p for p in self.score if MARK in p[1:] and p.strip(MARK)]
        if odd or len(self.byte_id) != 256:
            raise ValueError(f"pieces must begin words and cover all bytes: {odd[:3]}")
        # What each id decodes to, with the mark as a space.
        texts = [b""] * len(model.pieces)
        for piece, i in self.id.items():
            texts[i] = piece.replace(MARK, " ").encode()
        for byte, i in self.byte_id.items():
            texts[i] = bytes([byte])
        self.texts = pa.array(texts, pa.large_binary())
        self.id_score = np.zeros(len(texts))
        for piece, i in self.id.items():
            self.id_score[i] = self.score[piece]
        self.path_score = self.id_score.copy()
        for byte, i in self.byte_id.items():
            if byte < 0x80 or byte >= 0xC0:
                self.path_score[i] = self.unknown
        # Closing marks that no piece has behind a letter: where they follow one, the best
        # path of a word is that of what stands before them and that of the marks.
        behind = {b for p in self.score for a, b in zip(p, p[1:]) if a.isalpha()}
        self.marks = "".join(sorted(set(_MARKS) - behind))
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def path(self, text: str, start: int, stop: int, reach: int | None = None) -> tuple[float, list[int]]:
        """Best score and ids of ``text[start:stop]``; -inf if a single piece must not end there.

        With ``reach`` less than ``stop`` the last piece must begin before ``reach``.
        """
        reach = stop if reach is None else reach
        best, back = {start: 0.0}, {}
        starts, longest, unknown = self.starts, self.longest, self.unknown
        for i in range(start, reach):
            here = best.get(i)
            if here is None:
                continue
            single = False
            for j in range(i + 1, min(i + longest, stop) + 1):
                value = starts.get(text[i:j], False)
                if value is False:
                    break
                if value is None or reach < j < stop:
                    continue
                single = single or j == i + 1
                if j not in best or here + value > best[j]:
                    best[j], back[j] = here + value, i
            if not single and (i + 1 not in best or here + unknown > best[i + 1]) and not reach < i + 1 < stop:
                best[i + 1], back[i + 1] = here + unknown, i
        if stop not in best:
            return -np.inf, []
        ids: list[list[int]] = []
        j = stop
        while j > start:
            piece = text[back[j] : j]
            known = self.id.get(piece)
            ids.append([known] if known is not None else [self.byte_id[b] for b in piece.encode()])
            j = back[j]
        return best[stop], [i for part in reversed(ids) for i in part]

    def word(self, text: str) -> bytes:
        """Ids of the best path of a word; the same rule as ``path``."""
        size, starts, longest, unknown = len(text), self.starts, self.longest, self.unknown
        best, back = [-np.inf] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        for i in range(size):
            here = best[i]
            single = False
            for j in range(i + 1, min(i + longest, size) + 1):
                value = starts.get(text[i:j], False)
                if value is False:
                    break
                if value is None:
                    continue
                if j == i + 1:
                    single = True
                if here + value > best[j]:
                    best[j] = here + value
                    back[j] = i
            if not single and here + unknown > best[i + 1]:
                best[i + 1] = here + unknown
                back[i + 1] = i
        ids, j = [], size
        while j:
            i = back[j]
            known = self.id.get(text[i:j])
            if known is None:
                ids.extend(self.byte_id[b] for b in reversed(text[i:j].encode()))
            else:
                ids.append(known)
            j = i
        ids.reverse()
        return array("i", ids).tobytes()

    def solve(self, words: list[str]) -> list[bytes]:
        """Ids (as bytes) of each word."""
        known, out = self.cache, []
        for word in words:
            found = known.get(word)
            if found is None:
                found = self.word(word)
                size = len(word) + len(found) // 4
                if len(known) < CACHE_WORDS and self.cached + size <= CACHE_CHARS:
                    known[word] = found
                    self.cached += size
            out.append(found)
        return out

    def score_of(self, ids: bytes) -> float:
        """Sum of scores, where the first byte of an unknown character has its cost."""
        return float(self.path_score[np.frombuffer(ids, np.int32)].sum())

    def encode_words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and offsets of the texts."""
        marked = pc.binary_join_element_wise(MARK, pc.replace_substring(words.distinct, " ", MARK), "")
        cores = pc.utf8_rtrim(marked, self.marks)
        cores = pc.if_else(pc.match_substring_regex(cores, r"\p{L}$"), cores, marked)
        cut = pc.less(pc.utf8_length(cores), pc.utf8_length(marked)).to_numpy(zero_copy_only=False)
        cores = cores.dictionary_encode()
        class_ = "".join(map(re.escape, self.marks))
        rest = pc.replace_substring_regex(marked.filter(pa.array(cut)), f"(?s)^.*[^{class_}]", "").dictionary_encode()
        solved = self.solve(cores.dictionary.to_pylist()) + self.solve(rest.dictionary.to_pylist()) + [b""]
        values = np.frombuffer(b"".join(solved), np.int32)
        lengths = np.fromiter(map(len, solved), np.int64, len(solved)) // 4
        del solved
        parts = np.full((len(marked), 2), len(lengths) - 1)
        parts[:, 0] = cores.indices.to_numpy()
        parts[cut, 1] = rest.indices.to_numpy() + len(cores.dictionary)
        per_word = ragged_take(values, lengths, parts.ravel())
        lengths = lengths[parts].sum(axis=1)
        ids = ragged_take(per_word, lengths, words.codes)
        return ids, np.concatenate([[0], np.cumsum(lengths[words.codes])])[words.starts]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """UTF-8 of each text, without the space in front."""
        spelled = self.texts.take(pa.array(ids))
        at = np.frombuffer(spelled.buffers()[1], np.int64)[: len(ids) + 1][offsets]
        data = memoryview(spelled.buffers()[2] or b"")
        return [bytes(data[a + 1 : b]) if b > a else b"" for a, b in zip(at.tolist(), at[1:].tolist())]


@lru_cache(maxsize=2)
def _pieces(model: str) -> Pieces:
    """One per Python worker, with its cache."""
    return Pieces(model)


def _spaced(texts: pa.Array) -> pa.Array:
    """A text with the mark itself reads as one with a space."""
    return pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def _word_split(texts: pa.Array) -> Words:
    """Words that follow a space; the empty text has none, whatever a split returns."""
    # The first space of a run ends a word; the marks free for it were replaced before.
    parted = pc.replace_substring(texts, " ", MARK)
    runs = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " "))
    if pc.any(runs).as_py():
        first = pc.replace_substring_regex(texts.filter(runs), "([^ ]) ", f"\\1{MARK}")
        parted = pc.replace_with_mask(parted, runs, first)
    words = split_on(parted, MARK)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if empty.any():
        counts = np.diff(words.starts)
        keep = np.repeat(~empty, counts)
        return Words(words.codes[keep], words.distinct, np.concatenate([[0], np.cumsum(counts * ~empty)]))
    return words


def _encode_plain(model: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = _pieces(model).encode_words(_word_split(_spaced(batch["text"])))
        return pa.RecordBatch.from_arrays([batch["doc_id"], _lists(ids, offsets)], names=["doc_id", "ids"])

    return work


# ---- giant texts ------------------------------------------------------------------


class Chunk:
    """A chunk (spaces as marks), the characters after it, and where its words begin."""

    def __init__(self, text: str, ahead: str):
        self.size = len(text)
        self.text = text + ahead
        cuts = [m.start() + 1 for m in re.finditer(f"[^{MARK}]{MARK}", text)]
        self.first, self.last = (cuts[0], cuts[-1]) if cuts else (None, None)

    def middle(self, pieces: Pieces) -> list[bytes]:
        if self.first == self.last:
            return []
        part = self.text[self.first : self.last]
        return pieces.solve(re.findall(f"{MARK}+[^{MARK}]+", part))

    def matrix(self, pieces: Pieces, states: int) -> np.ndarray:
        """Best score from entry state i to exit state j; -inf where there is no path."""
        out = np.full((states, states), -np.inf)
        exits = range(min(states, len(self.text) - self.size + 1))
        if self.first is None:
            for i in range(min(states, self.size + 1)):
                for j in exits:
                    out[i, j] = self._leap(pieces, i, j)
            for i in range(self.size + 1, states):  # a chunk shorter than a piece
                if i - self.size < states:
                    out[i, i - self.size] = 0.0
            return out
        middle = pieces.score_of(b"".join(self.middle(pieces)))
        left = [pieces.path(self.text, i, self.first)[0] if i <= self.first else -np.inf for i in range(states)]
        right = [self._leap(pieces, self.last, j) for j in exits]
        out[:, : len(right)] = np.add.outer(np.array(left), np.array(right)) + middle
        return out

    def _leap(self, pieces: Pieces, start: int, beyond: int) -> float:
        if start == self.size:
            return 0.0 if beyond == 0 else -np.inf
        return pieces.path(self.text, start, self.size + beyond, self.size)[0]

    def ids(self, pieces: Pieces, entry: int, leave: int) -> bytes:
        stop = self.size + leave
        if entry >= self.size:
            return b""
        if self.first is None:
            return np.array(pieces.path(self.text, entry, stop, self.size)[1], np.int32).tobytes()
        left = pieces.path(self.text, entry, self.first)[1]
        right = pieces.path(self.text, self.last, stop, self.size)[1]
        middle = b"".join(self.middle(pieces))
        return np.array(left, np.int32).tobytes() + middle + np.array(right, np.int32).tobytes()


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of matrices, or of a row vector and a matrix.

    Only differences matter to a best path: the largest cell is made 0, so that sums stay
    small and exact however long the text is.
    """
    out = np.max(a[..., :, None] + b[None, :, :] if a.ndim == 2 else a[:, None] + b, axis=-2)
    return out - out.max()


def resolve(matrices: list[np.ndarray], enter: int, leave: int) -> list[tuple[int, int]]:
    """Entry and exit state of each of some neighbours on a best path between two states."""
    start = np.where(np.arange(len(matrices[0])) == enter, 0.0, -np.inf)
    before = [start]
    for m in matrices[:-1]:
        before.append(combine(before[-1], m))
    out = []
    for m, v in zip(reversed(matrices), reversed(before)):
        entry = int(np.argmax(v + m[:, leave]))
        out.append((entry, leave))
        leave = entry
    return out[::-1]


def _chunks(giants: DataFrame, chunk_chars: int, longest: int) -> DataFrame:
    """key, part, text, ahead. One pass over a text cuts it, however long it is."""
    marked = F.concat(F.lit(MARK), F.translate("text", " ", MARK))
    cut = F.regexp_extract_all(marked, F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0))
    pair = F.arrays_zip(
        F.col("cut").alias("text"),
        F.concat(
            F.transform(F.slice("cut", F.lit(2), F.size("cut")), lambda c: F.substring(c, 1, longest - 1)),
            F.array(F.lit("")),
        ).alias("ahead"),
    )
    cuts = giants.select("key", cut.alias("cut"))
    return cuts.select("key", F.posexplode(pair).alias("part", "c")).select(
        "key", F.col("part").cast("long").alias("part"), "c.text", "c.ahead"
    )


def _matrix_rows(model: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = _pieces(model)
        rows = [
            Chunk(t, a).matrix(pieces, pieces.longest).ravel()
            for t, a in zip(batch["text"].to_pylist(), batch["ahead"].to_pylist())
        ]
        cells = pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch["key"], batch["part"], cells], names=["key", "part", "m"])

    return per_slice(work, part_chars=PART_CHARS)


def _square(cells) -> np.ndarray:
    cells = np.asarray(cells, dtype=float)
    return cells.reshape(int(len(cells) ** 0.5), -1)


def _product(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part")
    total = _square(group["m"].iloc[0])
    for cells in group["m"].iloc[1:]:
        total = combine(total, _square(cells))
    return pd.DataFrame(
        {"key": [group["key"].iloc[0]], "part": [group["block"].iloc[0]], "m": [total.ravel().tolist()]}
    )


def _place(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part")
    matrices = [_square(m) for m in group["m"]]
    found = resolve(matrices, int(group["entry"].iloc[0]), int(group["leave"].iloc[0]))
    entry, leave = zip(*found)
    return pd.DataFrame({"key": group["key"].to_numpy(), "part": group["part"].to_numpy(), "entry": entry, "leave": leave})


_PLACED = "key string, part long, entry int, leave int"


def _scan(chunks: DataFrame, model: str) -> DataFrame:
    """Entry and exit state of every chunk: up the levels by products, down by states."""
    matrix = "key string, part long, m array<double>"
    levels = [materialize(chunks.mapInArrow(_matrix_rows(model), matrix))]
    block = F.expr(f"part div {FAN}")
    while levels[-1].where(F.col("part") >= FAN).limit(1).count():
        grouped = levels[-1].withColumn("block", block).groupBy("key", "block")
        levels.append(materialize(grouped.applyInPandas(_product, matrix)))
    top = levels.pop()
    first = top.withColumns({"entry": F.lit(0), "leave": F.lit(0)})
    placed = materialize(first.groupBy("key").applyInPandas(_place, _PLACED))
    while levels:
        above = placed.select("key", F.col("part").alias("block"), "entry", "leave")
        below = levels.pop().withColumn("block", block).join(above, ["key", "block"])
        placed = materialize(below.groupBy("key", "block").applyInPandas(_place, _PLACED))
    return placed


def _chunk_ids(model: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = _pieces(model)
        columns = [batch[c].to_pylist() for c in ("text", "ahead", "entry", "leave")]
        ids = [np.frombuffer(Chunk(t, a).ids(pieces, e, x), np.int32) for t, a, e, x in zip(*columns)]
        lists = pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch["key"], batch["part"], lists], names=["key", "part", "ids"])

    return per_slice(work, part_chars=PART_CHARS)


def _encode_giants(giants: DataFrame, model: str, chunk_chars: int) -> DataFrame:
    """key, ids of distinct giant texts."""
    chunks = materialize(_chunks(giants, chunk_chars, _pieces(model).longest))
    placed = _scan(chunks, model)
    ids = chunks.join(placed, ["key", "part"]).mapInArrow(_chunk_ids(model), "key string, part long, ids array<int>")
    parts = F.array_sort(F.collect_list(F.struct("part", "ids")))
    # As long as the text itself, which is one row too.
    return ids.groupBy("key").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def encode(docs: DataFrame, model: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids. ``model`` must exist on all executors."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    giant = F.length("text") > chunk_chars
    plain = map_texts(rows.where(~giant), _encode_plain(model), IDS)
    large = rows.where(giant).select("doc_id", F.sha2("text", 256).alias("key"), "text")
    distinct = large.dropDuplicates(["key"]).select(
        "key", F.translate("text", MARK, " ").alias("text")
    )
    found = _encode_giants(distinct, model, chunk_chars)
    return plain.unionByName(large.select("doc_id", "key").join(found, "key").select("doc_id", "ids"))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows with ``doc_id`` and ``ids``; null ids give the empty text."""

    def run(batches):
        for batch in batches:
            ids, offsets = _flat(batch["ids"])
            texts = [t.decode("utf-8", "replace") for t in _pieces(model).decode(ids, offsets)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    return ids, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def digests(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, score, decoded_sha256 of encoded rows.

    ``score`` is the sum of the piece scores; bytes of unknown characters count 0.
    """

    def run(batches):
        pieces = _pieces(model)
        for batch in batches:
            ids, offsets = _flat(batch["ids"])
            total = np.concatenate([[0.0], np.cumsum(pieces.id_score[ids])])
            raw = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
            edges = (offsets * 4).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(np.diff(offsets)),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(edges, edges[1:])], pa.int64()),
                    pa.array(total[offsets[1:]] - total[offsets[:-1]]),
                    pa.array([hashlib.sha256(t).hexdigest() for t in pieces.decode(ids, offsets)]),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "score", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_crc32 long, score double, decoded_sha256 string"
    return encoded.mapInArrow(run, schema)

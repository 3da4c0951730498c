"""Character n-grams of words as 64-bit hashes in numpy arrays.

A word is a start symbol, its characters and an end symbol; contexts do not reach past
the start of the word, so a word's probability does not depend on its neighbours and is
computed once per distinct word of a batch.
"""

from __future__ import annotations

import numpy as np

# Lone surrogates: they cannot occur in a valid text.
START, END = "\ud800", "\ud801"
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Symbols of many words on end, and hashes of what ends at each of them."""

    def __init__(self, words: list[str]):
        joined = START + (END + START).join(words) + END if words else ""
        # Symbols are 1 more than code points: 0 is no symbol.
        self.symbols = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64) + 1
        starts = self.symbols == ord(START) + 1
        self.word = np.cumsum(starts) - 1
        at = np.arange(len(self.symbols))
        #: Symbols of the word before each one.
        self.depth = at - np.maximum.accumulate(np.where(starts, at, 0)) if len(at) else at
        #: Places that a model predicts: all but the starts.
        self.predicted = np.flatnonzero(~starts)

    def before(self, k: int) -> np.ndarray:
        """The symbol k places before each predicted one; 0 beyond the word."""
        at = self.predicted - k
        return np.where(self.depth[self.predicted] >= k, self.symbols[np.maximum(at, 0)], 0)

    def columns(self, order: int) -> list[np.ndarray]:
        """Symbols of the longest gram at each predicted place, the predicted one last."""
        return [self.before(k) for k in range(order - 1, -1, -1)]


def hash_columns(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of the symbols in the columns, read right to left; leading zeros add nothing."""
    total, power = np.zeros(len(columns[0]), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for column in reversed(columns):
            total += column.astype(np.uint64) * power
            power *= _BASE
    return total


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in sorted keys, or ``len(keys)`` where it is missing."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.searchsorted(keys, wanted)
    return np.where(keys[np.minimum(at, len(keys) - 1)] == wanted, at, len(keys))


def distinct_rows(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of the columns with the sums of their counts."""
    key = hash_columns(columns)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    sums = np.bincount(inverse, weights=counts, minlength=len(first))
    return [c[first] for c in columns], sums.astype(np.int64)

"""Words, lines and their 64-bit hashes for a whole batch of texts, as flat numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
#: Multipliers by position; a hash stays the same on every machine.
_BY_POSITION = _RNG.integers(1, 2**63, 4096, dtype=np.uint64) * _U(2) + _U(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def run_hash(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One hash for each run of values; the runs stand one after another, none is empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.arange(len(values)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        h = np.add.reduceat((values.astype(np.uint64) + _U(1)) * (_BY_POSITION[at & 4095] + (at >> 12).astype(np.uint64) * _U(2)), starts)
        return mixed(h + lengths.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k values in a row; windows may cross documents, callers mask those."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out += words[j : j + n] * _BY_POSITION[j]
        return mixed(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w values in a row, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = w - have
    return np.minimum(x[: len(x) - rest], x[rest:])[:n] if rest else x[:n]


class Grid:
    """Words of a batch of texts; null texts have none.

    data: the bytes of all texts; text_at: where each begins (one more than texts).
    start, length: of each word in data; first: each text's first word (one more than texts); doc: each word's text.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        if pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.string())
        if texts.null_count:
            texts = texts.fill_null("")
        n = len(texts)
        at = np.frombuffer(texts.buffers()[1], np.int32, n + 1, texts.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
        body = texts.buffers()[2] if n else None
        raw = np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        self.text_at = at - at[0]
        self.data = _LOWER[raw] if lower else raw
        inside = ~_IS_SPACE[self.data]
        self.inside = inside
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = self.text_at[:-1]
        edge = edge[edge < len(raw)]
        begins[edge] = inside[edge]
        self.start = np.flatnonzero(begins)
        used = np.concatenate(([0], np.cumsum(inside)))  # bytes of words before each byte
        self._squeezed_at = used[self.start]
        self.length = np.diff(np.append(self._squeezed_at, used[-1]))
        self.first = np.searchsorted(self.start, self.text_at)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        self.n = n

    def hashes(self) -> np.ndarray:
        return run_hash(self.data[self.inside], self._squeezed_at, self.length)

    def same_doc(self, k: int) -> np.ndarray:
        """Whether the k words from each on are of one text."""
        n = max(0, len(self.doc) - k + 1)
        return self.doc[:n] == self.doc[k - 1 : k - 1 + n]

    def per_doc(self, flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of flags between at[i] and at[i + 1]."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[at[1:]] - total[at[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lines with a word: text, hash of the raw line, first word, number of words."""
        if not len(self.start):
            z = np.zeros(0, np.int64)
            return z, z.astype(np.uint64), z, z
        starts = np.unique(np.concatenate((self.text_at[:-1], np.flatnonzero(self.data == 10) + 1)))
        starts = starts[starts < len(self.data)]
        ends = np.append(starts[1:], len(self.data))
        # the \n that ends a line is no part of it
        tail = self.data[ends - 1] == 10
        keep = np.ones(len(self.data), bool)
        keep[(ends - 1)[tail]] = False
        size = ends - starts - tail
        some = size > 0
        raw = np.zeros(len(starts), np.uint64)
        at = np.concatenate(([0], np.cumsum(size)))[:-1]
        raw[some] = run_hash(self.data[keep], at[some], size[some])
        first = np.searchsorted(self.start, starts)
        count = np.diff(np.append(first, len(self.start)))
        with_word = count > 0
        return self.doc[first[with_word]], raw[with_word], first[with_word], count[with_word]

"""An FM-index over word sequences: suffix array by prefix doubling, wavelet matrix of bit-packed planes, backward search for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit plane for each bit of a symbol, with popcounts summed up to every 64 bits."""

    def __init__(self, x: np.ndarray):
        self.depth = max(1, int(x.max()).bit_length()) if len(x) else 1
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (x >> level & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate((bit, np.zeros(64 + -len(bit) % 64, np.uint8))), bitorder="little").view(np.uint64)
            upto = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            self.planes.append((packed, upto, int(len(bit) - bit.sum())))
            x = np.concatenate((x[bit == 0], x[bit == 1]))

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands before each end."""
        base, places = np.zeros(len(symbol), np.int64), list(ends)
        for level, (packed, upto, zeros) in zip(range(self.depth - 1, -1, -1), self.planes, strict=True):
            one = (symbol >> level & 1).astype(bool)
            moved = []
            for i in (base, *places):
                word = i >> 6
                ones = upto[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
                moved.append(np.where(one, zeros + ones, i - ones))
            base, *places = moved
        return [p - base for p in places]


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of ranks, by prefix doubling."""
    n, k, rank = len(rank), 1, rank.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if n < 2 or fresh[-1] == n - 1:
            return order
        k *= 2


class FmIndex:
    """Sequences of symbols from 1 on, one after another; each ends with its own separator, so that no match crosses from one to the next."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        n, m = len(symbols), len(lengths)
        at = np.cumsum(lengths + 1) - 1  # of the separators
        text = np.zeros(n + m, np.int64)
        inside = np.ones(n + m, bool)
        inside[at] = False
        text[inside] = symbols
        first = np.empty(n + m, np.int64)
        first[inside] = symbols + m
        first[at] = np.arange(m)
        order = suffix_array(np.unique(first, return_inverse=True)[1])
        self.text, self.inside = text, inside
        self.bwt = WaveletMatrix(text[order - 1])  # before the first stands the last separator
        count = np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 2)
        self.before = m + np.cumsum(count) - count

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with that symbol put before them."""
        a, b = self.bwt.rank(symbol, lo, hi)
        return self.before[symbol] + a, self.before[symbol] + b

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> np.ndarray:
        """For each end (exclusive) in a text of symbols: length, up to `most`, of the longest piece that ends there and occurs `least` times.

        All ends go back one symbol at a time together; an end leaves when its interval is narrower than least.
        """
        out = np.zeros(len(ends), np.int64)
        alive, at = np.arange(len(ends)), ends.copy()
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text), np.int64)
        for _ in range(most):
            at = at - 1
            lo, hi = self.extend(text[at], lo, hi)
            go = hi - lo >= least
            alive, at, lo, hi = alive[go], at[go], lo[go], hi[go]
            if not len(alive):
                break
            out[alive] += 1
        return out

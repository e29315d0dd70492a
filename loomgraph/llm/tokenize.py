"""Pre-tokens and byte-pair merges that give what the tokenizers library gives.

Texts of common characters are split by a plain regular expression; any other text goes through the library's own splitter, so that no table of
character classes has to agree with the library's.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Characters whose classes are known to agree; every other goes to the library.
_COMMON = "\\u0000-\\u0557\\u2000-\\u2063"
_UNCOMMON = re.compile(f"[^{_COMMON}]")


def _class(letter: str) -> str:
    """The common characters of a major Unicode category, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in (*range(0x558), *range(0x2000, 0x2064)) if unicodedata.category(chr(c))[0] == letter)


_L, _N = _class("L"), _class("N")
_S = "".join(re.escape(chr(c)) for c in (*range(0x558), *range(0x2000, 0x2064)) if chr(c).isspace() and not 0x1C <= c <= 0x1F)


@lru_cache(maxsize=None)
def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a character: printable Latin-1 as itself, the rest from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Tokens:
    """What both kinds of vocabulary need: the library's tokenizer, its special strings, and a splitter for common characters."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.special = [t["content"] for t in self.spec["added_tokens"]]
        self.spec = self.spec["model"]
        self.has_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.cache: dict[str, object] = {}

    #: Entries of the cache, which is emptied beyond that, and the longest key that is kept: together they bound its bytes.
    MOST, LONGEST = 200_000, 64

    def room(self) -> None:
        if len(self.cache) > self.MOST:
            self.cache.clear()


class ByteBpe(Tokens):
    """Counts tokens of a byte-level BPE vocabulary by rank-synchronous merging of ragged arrays."""

    SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec
        vocab, letter = model["vocab"], byte_alphabet()
        self.byte_id = np.array([vocab[letter[b]] for b in range(256)], np.uint64)
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint64)
        self.spec = None

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if not _UNCOMMON.search(text):
            return self.SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text; a special string in it is one token, as the library's default has it."""
        self.room()
        split, extra = [], []
        for t in texts:
            if t and "<" in t and self.has_special.search(t):
                parts = self.has_special.split(t)
                split.append([p for x in parts if x for p in self.pieces(x)])
                extra.append(len(parts) - 1)
            else:
                split.append(self.pieces(t) if t else [])
                extra.append(0)
        cache = self.cache
        new = list(set().union(*split).difference(cache)) if split else []
        cache.update(zip(new, self.merged(new), strict=True))
        counts = [sum(map(cache.__getitem__, s)) + e for s, e in zip(split, extra, strict=True)]
        for p in new:
            if len(p) > self.LONGEST:
                del cache[p]
        return counts

    def merged(self, pieces: list[str]) -> list[int]:
        """Symbols that are left of each pre-token.

        All pre-tokens lie in one flat array. Each round looks up every adjacent pair's rank, takes each sequence's lowest and joins all its
        occurrences, of overlapping ones every second from the left; sequences without a known pair are done and leave the arrays.
        """
        if not pieces:
            return []
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        left = size.copy()
        sym = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        seq = np.repeat(np.arange(len(raw)), size)
        last = np.int64(len(self.rank))
        while len(sym) > 1:
            pair = sym[:-1] << np.uint64(32) | sym[1:]
            at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
            rank = np.where((self.key[at] == pair) & (seq[:-1] == seq[1:]), self.rank[at], last)
            starts = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
            low = np.minimum.reduceat(np.append(rank, last), starts)  # a sequence's last place holds no pair
            lens = np.diff(np.append(starts, len(sym)))
            hit = (rank == np.repeat(low, lens)[:-1]) & (rank < last)
            begins = hit.copy()
            begins[1:] &= ~hit[:-1]
            place = np.arange(len(hit))
            since = place - np.maximum.accumulate(np.where(begins, place, 0))
            hit &= since % 2 == 0
            sym[:-1][hit] = self.made[rank[hit]]
            keep = np.concatenate(([True], ~hit))
            open_ = np.repeat(low < last, lens)
            left[seq[starts]] = np.add.reduceat(keep.astype(np.int64), starts)
            keep &= open_
            sym, seq = sym[keep], seq[keep]
        return left.tolist()


class Memo(dict):
    """A bounded cache: a missing key is computed, and beyond `most` keys it starts anew; keys longer than `longest` are not kept."""

    def __init__(self, compute, most: int, longest: int):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key):
        found = self.compute(key)
        if len(key) > self.longest:
            return found
        if len(self) > self.most:
            self.clear()
        self[key] = found
        return found


class WordBpe(Tokens):
    """Ids of a lower-casing BPE vocabulary with word ends, kept for each distinct word as little-endian 32-bit bytes."""

    SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
    #: Beyond these, composition, small letters or white space may differ from Python's: such texts go to the library.
    OTHER = re.compile("[^\\x00-\\x1b\\x20-\\u0239\\u0370-\\u0481\\u2010-\\u2027\\u2030-\\u2056]|<\\|")

    def __init__(self, path: str):
        super().__init__(path)
        self.letters = byte_alphabet()
        self.four = [i.to_bytes(4, "little") for i in range(len(self.spec["vocab"]) + len(self.special))]
        self.spec = None
        self.pieces = Memo(self.piece, self.MOST, self.LONGEST)  # ids by pre-token
        self.words = Memo(self.word, self.MOST, self.LONGEST)  # ids by word, punctuation included

    def word(self, w: str) -> bytes:
        """Ids of what stands between two white spaces."""
        found = self.SPLIT.findall(w)
        return self.pieces[w] if len(found) == 1 and found[0] == w else b"".join(map(self.pieces.__getitem__, found))

    def piece(self, p: str) -> bytes:
        four = self.four
        return b"".join([four[x.id] for x in self.library.model.tokenize(p.encode().decode("latin-1").translate(self.letters))])

    def ids(self, texts: list[str]) -> list[bytes]:
        get = self.words.__getitem__
        out = []
        for t in texts:
            if self.OTHER.search(t):
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                # Σ has two small forms in Python, by its place; the library always takes the first
                out.append(b"".join(map(get, unicodedata.normalize("NFC", t).replace("Σ", "σ").lower().split())))
        return out


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


@lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)

"""Operator 6: toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

Words are compared by the gap-weighted subsequence kernel, which gives gapped spellings and spellings with inserted characters a high value. The
kernel against a few landmarks, times the inverse root of the landmarks' own kernel matrix, is a feature vector. The machine is trained on labelled
texts as bags of words: no word of a clean text is toxic, and a toxic text has one at least. It starts from words that hold a landmark and is trained
again on the words of toxic texts that it puts on the toxic side and the highest of each, against words of clean texts, the hardest among them. A
document's score is a logistic function, fitted to the labelled texts, of its highest decision, of how many of its words are on the toxic side
(all and distinct), and of their share. Words are read in windows of WINDOW letters. Distinct words are scored once for each batch and kept in a
cache of bounded bytes.

Landmarks are beginnings of words that tell toxic from clean texts best, each unlike the ones before it, and some common words of clean texts.

Training: labels of documents whose crc32(doc_id as text) mod 5 is not 0, at most MOST_DOCS of either label, each of at most MOST_CHARS
characters, chosen by hash of doc_id: a bounded sample (parameters). Texts come to the driver one after another and are kept as numbers of words.

Null and empty texts get the score of a text without toxic words; a null doc_id is not held out; repeated rows get equal scores; very long texts
are read whole; other columns are not read, and those that come along may have any names, the score's own among them; without labels of both
kinds, or where nothing tells them apart, every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MOST_DOCS, MOST_CHARS = 2000, 20_000
#: Decay for each character that a subsequence spans, and its length.
DECAY, LENGTH = 0.6, 3
#: Letters of a window of a word, and how far apart windows begin.
WINDOW, STRIDE = 9, 6
#: Bytes of words whose decisions are kept, at most.
MOST_CACHED = 24 << 20
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]){3,}\S(?!\S)")
#: Look-alikes that are read as the letter they stand for.
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}


def plain(word: str) -> str:
    """Letters of a lower-case word, look-alikes read as letters; look-alikes at its ends are punctuation. Accents stay: they tell words apart."""
    if word.isalpha():
        return word
    word = word.strip("!|$@.,;:?\"'()[]{}<>*#%&-_")
    return "".join(c for c in (_LOOKALIKE.get(c, c) for c in word) if c.isalpha())


def windows(word: str) -> list[str]:
    """Windows of a word's letters, none if it has fewer than a subsequence."""
    p = plain(word)
    return [p[a : a + WINDOW] for a in range(0, max(1, len(p) - WINDOW + STRIDE), STRIDE)] if len(p) >= LENGTH else []


def _codes(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), np.uint16)
    for i, w in enumerate(words):
        out[i, : len(w)] = [min(ord(c), 0xFFFF) for c in w[:width]]
    return out


def _by_size(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def kernel(words: list[str], landmarks: list[str], decay: float = DECAY, length: int = LENGTH) -> np.ndarray:
    """Gap-weighted subsequence kernel of every word and landmark, not normalised.

    The recursion runs over letters of words of one length, for all of them and all landmarks at once.
    """
    t = _codes(landmarks, max(map(len, landmarks)))
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for size, rows in _by_size(words).items():
        for at in range(0, len(rows), 2048):
            some = rows[at : at + 2048]
            out[some] = _recursion(_codes([words[i] for i in some], size)[:, None, :], t[None, :, :], decay, length)
    return out


def self_kernel(words: list[str], decay: float = DECAY, length: int = LENGTH) -> np.ndarray:
    """The kernel of each word with itself."""
    out = np.zeros(len(words), np.float32)
    for size, rows in _by_size(words).items():
        s = _codes([words[i] for i in rows], size)
        out[rows] = _recursion(s, s, decay, length)
    return out


def _recursion(s: np.ndarray, t: np.ndarray, decay: float, length: int) -> np.ndarray:
    """The kernel along the last axes of letter codes s (no padding) and t (zeros at the end match nothing)."""
    shape, width = np.broadcast_shapes(s.shape[:-1], t.shape[:-1]), t.shape[-1]
    d, d2 = np.float32(decay), np.float32(decay**2)
    out = np.zeros(shape, np.float32)
    # below[i][j]: K' of order i of the letters so far and t's first j letters
    below = [[np.zeros(shape, np.float32) for _ in range(width)] for _ in range(length)]
    one = np.ones(shape, np.float32)
    for a in range(s.shape[-1]):
        match = [(s[..., a] == t[..., j]) * d2 for j in range(width)]
        for j in range(length - 1, width):
            out += match[j] * below[length - 1][j]
        for i in range(length - 1, 0, -1):  # higher orders first: they need the lower ones as they were before this letter
            inner = np.zeros(shape, np.float32)
            for j in range(i - 1, width - 1):
                inner *= d
                inner += match[j] * (one if i == 1 else below[i - 1][j])
                row = below[i][j + 1]
                row *= d
                row += inner
    return out


@dataclass
class Machine:
    landmarks: list[str]
    scale: np.ndarray  # 1 / root of each landmark's own kernel
    whiten: np.ndarray
    weights: np.ndarray
    bias: float
    calibration: tuple[float, ...]
    prior: float = 0.0

    FLOOR = -3.0

    def features(self, pieces: list[str]) -> np.ndarray:
        own = np.sqrt(np.maximum(self_kernel(pieces), 1e-12))
        return (kernel(pieces, self.landmarks) * self.scale / own[:, None]) ** 2 @ self.whiten

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision for each word as it stands in a text (lower case), that of its highest window; words without a window get the floor."""
        out = np.full(len(words), self.FLOOR, np.float32)
        owner, parts = [], []
        for i, w in enumerate(words):
            for x in windows(w):
                owner.append(i)
                parts.append(x)
        if parts:
            distinct = {p: i for i, p in enumerate(dict.fromkeys(parts))}
            found = np.clip(self.features(list(distinct)) @ self.weights + self.bias, self.FLOOR, -self.FLOOR)
            np.maximum.at(out, owner, found[[distinct[p] for p in parts]])
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        """features: rows of bag_features."""
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.calibration), -30, 30)))


def fragments(text: str) -> list[str]:
    """Words of a text in lower case, and spaced-out words joined."""
    text = text.lower()
    words = text.split()
    if found := _SPACED.findall(text):
        words += [re.sub(r"\s", "", x) for x in found]
    return words


def spellings(word: str, rng: np.random.Generator, n: int = 24) -> list[str]:
    """The word with characters inserted, doubled or dropped."""
    out = [word]
    for _ in range(n):
        w = list(word)
        for _ in range(rng.integers(1, 3)):
            at, kind = int(rng.integers(0, len(w))), rng.integers(0, 4)
            if kind <= 1:
                w.insert(at, chr(97 + int(rng.integers(0, 26))))
            elif kind == 2:
                w.insert(at, w[at])
            elif len(w) > 5 and 0 < at < len(w) - 1:
                w.pop(at)
        out.append("".join(w))
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss in the primal, by Newton steps over the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    hold = np.eye(len(w))
    hold[-1, -1] = 1e-3  # the bias is hardly held back
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        xi = x[inside] * cost[inside, None]
        new = np.linalg.solve(hold + 2 * xi.T @ x[inside], 2 * xi.T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1].astype(np.float32), float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


def bag_features(decisions: np.ndarray, distinct: int) -> tuple[float, ...]:
    """Of a text's words' decisions: the highest, how many are on the toxic side, their share, how many of them are distinct (given), and 1."""
    n = int((decisions > 0).sum())
    return float(decisions.max(initial=Machine.FLOOR)), float(np.log1p(n)), min(1.0, 10 * n / max(1, len(decisions))), float(np.log1p(distinct)), 1.0


def _beginnings(words: list[str]) -> set[str]:
    return {x[:k] for w in words for x in windows(w) for k in range(4, len(x) + 1)}


def train(rows: Iterable[tuple[str, int]], most_landmarks: int = 26, common_landmarks: int = 6, rounds: int = 3) -> Machine:
    """A machine from labelled texts (text, 1 if toxic), each read once. Equal texts count once."""
    number: dict[str, int] = {}
    bags: dict[bytes, np.ndarray] = {}
    with_start: tuple[Counter, Counter] = Counter(), Counter()
    y = []
    texts: list[bytes] = []
    for text, toxic in rows:
        y.append(toxic)
        name = hashlib.sha256(text.encode()).digest()
        texts.append(name)
        if name not in bags:
            words = fragments(text)
            bags[name] = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
            with_start[toxic].update(_beginnings(list(set(words))))
    prior = float(np.mean(y)) if y else 0.0
    none = Machine([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0, (0.0,) * 5, prior)
    label = dict(zip(texts, y, strict=True))
    once = [(bags[name], label[name]) for name in label]
    n_pos = sum(t for _, t in once)
    n_neg = len(once) - n_pos
    if not n_pos or not n_neg:
        return none
    odds = lambda w: np.log((with_start[1][w] + 0.5) / (n_pos + 1)) - np.log((with_start[0][w] + 0.5) / (n_neg + 1))
    worth = {w: k * odds(w) for w, k in with_start[1].items() if k >= max(3, 0.01 * n_pos)}
    tells = sorted((w for w, x in worth.items() if x > 0), key=lambda w: (-worth[w], w))[:400]
    if not tells:
        return none
    own = np.sqrt(self_kernel(tells))
    alike = kernel(tells, tells) / own[None, :] / own[:, None]
    chosen: list[int] = []
    for i in range(len(tells)):
        if len(chosen) < most_landmarks and all(alike[i, j] < 0.5 for j in chosen):
            chosen.append(i)
    landmarks = [tells[i] for i in chosen]
    landmarks += [w for w in sorted(with_start[0], key=lambda w: (-with_start[0][w], w))[:200] if len(w) >= 5 and w not in worth][:common_landmarks]
    scale = 1 / np.sqrt(self_kernel(landmarks))
    values, vectors = np.linalg.eigh(((kernel(landmarks, landmarks) * scale[None, :] * scale[:, None]) ** 2).astype(np.float64))
    whiten = ((vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T).astype(np.float32)
    m = Machine(landmarks, scale, whiten, np.zeros(len(landmarks), np.float32), 0.0, (0.0,) * 5, prior)
    # windows of all words, and in how many texts of either label each is
    words, window = list(number), {}
    parts = [np.array([window.setdefault(x, len(window)) for x in windows(w)], np.int32) for w in words]
    sets = [(np.unique(np.concatenate([*[parts[i] for i in np.unique(bag)], np.zeros(0, np.int32)])), t) for bag, t in once]
    seen = np.zeros((2, len(window)))
    for some, t in sets:
        seen[t, some] += 1
    pieces = list(window)
    x = np.vstack([m.features(pieces[i : i + 65_536]) for i in range(0, len(pieces), 65_536)])
    strong = {w for w in tells if worth[w] > 8 and odds(w) > np.log(4)}
    toxic = np.array([any(p[:k] in strong for k in range(4, len(p) + 1)) for p in pieces]) & (seen[1] > 0)
    rng = np.random.default_rng(7)
    made = sorted({s[:WINDOW] for w in landmarks[: len(chosen)] if len(w) >= 5 and not with_start[0][w] for s in spellings(w, rng, 6) if len(s) >= LENGTH} - window.keys())
    made_x = m.features(made) if made else x[:0]
    clean = np.flatnonzero(seen[0] > 0)
    for step in range(rounds):
        good = np.flatnonzero(toxic)
        bad = rng.choice(clean, min(len(clean), 6000), replace=False)
        if step:
            bad = np.union1d(bad, clean[np.argsort(-(x[clean] @ m.weights + m.bias), kind="stable")[:3000]])
        cost = np.concatenate([seen[1, good] * n_neg / n_pos, np.ones(len(made)), np.maximum(seen[0, bad], 1)])
        m.weights, m.bias = _svm(np.vstack([x[good], made_x, x[bad]]), np.concatenate([np.ones(len(good) + len(made)), -np.ones(len(bad))]), 4 * cost / cost.mean())
        decision = x @ m.weights + m.bias
        toxic = np.zeros(len(pieces), bool)
        for some, t in sets:
            if t and len(some):
                toxic[some[decision[some] > 0]] = True
                if decision[some].max() > -0.5:
                    toxic[some[decision[some].argmax()]] = True
        if not toxic.any():
            return none
    value = np.array([np.clip(decision[p], m.FLOOR, -m.FLOOR).max(initial=m.FLOOR) for p in parts], np.float32)
    rows_x = {name: bag_features(value[bag], int((value[np.unique(bag)] > 0).sum())) for name, bag in bags.items()}
    m.calibration = tuple(_logistic(np.array([rows_x[name] for name in texts]), np.array(y, float)))
    return m


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_DOCS) -> Iterator[tuple[str, int]]:
    """At most `most` short enough labelled texts of either kind that are not held out, the same ones each time, one after another."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = F.xxhash64(F.lit("toxicity"), id_col)
    # by label and hash first, without texts: two bounded lists
    chosen = known.filter("toxic = 1").orderBy(order, id_col).limit(most).unionByName(known.filter("toxic = 0").orderBy(order, id_col).limit(most))
    rows = chosen.collect()
    if not rows:
        return
    wanted = docs.sparkSession.createDataFrame([(r[id_col], r["toxic"]) for r in rows], known.schema)  # bounded by 2 * most
    short = docs.select(id_col, F.col(text_col).cast("string").alias("text")).filter(F.length("text") <= MOST_CHARS)
    for r in short.join(F.broadcast(wanted), id_col).dropDuplicates([id_col, "text"]).orderBy(order, "text").toLocalIterator():
        yield r["text"], r["toxic"]


class _Cache(dict):
    """Decisions by word of one machine; emptied when it holds more than MOST_CACHED bytes."""

    machine = ""

    def of(self, machine: str) -> dict[str, float]:
        if machine != self.machine or sum(map(len, self)) + 120 * len(self) > MOST_CACHED:
            self.clear()
            self.machine = machine
        return self


_CACHE = _Cache()


def scores(m: Machine, texts: list[str | None], cache: dict[str, float] | None = None) -> np.ndarray:
    """The score of each text; cache: decisions of words that are known, which new ones join."""
    cache = {} if cache is None else cache
    if not m.landmarks:
        return np.full(len(texts), m.prior)
    split = [fragments(t or "") for t in texts]
    new = list(set().union(*split).difference(cache))
    cache.update(zip(new, m.decide(new).tolist(), strict=True))
    found = []
    for words in split:
        decisions = np.fromiter(map(cache.__getitem__, words), np.float32, len(words))
        found.append(bag_features(decisions, len({w for w in words if cache[w] > 0}) if decisions.max(initial=-1) > 0 else 0))
    return m.score(np.array(found).reshape(-1, 5))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted; keep: columns of docs that come along unchanged in a column `kept`, a struct of theirs."""
    common.ship(docs.sparkSession)
    m = train(training_sample(docs, labels, id_col, text_col))
    name = f"{hash((tuple(m.landmarks), m.weights.tobytes(), m.bias))}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.keeps("toxicity", _CACHE.clear)
        for batch in batches:
            for part in common.chunks(batch, most=2 << 20):
                s = scores(m, part.column(0).to_pylist(), _CACHE.of(name))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(s, pa.float64())], [*part.schema.names[1:], "score"])

    fields = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    given = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"), *fields)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[1:]) + ", score double"
    out = given.mapInArrow(common.lean(rows, "toxicity"), schema)
    kept = [F.struct(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]).alias("kept")] if keep else []
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *kept)

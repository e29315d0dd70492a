"""Operator 7: personal data replaced by keyed, type-consistent surrogates.

Detected: e-mail addresses, telephone numbers, card numbers (with a right check digit), IPv4 addresses, and names of persons (a title or a known
first name, then capitalised words). A surrogate is a keyed permutation of the entity within its own kind and format: digits of a telephone number
stay digits in the same layout, a card number keeps its issuer's digit and gets a right check digit, an address keeps its separators and top-level
domain, a known first name becomes another of the same gender and script, any other name keeps its script, length, capitals, vowels and
consonants. A permutation gives different entities different surrogates and the same entity the same one everywhere, in any task and any document,
without a table of entities: one narrow pass. Canonical forms (lower case, digits of the national number) keep coreference between ways of
writing. Where two kinds of surrogate could meet (a permuted surname and a listed name), the permutation is walked on until they cannot;
collisions() counts what is left in a table of entities; a test counts it over a whole table. The query does not: its rows hold no entity.

Null texts stay null and have no entities; empty texts, null and repeated ids keep their rows; very long texts are one row; other columns are not
read; an empty table gives an empty table. Overlapping finds: the leftmost, then the longest.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: First names by script and gender.
FIRST_NAMES = {
    ("latin", "f"): "Alice Anna Barbara Carmen Claire Elena Emma Eva Helen Ines Julia Karin Laura Linda Lucia Maria Marie Mary Nora Olivia Paula Sarah Sofia Susan".split(),
    ("latin", "m"): "Adam Albert Bruno Carlos Daniel David Erik Felix Frank George Henry Hugo James Jean John Jorge Karl Louis Luis Martin Michael Oscar Paul Peter Robert Thomas William".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Софья Татьяна".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
}
#: Titles and the gender that they tell.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Господин": "m", "Госпожа": "f"}
#: Country calling codes of two digits; 1 and 7 have one, all others three.
_TWO_DIGITS = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_LISTED = {n: kind for kind, names in FIRST_NAMES.items() for n in names}
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zà-öø-ÿа-яё]+)?"
_FINDERS = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w]|\.\d)")),
    ("card", re.compile(r"(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w+.])(?!\d{4}-\d{2}-\d{2})(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{2,4}[ .-]\d{2,5}(?:[ .-]\d{2,4})?(?![\w-])|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,5}\)?[ .-]?\d{3,10}(?![\w-])|(?<![\w+])\+\d{8,15}(?!\w)")),
    ("person", re.compile(rf"(?<!\w)(?:(?:{'|'.join(sorted(TITLES, key=len, reverse=True))})\.?[ ]{_CAPITAL}(?:[ ]{_CAPITAL})?|(?:{'|'.join(_LISTED)})[ ]{_CAPITAL})(?!\w)")),
)
_CLASSES = tuple("0123456789 aeiou bcdfghjklmnpqrstvwxyz аеёиоуыэюя бвгджзйклмнпрстфхцчшщъь àâäáãåæèéêëìíîïòóôöõøùúûüœ çñßýÿ".split(" "))
_CLASS_OF = {c: k for k in _CLASSES for c in k}


class Keyed:
    """Permutations under a key. kind and format are the tweak: each has its own permutation."""

    def __init__(self, key: bytes):
        self.key = key
        self.order = {kind: sorted(names, key=lambda n: self._prf(f"name|{n}", 0, 1 << 64)) for kind, names in FIRST_NAMES.items()}

    def _prf(self, tweak: str, value: int, size: int) -> int:
        raw = value.to_bytes((value.bit_length() + 8) // 8, "big")
        wide = (size.bit_length() + 71) // 8
        out = b""
        while len(out) < wide:
            out += hmac.new(self.key, f"{tweak}|{len(out)}|".encode() + raw, hashlib.sha256).digest()
        return int.from_bytes(out[:wide], "big") % size

    def pair(self, a: int, b: int, size_a: int, size_b: int, tweak: str) -> tuple[int, int]:
        """A Feistel network over [0, size_a) x [0, size_b)."""
        for i in range(4):
            a = (a + self._prf(f"{tweak}|a{i}", b, size_a)) % size_a
            b = (b + self._prf(f"{tweak}|b{i}", a, size_b)) % size_b
        return a, b

    def letters(self, text: str, tweak: str) -> str:
        """Each character of a class stays in its class; other characters and capitals stay."""
        low = text.lower() if len(text.lower()) == len(text) else text
        at = [i for i, c in enumerate(low) if c in _CLASS_OF]
        kinds = [_CLASS_OF[low[i]] for i in at]
        half = len(at) // 2
        values, sizes = [0, 0], [1, 1]
        for n, (i, k) in enumerate(zip(at, kinds, strict=True)):
            side = int(n >= half)
            values[side] = values[side] * len(k) + k.index(low[i])
            sizes[side] *= len(k)
        layout = "".join(str(_CLASSES.index(_CLASS_OF[c])) if c in _CLASS_OF else c for c in low)
        values = list(self.pair(*values, *sizes, f"{tweak}|{layout}"))
        out = list(text)
        for n in range(len(at) - 1, -1, -1):
            side = int(n >= half)
            values[side], digit = divmod(values[side], len(kinds[n]))
            c = kinds[n][digit]
            out[at[n]] = c.upper() if text[at[n]] != low[at[n]] and len(c.upper()) == 1 else c
        return "".join(out)

    def number(self, digits: str, tweak: str) -> str:
        """A digit string of the same length; a first digit that is not 0 stays not 0."""
        n = len(digits)
        lead = 9 if digits[0] != "0" else 1
        half = n // 2
        size_a, size_b = lead * 10 ** (half - 1) if half else 1, 10 ** (n - half)
        low = 10 ** (half - 1) if lead == 9 and half else 0
        a, b = self.pair(int(digits[:half] or 0) - low, int(digits[half:]), size_a, size_b, f"{tweak}|{n}|{lead}")
        return (str(a + low).zfill(half) if half else "") + str(b).zfill(n - half)


def _check_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(layout: str, digits: str, skip: int = 0) -> str:
    """The digits of layout after the first `skip` replaced in order."""
    it, seen, out = iter(digits), 0, []
    for c in layout:
        if c.isdigit():
            seen += 1
            out.append(next(it) if seen > skip else c)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, text: str, k: Keyed) -> str | None:
    """The replacement, or None if the find is not of the kind after all."""
    digits = re.sub(r"\D", "", text)
    if kind == "email":
        local, _, domain = text.rpartition("@")
        labels = domain.split(".")
        return k.letters(local + "@" + ".".join(labels[:-1]), "email") + "." + labels[-1]
    if kind == "card":
        if _check_digit(digits[:-1]) != digits[-1]:
            return None
        body = digits[0] + k.letters(digits[1:-1], f"card|{digits[0]}")
        return _fill(text, body + _check_digit(body))
    if kind == "phone":
        # the national number's digits are permuted, so that a number is the same entity in every way of writing
        country = 0 if not text.startswith("+") else 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3
        if len(digits) - country < 7:
            return None
        return _fill(text, k.number(digits[country:], "phone"), country)
    if kind == "ip":
        parts = [int(x) for x in text.split(".")]
        at = [i for i, x in enumerate(parts) if 0 < x < 255]
        half = len(at) // 2
        values, sizes = [0, 0], [1, 1]
        for n, i in enumerate(at):
            values[n >= half] = values[n >= half] * 254 + parts[i] - 1
            sizes[n >= half] *= 254
        values = list(k.pair(*values, *sizes, "ip|" + ",".join(str(x) if i not in at else "" for i, x in enumerate(parts))))
        for n in range(len(at) - 1, -1, -1):
            values[n >= half], v = divmod(values[n >= half], 254)
            parts[at[n]] = v + 1
        return ".".join(map(str, parts))
    words = text.split(" ")
    out, gender = [], None
    for i, w in enumerate(words):
        if i == 0 and (title := w.rstrip(".")) in TITLES:
            gender = TITLES[title] or None
            out.append(w)
        elif w in _LISTED:
            order = k.order[_LISTED[w]]
            out.append(order[(order.index(w) + 1) % len(order)])
        else:
            new = k.letters(w, "name")
            while new in _LISTED or new in TITLES:  # walk on, so that no listed name is met
                new = k.letters(new, "name")
            out.append(new)
    return " ".join(out)


def replace(text: str, k: Keyed) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, entity, surrogate) of each find."""
    finds = []
    for kind, pattern in _FINDERS:
        if kind == "email" and "@" not in text:
            continue
        finds += [(m.start(), -m.end(), kind) for m in pattern.finditer(text)]
    out, got, at = [], [], 0
    for start, end, kind in sorted(finds):
        end = -end
        if start < at:
            continue
        new = surrogate(kind, text[start:end], k)
        if new is None:
            continue
        out += [text[at:start], new]
        got.append((kind, text[start:end], new))
        at = end
    return "".join([*out, text[at:]]) if got else text, got


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_entities, entities (kind, surrogate), text."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    each = pa.list_(pa.struct([("kind", pa.string()), ("surrogate", pa.string())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = Keyed(key)
        for batch in batches:
            for part in common.chunks(batch):
                got = [(None, []) if t is None else replace(t, k) for t in part.column(1).to_pylist()]
                found = pa.array([[{"kind": a, "surrogate": c} for a, _, c in e] for _, e in got], each)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(e) for _, e in got], pa.int64()), found, pa.array([t for t, _ in got], pa.string())], ["id", "n_entities", "entities", "text"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(rows), f"id {kind}, n_entities long, entities array<struct<kind:string,surrogate:string>>, text string")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)


def collisions(entities: DataFrame) -> DataFrame:
    """kind, surrogate, n of surrogates that stand for more than one canonical entity; entities has kind, entity, surrogate."""
    canonical = lambda c: F.when(F.col("kind").isin("card", "ip", "phone"), F.regexp_replace(c, "[^0-9.]|\\.(?=\\D|$)", "")).otherwise(F.lower(c))
    return entities.select("kind", canonical("surrogate").alias("surrogate"), canonical("entity").alias("entity")).groupBy("kind", "surrogate").agg(F.count_distinct("entity").alias("n")).filter("n > 1")

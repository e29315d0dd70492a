"""Text, year, coordinate and identifier functions as Column expressions.

Three need Python (Unicode composition, sequence similarity, URL joining) and run as Arrow UDFs; everything else stays in the JVM.
"""

from __future__ import annotations

import difflib
import functools
import html
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from urllib.parse import urljoin as join_url

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: White space as Unicode has it, with the separators U+001C to U+001F.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: Written forms of "unknown", and words of header rows.
UNKNOWN = ("", "n/a", "?", "chưa rõ", "chua ro")
HEADER_FIRST = ("tt", "stt", "số tt", "no", "no.")
HEADER_WORDS = (
    "tên di sản", "tên di tích", "tên hiện vật", "tên bảo tàng", "họ và tên", "quyết định", "số quyết định", "ngày tháng năm", "địa điểm", "địa chỉ",
    "loại hình ghi danh", "tỉnh/thành phố",
)
HEADER_ALONE = ("số quyết định", "ngày tháng năm")
EARTH_KM = 6371.0088


def collapsed(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


#: Bytes of text that a worker holds as Python strings at once, or one text, and of Arrow batches sent to it where Spark's setting is at its default.
MOST_TEXT, MOST_BATCH = 1 << 20, "16m"


def _mapped(change: Callable[[str], str]) -> Callable[[Column], Column]:
    """A function of a text as one of a column. Its worker's memory is bounded by a batch and a piece, whatever the number of rows."""

    def pieces(texts: pa.Array) -> Iterator[pa.Array]:
        """Slices with at most MOST_TEXT bytes, or one text."""
        start = held = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
            if i > start and held + n > MOST_TEXT:
                yield texts.slice(start, i - start)
                start, held = i, 0
            held += n
        if len(texts) > start:
            yield texts.slice(start)

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.array([None if x is None else change(x) for x in piece.to_pylist()], piece.type)

    run = F.arrow_udf(rows, StringType())

    def column(c: Column) -> Column:
        spark = SparkSession.getActiveSession()
        if spark and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", MOST_BATCH)
        return run(c)

    column.rows = rows
    return column


nfc = _mapped(lambda x: unicodedata.normalize("NFC", x))
#: Composed and case-folded.
folded = _mapped(lambda x: unicodedata.normalize("NFC", x).casefold())


def plain_dashes(c: Column) -> Column:
    return F.translate(c, "‒–—", "---")


def display_label(c: Column) -> Column:
    return nfc(collapsed(c))


def identity_key(c: Column) -> Column:
    """Case and dashes away, accents kept."""
    return folded(plain_dashes(collapsed(c)))


def title_key(c: Column) -> Column:
    return folded(collapsed(c))


def link_key(c: Column) -> Column:
    """Letters, digits and white space of the folded text."""
    return F.trim(F.regexp_replace(folded(c), r"(?U)[^\p{L}\p{N}\s]", ""))


def is_unknown(c: Column) -> Column:
    return c.isNull() | F.lower(collapsed(c)).isin(*UNKNOWN)


def year(c: Column) -> Column:
    """The first run of just four digits."""
    return F.when(~is_unknown(c), F.nullif(F.regexp_extract(c, r"(?<![0-9])([0-9]{4})(?![0-9])", 1), F.lit(""))).cast("int")


def year_range(c: Column) -> Column:
    """start and end: two years about a dash, or one year and null."""
    both = r"(?<![0-9])([0-9]{4}) *[-‒–—] *([0-9]{4})(?![0-9])"
    first = F.nullif(F.regexp_extract(c, both, 1), F.lit("")).cast("int")
    last = F.nullif(F.regexp_extract(c, both, 2), F.lit("")).cast("int")
    return F.struct(F.coalesce(first, year(c)).alias("start"), last.alias("end"))


def first_year(number: Column, text: Column) -> Column:
    """A year that is a number already, or the first in a text."""
    return F.coalesce(number.try_cast("int"), year(text))


def latitude(c: Column) -> Column:
    return F.when(~is_unknown(c), F.trim(c).try_cast("double"))


def longitude(c: Column) -> Column:
    """A comma may stand for the point."""
    return F.when(~is_unknown(c), F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double"))


def coordinate(lat: Column, lon: Column) -> Column:
    """lat, lon and warning; a pair out of range or with one side missing is null."""
    both = lat.isNotNull() & lon.isNotNull()
    good = both & lat.between(-90, 90) & lon.between(-180, 180)
    return F.struct(F.when(good, lat).alias("lat"), F.when(good, lon).alias("lon"), F.when(both & ~good, F.lit("INVALID_COORDINATE")).alias("warning"))


def category(c: Column) -> Column:
    return F.trim(F.regexp_replace(collapsed(c), "(?i)^Category:", ""))


def without_fragment(c: Column) -> Column:
    return F.substring_index(c, "#", 1)


def qid(c: Column) -> Column:
    """qid and warning of a Wikidata id."""
    clean = F.upper(F.trim(c))
    good = clean.rlike(r"^Q\s*[0-9]+$")
    return F.struct(F.when(~is_unknown(c) & good, F.regexp_replace(clean, r"\s", "")).alias("qid"), F.when(~is_unknown(c) & ~good, F.lit("INVALID_QID")).alias("warning"))


def distinct_aliases(label_key: Column, aliases: Column, keys: Column) -> Column:
    """Aliases whose key is new and not the label's, in order; keys has identity_key of each alias."""
    pairs = F.filter(F.arrays_zip(aliases.alias("alias"), keys.alias("key")), lambda x: (x["key"] != label_key) & (x["key"] != ""))
    kept = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, 1, i), lambda y: y["key"] == x["key"]))
    return F.transform(kept, lambda x: x["alias"])


def is_header(cells: Column) -> Column:
    low = F.transform(cells, lambda c: F.lower(c))
    first = F.element_at(low, 1)
    hits = F.size(F.filter(low, lambda c: F.exists(F.array(*map(F.lit, HEADER_WORDS)), lambda w: F.contains(c, w))))
    return first.isin(*HEADER_FIRST) | (hits >= 2) | F.exists(F.array(*map(F.lit, HEADER_ALONE)), lambda w: F.contains(first, w))


@F.pandas_udf(StringType())
def joined_url(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else join_url(b, h or "") for b, h in zip(base, href, strict=True)], dtype="object")


def valid_url(c: Column, otherwise: Column) -> Column:
    return F.when(c.rlike(r"^https?://[^/?#\s]+\S*$"), c).otherwise(otherwise)


def sha12(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 12)


def registry_id(official: Column, url: Column, cat: Column, identity: Column) -> Column:
    """An official id, or a hash of where the record is and what it says."""
    return F.coalesce(F.nullif(official, F.lit("")), F.concat(F.lit("registry-"), sha12(F.concat(url, F.lit("|"), cat, F.lit("|"), identity))))


def fallback_id(url: Column, cat: Column, label: Column) -> Column:
    return F.concat(F.lit("registry-"), sha12(F.concat(url, cat, label)))


def identity_parts(label: Column, *others: Column) -> Column:
    """Label and whatever else is there, trimmed and in lower case, joined by |."""
    return F.concat_ws("|", F.lower(F.trim(label)), *[F.nullif(F.lower(F.trim(x)), F.lit("")) for x in others])


def _ratios() -> tuple[Callable, Callable]:
    """matched_letters and sequence_ratio, as functions that go to workers whole: those need not have this package."""

    def matched_letters(a: str, b: str) -> int:
        """Letters in the matching blocks of SequenceMatcher(None, a, b), for a b of under 200 letters, of which it takes none for junk.

        Its longest block is the longest common substring, the first in a and there the first in b; substring search finds that much faster.
        """
        total, left = 0, [(a, b)]
        while left:
            a, b = left.pop()
            size = at = i = 0
            while i + size < len(a):
                if a[i : i + size + 1] in b:
                    at, size = i, size + 1
                    while at + size < len(a) and a[at : at + size + 1] in b:
                        size += 1
                i += 1
            if size:
                to = b.find(a[at : at + size])
                total += size
                if at and to:
                    left.append((a[:at], b[:to]))
                if at + size < len(a) and to + size < len(b):
                    left.append((a[at + size :], b[to + size :]))
        return total

    def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        """Ratcliff-Obershelp similarity, six places."""
        known: dict[str, difflib.SequenceMatcher] = {}

        def ratio(x: str, y: str) -> float:
            if len(y) < 200:
                return 2.0 * matched_letters(x, y) / (len(x) + len(y))
            if y not in known:
                if len(known) == 256:
                    known.clear()
                known[y] = difflib.SequenceMatcher(None, "", y)
            known[y].set_seq1(x)
            return known[y].ratio()

        return pd.Series([round(ratio(x, y), 6) if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")

    return matched_letters, F.pandas_udf(sequence_ratio, DoubleType())


matched_letters, sequence_ratio = _ratios()


@F.pandas_udf(DoubleType())
def letters_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """An upper bound of sequence_ratio: characters in common, wherever they stand."""
    counts = {x: Counter(x) for x in {*a, *b}}
    return pd.Series([2 * (counts[x] & counts[y]).total() / (len(x) + len(y)) if x and y else 0.0 for x, y in zip(a, b, strict=True)], dtype="float64")


#: Fixed value: letters that letter_counts counts apart; all others are counted together.
COMMON_LETTERS = " enaitrhoslcduộ"


def letter_counts(c: Column) -> Column:
    """How often each of the common letters stands in a text, and how often any other."""
    apart = [F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in COMMON_LETTERS]
    return F.array(*apart, F.length(F.translate(c, COMMON_LETTERS, "")))


def letters_bound(a: Column, b: Column, lengths: Column) -> Column:
    """An upper bound of letters_ratio from letter_counts, without Python."""
    return 2 * functools.reduce(Column.__add__, [F.least(a[i], b[i]) for i in range(len(COMMON_LETTERS) + 1)]) / lengths


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    return F.when((a == "") | (b == ""), 0.0).otherwise(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def parity_value(c: Column, marker: str) -> Column:
    """A value as both query languages write it: numbers without idle zeros, resources by local name."""
    number = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^\+", ""), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(c.rlike(r"^[-+]?[0-9]+(\.[0-9]+)?$"), number).when(F.contains(c, F.lit(marker)), F.regexp_extract(c, re.escape(marker) + "[a-z]+/(.*)$", 1)).otherwise(c)


def slug(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("-"))


def page_url(base: str, title: Column) -> Column:
    return F.concat(F.lit(base), F.replace(title, F.lit(" "), F.lit("_")))


@F.pandas_udf(StringType())
def markup_key(s: pd.Series) -> pd.Series:
    """Tags off, entities read, folded and collapsed."""
    return pd.Series([None if x is None else " ".join(unicodedata.normalize("NFC", html.unescape(re.sub(r"<[^>]+>", "", x))).casefold().split()) for x in s], dtype="object")


def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def snapshot_id(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")


def check_entity_id(value: str) -> str:
    if not re.fullmatch(r"[a-z0-9-]+", value or ""):
        raise ValueError(f"INVALID_ENTITY_ID: {value}")
    return value

"""Operator 2: quality rules with cross-document line frequency.

One pass over the texts computes the base counts and, for each document, the hashes of its distinct normalised lines (A-Z in lower case, white
space as one blank). How many distinct documents of a host (the source column) have a line is then counted with pre-aggregation; equal texts are
one document, because copies are for deduplication to take and would else lose every line they have; copies_count counts ids instead. Lines above the limits are removed and a document that they leave depleted is rejected.

Limits: a line goes if more than `most_documents` distinct documents of its host have it, however large the host is. A document is depleted if fewer than `least_words` words or less than `least_share` of its words stay.

Null and empty texts have no words, so base_failed; a null host is a host of its own; repeated rows are equal texts and count once, each gets its
row; very long texts are one chunk; only the three named columns are read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordgrid import Grid, run_hash, window_hash

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sorted_repeats(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values of documents: which are equal to another one of their document, and which to an earlier one."""
    order = np.lexsort((np.arange(len(h)), h, doc))
    d, x = doc[order], h[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    any_, earlier = np.zeros(len(h), bool), np.zeros(len(h), bool)
    any_[order] = same[1:] | same[:-1]
    earlier[order] = same[:-1]
    return any_, earlier


def _repeats(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values (64-bit hashes) found twice or more in their document. Documents go into the hash, and values that meet again are compared with their documents."""
    with np.errstate(over="ignore"):
        key = h + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    out = np.zeros(len(h), bool)
    if len(twice):
        some = np.flatnonzero(np.isin(key, twice))
        out[some] = _sorted_repeats(doc[some], h[some])[0]
    return out


def base_counts(texts: pa.Array, window: int = 8) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text; text_hash; and the lines: text, normalised hash, words."""
    g = Grid(texts)
    n_words = np.diff(g.first)
    chars = g.per_doc(g.inside & ((g.data & 0xC0) != 0x80), g.text_at)
    symbols = g.per_doc(_SYMBOL[g.data], g.text_at)
    doc, raw, first, count = g.lines()
    dup = np.bincount(doc[_sorted_repeats(doc, raw)[1]], minlength=g.n) if len(doc) else np.zeros(g.n, np.int64)
    h = g.hashes()
    repeat = np.zeros(g.n, np.int64)
    same = g.same_doc(window)
    at = np.flatnonzero(same)
    if len(at):
        hit = at[_repeats(g.doc[at], window_hash(h, window)[at])]
        edge = np.zeros(len(h) + 1, np.int64)
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + window, -1)
        repeat = g.per_doc(np.cumsum(edge[:-1]) > 0, g.first)
    low = Grid(texts, lower=True).hashes()
    line = run_hash(low, first, count) if len(first) else np.zeros(0, np.uint64)
    text_hash = np.zeros(g.n, np.uint64)
    some = np.flatnonzero(np.diff(g.text_at))
    text_hash[some] = run_hash(g.data, g.text_at[some], np.diff(g.text_at)[some])
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat, "text_hash": text_hash, "line_doc": doc, "line": line, "line_words": count}


_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_statistics(docs: DataFrame, host_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, host, the base counts, text_hash, and lines: distinct normalised lines with the words that they hold in the document."""
    common.ship(docs.sparkSession)
    kind, host_kind = docs.schema[id_col].dataType.simpleString(), docs.schema[host_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, most=4 << 20):
                b = base_counts(part.column(2))
                order = np.lexsort((b["line"], b["line_doc"]))
                doc, line, words = b["line_doc"][order], b["line"][order], b["line_words"][order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
                starts = np.flatnonzero(new)
                words = np.add.reduceat(words, starts) if len(starts) else words
                offsets = pa.array(np.searchsorted(doc[starts], np.arange(len(part) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (line[starts].view(np.int64), words.astype(np.int32))]
                stats = [pa.array(b[k].astype(np.int64)) for k in _STATS]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *stats, pa.array(b["text_hash"].view(np.int64)), *lists], ["id", "host", *_STATS, "text_hash", "lines", "line_words"])

    schema = f"id {kind}, host {host_kind}, " + ", ".join(f"{k} long" for k in _STATS) + ", text_hash long, lines array<long>, line_words array<int>"
    return docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(rows), schema)


def quality(
    docs: DataFrame, host_col: str = "source", most_documents: int = 10, least_words: int = 20, least_share: float = 0.3, copies_count: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, removed_words."""
    stats = common.written(line_statistics(docs, host_col, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "lines")
    host = F.xxhash64(F.coalesce(F.col("host").cast("string"), F.lit("")), F.col("host").isNull())
    document = F.when(F.col("id").isNull(), F.xxhash64("row", F.lit("row"))).otherwise(F.xxhash64("id")) if copies_count else F.col("text_hash")
    lines = stats.select("row", host.alias("host_key"), document.alias("document"), F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    lines = lines.select("row", "host_key", "document", F.xxhash64("host_key", "l.lines").alias("line"), F.col("l.line_words").alias("words"))
    # repeated ids, or copies of a text, fall together before the shuffle by line
    often = lines.groupBy("line", "host_key", "document").count().groupBy("line", "host_key").count().filter(F.col("count") > most_documents).select("line")
    gone = lines.select("row", "line", "words").join(often, "line").groupBy("row").agg(F.sum("words").alias("removed_words"))
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = (F.col("removed_words") > 0) & ((left < least_words) | (left < F.col("n_words") * least_share))
    return (
        stats.drop("lines", "line_words").join(gone, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .select(F.col("id").alias(id_col), *_STATS, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "removed_words")
    )

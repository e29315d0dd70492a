"""Operator 4: removal of repeated word windows by an FM-index for each shard.

A window is `window` words in a row of one document; the words of a window whose sequence also starts anywhere else go. Work follows from what
can repeat at all:

1. One pass over the texts gives each window's anchor, the least hash of its GRAM-word grams; neighbouring windows of one anchor are a run. Equal
   windows have equal anchors, so windows whose anchor is found in one place only are settled: they are unique.
2. Equal texts are one text from here on (known by 128 bits of hash); all words of a text of at least `window` words that has a copy go.
3. Runs of repeated anchors are cut out of their texts as segments. Anchors found very often would bring segments that differ only in what stands
   around a common passage; their windows are first counted by hash, and only those met again make segments.
4. Distinct segments are dealt to shards by anchor, so equal windows meet in one shard. Shards are made as the sorted segments of a task stream by:
   each is an FM-index of fewer than twice SHARD_WORDS words; backward search over its wavelet matrix gives each window's matching statistics among all
   segments of the shard, and windows that reach the threshold in two places are reported. An anchor with more words than that is no shard: its
   windows are dealt one by one, grouped by their words.
5. Reported intervals go back to the texts that hold the segment, are joined, and the words they leave are hashed.

Hashes only choose what is compared; the index compares words. Null texts have no words; null and repeated ids keep their rows; very long texts
have more runs (a run is cut every MOST_RUN windows); ties in anchors only lengthen runs; other columns are not read; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .fmindex import FmIndex
from .wordgrid import Grid, sliding_min, window_hash

GRAM = 8
MOST_RUN = 256
#: An anchor found more often is counted by window first.
OFTEN = 32
#: Words that complete a shard, and the most of one anchor in it.
SHARD_WORDS = 300_000
#: Bytes of text that are taken apart at once.
MOST_BYTES = 4 << 20


def _runs(g: Grid, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in the text, number of windows (negative where its text has the anchor twice) and anchor of each run."""
    gram = window_hash(h, GRAM)
    low = sliding_min(gram, window - GRAM + 1)
    good = g.same_doc(window)
    at = np.flatnonzero(good)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    anchor, doc = low[at], g.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    since = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= since % MOST_RUN == 0
    first = np.flatnonzero(new)
    with np.errstate(over="ignore"):
        mark = lambda x, d: x + d.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)  # noqa: E731  of a text
        own = np.sort(mark(gram, g.doc[: len(gram)])[g.same_doc(GRAM)])
        twice = np.isin(mark(anchor[first], doc[first]), own[1:][own[1:] == own[:-1]])
    return doc[first], at[first] - g.first[doc[first]], np.diff(np.append(first, len(at))) * np.where(twice, -1, 1), anchor[first]


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """id, k1, k2, n_words, sha (of all words), anchors, starts, counts; docs has id, text, k1, k2."""
    kind = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, most=MOST_BYTES):
                g = Grid(part.column(1))
                doc, start, count, anchor = _runs(g, g.hashes(), window)
                offsets = pa.array(np.searchsorted(doc, np.arange(g.n + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (anchor.view(np.int64), start.astype(np.int32), count.astype(np.int32))]
                sha = pa.array([hashlib.sha256(b" ".join(common.words_of(t))).hexdigest() for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(np.diff(g.first)), sha, *lists], ["id", "k1", "k2", "n_words", "sha", "anchors", "starts", "counts"])

    return docs.mapInArrow(common.lean(rows), f"id {kind}, k1 long, k2 long, n_words long, sha string, anchors array<long>, starts array<int>, counts array<int>")


def _often_windows(texts: DataFrame, window: int) -> DataFrame:
    """k1, k2, at, w1, anchor: a row for each window of a run whose anchor is found often. texts has k1, k2, text, runs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, most=MOST_BYTES):
                g = Grid(part.column(2))
                w = window_hash(g.hashes(), window)
                runs = [(i, r["start"], r["n"], r["anchor"]) for i, of in enumerate(part.column(3).to_pylist()) for r in of if r["often"]]
                doc, start, n, anchor = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 4
                at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                take = pa.array(np.repeat(doc, n))
                place = np.repeat(g.first[doc], n) + at
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(at.astype(np.int32)), pa.array(w[place].view(np.int64)), pa.array(np.repeat(anchor, n))], ["k1", "k2", "at", "w1", "anchor"])

    return texts.select("k1", "k2", "text", "runs").mapInArrow(common.lean(rows), "k1 long, k2 long, at int, w1 long, anchor long")


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """k1, k2, start, anchor, words: the words that a run's windows cover, parted by blanks. texts has k1, k2, text, runs, again (windows met again)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: tuple[list, ...] = ([], [], [], [], [])
        held = 0
        for batch in batches:
            for part in common.chunks(batch, most=MOST_BYTES):
                for k1, k2, text, runs, again in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = common.words_of(text)
                    todo = [(r["start"], r["n"], r["anchor"]) for r in runs if not r["often"]]
                    for a in sorted(again or [], key=lambda a: a["at"]):
                        if todo and todo[-1][2] == a["anchor"] and sum(todo[-1][:2]) == a["at"] and todo[-1][1] < MOST_RUN:
                            todo[-1] = (todo[-1][0], todo[-1][1] + 1, a["anchor"])
                        else:
                            todo.append((a["at"], 1, a["anchor"]))
                    for start, n, anchor in todo:
                        piece = b" ".join(words[start : start + n + window - 1]).decode()
                        held += len(piece)
                        for c, v in zip(cols, (k1, k2, start, anchor, piece), strict=True):
                            c.append(v)
                        if held > MOST_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
                            cols, held = ([], [], [], [], []), 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    names, types = ["k1", "k2", "start", "anchor", "words"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    return texts.select("k1", "k2", "text", "runs", "again").mapInArrow(common.lean(rows), "k1 long, k2 long, start int, anchor long, words string")


def repeated_intervals(segments: list[str], copies: list[int], window: int) -> list[list[tuple[int, int]]]:
    """For each distinct segment the intervals (first word, end) covered by windows that occur twice or more among the segments, copies counted."""
    split = [s.split(" ") for s in segments]
    lengths = np.array([len(s) for s in split], np.int64)
    flat = [w for s in split for w in s]
    number = {w: i for i, w in enumerate(dict.fromkeys(flat), 1)}
    symbols = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    starts = np.cumsum(lengths) - lengths
    windows = lengths - window + 1
    of = np.repeat(np.arange(len(split)), windows)
    place = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    twice = np.array(copies)[of] > 1
    todo = np.flatnonzero(~twice)
    if len(todo):
        index = FmIndex(symbols, lengths)
        length = index.matching_statistics(symbols, starts[of[todo]] + place[todo] + window, window)
        twice[todo] = length >= window
    out: list[list[tuple[int, int]]] = [[] for _ in split]
    for i, p in zip(of[twice].tolist(), place[twice].tolist(), strict=True):
        mine = out[i]
        if mine and p <= mine[-1][1]:
            mine[-1] = (mine[-1][0], p + window)
        else:
            mine.append((p, p + window))
    return out


_SPANS = "array<struct<a:int,b:int>>"


def _report(distinct: DataFrame, window: int, most: int) -> DataFrame:
    """s1, s2, found (intervals) of segments with repeated windows; distinct has anchor, words, size (in words), copies, s1, s2, dealt and sorted by anchor."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def shard(part: pa.Table) -> pa.RecordBatch:
        got = repeated_intervals(part.column("words").to_pylist(), part.column("copies").to_pylist(), window)
        some = [j for j, x in enumerate(got) if x]
        cols = [part.column(c).combine_chunks().take(pa.array(some, pa.int64())) for c in ("s1", "s2")]
        return pa.RecordBatch.from_arrays([*cols, pa.array([[{"a": a, "b": b} for a, b in got[j]] for j in some], kind)], ["s1", "s2", "found"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole anchors, and what has come of the last one
        words = 0
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            size = batch.column(2).to_numpy().cumsum()
            cut, done = 0, 0
            begins = (np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist()
            if held and len(anchor) and held[-1].column(0)[-1].as_py() != anchor[0]:
                begins.insert(0, 0)
            for e in begins:
                end = int(size[e - 1]) if e else 0
                if words + end - done >= most:
                    held.append(batch.slice(cut, e - cut))
                    yield shard(pa.Table.from_batches(held))
                    held, words, cut, done = [], 0, e, end
            if len(anchor) > cut:
                held.append(batch.slice(cut))
                words += int(size[-1]) - done
        if held:
            yield shard(pa.Table.from_batches(held))

    return distinct.select("anchor", "words", "size", "copies", "s1", "s2").mapInArrow(common.lean(rows), f"s1 long, s2 long, found {_SPANS}")


def _by_window(distinct: DataFrame, window: int) -> DataFrame:
    """As _report, for segments of anchors with too many words for a shard: their windows are grouped by their words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, "words", MOST_BYTES // window):
                of, at, piece = [], [], []
                for i, s in enumerate(part.column(0).to_pylist()):
                    words = s.split(" ")
                    for p in range(len(words) - window + 1):
                        of.append(i)
                        at.append(p)
                        piece.append(" ".join(words[p : p + window]))
                take = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(take) for c in (1, 2, 3)], pa.array(at, pa.int32()), pa.array(piece, pa.string())], ["copies", "s1", "s2", "at", "piece"])

    each = common.written(distinct.select("words", "copies", "s1", "s2").mapInArrow(common.lean(rows), "copies long, s1 long, s2 long, at int, piece string"), "pieces")
    twice = common.written(each.groupBy("piece").agg(F.sum("copies").alias("copies")).filter("copies > 1").select("piece"), "twice")
    return each.join(twice, "piece").groupBy("s1", "s2").agg(F.collect_list(F.struct(F.col("at").alias("a"), (F.col("at") + window).alias("b"))).alias("found"))


def _kept(texts: DataFrame) -> DataFrame:
    """k1, k2, n_removed, kept_sha256 of texts with intervals."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, most=MOST_BYTES):
                removed, sha = [], []
                for text, found in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    words = common.words_of(text)
                    edge = np.zeros(len(words) + 1, np.int64)
                    for x in found:
                        edge[x["a"]] += 1
                        edge[x["b"]] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    removed.append(int(gone.sum()))
                    sha.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone, strict=True) if not g])).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(sha)], ["k1", "k2", "n_removed", "kept_sha256"])

    return texts.select("k1", "k2", "text", "found").mapInArrow(common.lean(rows), "k1 long, k2 long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256. The index's shards are made wherever two texts share an anchor."""
    common.ship(docs.sparkSession)
    key = ["k1", "k2"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    found = common.written(_anchors(base, window), "anchors")
    # written, so that a join by text is one whose hot keys can be split
    classes = common.written(found.groupBy(*key).agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    runs = found.select(*key, F.explode(F.arrays_zip("anchors", "starts", "counts")).alias("r")).select(*key, F.col("r.anchors").alias("anchor"), F.col("r.starts").alias("start"), F.col("r.counts").alias("n"))
    met = runs.groupBy("anchor").agg(F.sum(F.when(F.col("n") < 0, 2).otherwise(1)).alias("count")).filter("count > 1").select("anchor", (F.col("count") > OFTEN).alias("often"))
    again = runs.withColumn("n", F.abs("n")).join(met, "anchor").groupBy(*key, "start", "n", "anchor").agg(F.max("often").alias("often"))
    lists = again.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("start", "n", "anchor", "often"))).alias("runs"))
    lists = common.written(lists.join(classes, key), "runs")
    hit = base.join(lists, (base["k1"] == lists["k1"]) & (base["k2"] == lists["k2"]) & base["id"].eqNullSafe(lists["rep"])).select(lists["k1"], lists["k2"], "text", "runs", "copies")
    texts = common.written(hit.dropDuplicates(key), "texts")
    # written, so that a join by window is one whose hot keys can be split
    windows = common.written(_often_windows(texts, window), "windows")
    often = common.written(windows.groupBy("w1").count().filter("count > 1").select("w1"), "often")
    seen = common.written(windows.join(often, "w1").groupBy(*key).agg(F.collect_list(F.struct("at", "anchor")).alias("again")), "again")
    hashed = _segments(texts.join(seen, key, "left"), window).withColumns({"s1": F.xxhash64("words"), "s2": F.xxhash64(F.lit(1), "words"), "size": F.regexp_count("words", F.lit(" ")) + 1})
    hashed = common.written(hashed, "segments")
    large = common.written(hashed.select("anchor", "s1", "s2", "size").distinct().groupBy("anchor").agg(F.sum("size").alias("words")).filter(F.col("words") > shard_words).select("anchor"), "large")
    # equal segments fall together before they are dealt to shards
    distinct = hashed.groupBy("anchor", "words").agg(F.count("*").alias("copies"), F.first("size").alias("size"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    if large.isEmpty():
        reported = _report(distinct.repartition(common.width(docs.sparkSession), "anchor").sortWithinPartitions("anchor"), window, shard_words)
    else:
        rest = hashed.join(large, "anchor", "left_semi").groupBy("anchor", "words").agg(F.count("*").alias("copies"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
        distinct = distinct.join(large, "anchor", "left_anti")
        reported = _report(distinct.repartition(common.width(docs.sparkSession), "anchor").sortWithinPartitions("anchor"), window, shard_words)
        reported = reported.unionByName(_by_window(rest, window))
    reported = common.written(reported, "reported")
    spans = hashed.select(*key, "start", "s1", "s2").join(reported, ["s1", "s2"]).select(*key, F.transform("found", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b"))).alias("found"))
    spans = spans.groupBy(*key).agg(F.flatten(F.collect_list("found")).alias("found"))
    changed = _kept(texts.filter("copies = 1").select(*key, "text").join(spans, key))
    # n_words again: a text with a copy is gone as a whole if it has a window
    counts = found.select("id", *key, "n_words", "sha").join(classes.select(*key, "copies"), key).join(changed, key, "left")
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return counts.select(
        F.col("id").alias(id_col), "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )

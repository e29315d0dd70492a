"""Operator 8: near-duplicates by SetSketch registers.

A document's set is its distinct k-word shingles. Register i of its sketch is floor(1 - log_b x) of the smallest of the shingles' exponential
variates, truncated to [0, q + 1]: such registers merge by maximum and meet with a probability that grows with the Jaccard similarity. Documents
of equal sets are one class, known by a hash of the set; only one representative of a class goes on. Runs of registers are band keys. With 32
bands of 4 registers a pair at similarity 0.8 shares no bucket with a probability under 1e-7. Members of a bucket are linked in five steps, none of
which makes all pairs of a bucket, and no link between documents of one bucket and different components is lost:

1. In the buckets of a few bands every member is compared with one leader: the likelihood of the similarity given both sketches' registers leaves
   out hopeless pairs, and the full sets confirm the rest. Links make components.
2. In buckets of any band that still hold several components, shingles found in one component only bound what a document can have in common with
   documents of others, and so the sizes of those it can be linked with. Documents without such a partner in their bucket are settled.
3. Buckets of what is left get a leader each; documents under one leader are a group, and are known by their differences from the leader's set
   (symmetric differences, "deltas"). A document whose delta is small enough is linked with the leader. The difference of two documents of a group
   is the difference of their deltas, so if one of them is not linked with the leader, they can be linked only if the deltas have a given number of
   shingles in common: what a family of near copies shares is in no delta.
4. That is a join of small sets with a prefix filter: a document's delta is ordered by how rare its shingles are in the group, those of one
   component first, and only as many of the rarest are looked at as a pair needs to meet in one. Documents that meet in a shingle are first compared
   with up to three leaders of that shingle, those with the smallest deltas before others, by the differences of whole deltas. Links join components:
   nearly all that a family's documents have in common with each other is settled here, by a number of comparisons in proportion to the prefixes.
5. What still meets across components is joined: only documents outside the main component of a shingle look for partners there. Sizes, components
   and places in the order leave out most of what meets; full sets confirm the rest.

Words are runs of anything but space and U+0009 to U+000D, A to Z in lower case; fewer words than k are one shingle; without words a document is
linked with nothing. Null texts are empty. Rows with one doc_id are one document, whatever their texts: each text has its class, and the classes of
one id fall together; null ids are linked with nothing and kept. Very long texts only make larger sets. Other columns are not read. An empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .graphs import components
from .wordgrid import Grid, mixed, run_hash, window_hash

BASE, RATE, TOP = 1.001, 20.0, 65534
BANDS, ROWS = 32, 4
#: Bands that link copies before the rest is looked at; the result does not depend on it.
FIRST_BANDS = 6
#: Bytes of text whose shingles are made at once.
MOST_BYTES = 2 << 20
_RNG = np.random.Generator(np.random.PCG64(88))
_XOR = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and where each text's begin (one more than texts)."""
    g = Grid(texts, lower=True)
    h = g.hashes()
    at = np.flatnonzero(g.same_doc(k))
    doc, value = g.doc[at], window_hash(h, k)[at]
    count = np.diff(g.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        few = (count[g.doc] < k) & (count[g.doc] > 0)
        lens = count[short]
        doc = np.concatenate((doc, short))
        value = np.concatenate((value, run_hash(h[few], np.concatenate(([0], np.cumsum(lens)))[:-1], lens)))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(g.n + 1))


def registers(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A sketch for each run of values: floor(1 - log_b(min of exponential variates)), truncated. No run is empty."""
    out = np.zeros((len(starts), len(_XOR)), np.uint16)
    for i, (x, t) in enumerate(zip(_XOR, _TIMES, strict=True)):
        with np.errstate(over="ignore"):
            low = np.minimum.reduceat((value ^ x) * t, starts)
        variate = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(np.maximum(variate, 1e-300)) / np.log(BASE)), 0, TOP + 1)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch; bands differ, equal keys stand for equal registers of one band."""
    h = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(regs), 0)
    with np.errstate(over="ignore"):
        for j in range(ROWS):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + regs[:, j::ROWS].astype(np.uint64))
    return h


def merged_sketch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Joint estimate: the similarity that makes the numbers of larger, smaller and equal registers likeliest, given both sizes."""
    more, less = (a > b).sum(-1), (a < b).sum(-1)
    same = a.shape[-1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    highest = np.minimum(u / v, v / u)
    for step in np.linspace(0, 1, 101):
        j = step * highest
        up, down = p(u - v * j), p(v - u * j)
        like = more * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + same * np.log(np.maximum(1 - up - down, 1e-12))
        at, best = np.where(like > best, j, at), np.maximum(like, best)
    return at


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    """id, k1, n, h1, h2 (hash of the set), regs, bands; docs has id, text and k1 (hash of the text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch, most=MOST_BYTES):
                value, at = shingles(part.column(1), k)
                n = np.diff(at)
                some = np.flatnonzero(n)
                h1, h2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                regs = np.zeros((len(n), len(_XOR)), np.uint16)
                if len(some):
                    regs[some] = registers(value, at[some])
                    h1[some] = run_hash(value, at[some], n[some])
                    h2[some] = run_hash(mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at[some], n[some])
                keys = band_keys(regs)
                bands = pa.ListArray.from_arrays(pa.array((np.arange(len(n) + 1) * BANDS).astype(np.int32)), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array([r.tobytes() for r in regs], pa.binary()), bands], ["id", "k1", "n", "h1", "h2", "regs", "bands"])

    return docs.mapInArrow(common.lean(rows), f"id {kind}, k1 long, n long, h1 long, h2 long, regs binary, bands array<long>")


class _Leader:
    """The set of the last leader: pairs of one leader stand together."""

    def __init__(self, k: int):
        self.k, self.name, self.set = k, None, None

    def of(self, name: int, text: pa.Array) -> np.ndarray:
        if name != self.name:
            self.name, self.set = name, shingles(text, self.k)[0]
        return self.set


def _confirm(pairs: DataFrame, k: int, percent: int, margin: float) -> DataFrame:
    """a, b of pairs (a, b, regs_a, regs_b, n_a, n_b, text_a, text_b) whose full sets are similar enough."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader = _Leader(k)
        for batch in batches:
            for part in common.chunks(batch, "text_b", MOST_BYTES):
                col = lambda name, part=part: part.column(part.schema.get_field_index(name))
                sketch = lambda name, col=col: np.frombuffer(b"".join(col(name).to_pylist()), np.uint16).reshape(-1, len(_XOR))
                guess = likely_similarity(sketch("regs_a"), sketch("regs_b"), col("n_a").to_numpy().astype(float), col("n_b").to_numpy().astype(float))
                left = np.flatnonzero(guess * 100 >= percent - 100 * margin)
                value, starts = shingles(col("text_b").take(pa.array(left)), k)
                good, a = [], col("a").to_pylist()
                for j, i in enumerate(left.tolist()):
                    one, two = leader.of(a[i], col("text_a").slice(i, 1)), value[starts[j] : starts[j + 1]]
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    if 100 * both >= percent * (len(one) + len(two) - both):
                        good.append(i)
                take = pa.array(good, pa.int64())
                yield pa.RecordBatch.from_arrays([col("a").take(take), col("b").take(take)], ["a", "b"])

    return pairs.mapInArrow(common.lean(rows), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id).

    margin: a pair goes on to its full sets unless its likeliest similarity is lower than the threshold by more than this (over five standard
    errors of 128 registers).
    """
    common.ship(docs.sparkSession)
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"))
    sketch = common.written(_sketches(given, k), "sketches")
    full = sketch.filter("n > 0 AND id IS NOT NULL")
    # a class is known by its number c from here on; first is the row that stands for it
    classes = full.groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "k1")).alias("first")).withColumn("c", F.monotonically_increasing_id())
    classes = common.written(classes.select("c", "h1", "h2", "n", F.col("first.id").alias("id"), F.col("first.k1").alias("k1")), "classes")
    several = full.groupBy("id").agg(F.min(F.struct("h1", "h2", "n")).alias("x"), F.max(F.struct("h1", "h2", "n")).alias("y")).filter("x <> y").select("id")
    of_id = common.written(full.select("id", "h1", "h2", "n").join(several, "id").join(classes.select("h1", "h2", "n", "c"), ["h1", "h2", "n"]).select("id", "c").distinct(), "same-id")
    lowest = common.written(of_id.groupBy("id").agg(F.min("c").alias("a")), "same-id")
    same_id = of_id.join(lowest, "id").select("a", F.col("c").alias("b")).filter("a <> b")
    members = full.join(classes.select("id", "k1", "c", "h1", "h2", "n"), ["id", "k1", "h1", "h2", "n"]).dropDuplicates(["c"])
    members = common.written(members.select("c", "id", "k1", "n", "regs", "bands"), "members")
    texts = _Texts(given, members, k)

    # step 1
    bands = members.select("c", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("key"))
    leaders = common.written(bands.groupBy("key").agg(F.min("c").alias("a"), F.count("*").alias("count")).filter("count > 1").drop("count"), "leaders")
    pairs = bands.join(leaders, "key").select("a", F.col("c").alias("b")).filter("a <> b").distinct()
    found = common.written(same_id.unionByName(_confirm(texts.of_pairs(pairs, percent), k, percent, margin)), "links")
    labels = components(found)

    # step 2
    placed = members.select("c", "n", F.explode("bands").alias("key")).join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    several = common.written(placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key"), "keys")
    open_ = common.written(placed.join(several, "key"), "open")
    if not open_.isEmpty():
        own = common.written(texts.own_shingles(open_.select("c", "label").distinct()), "own")
        open_ = common.written(_feasible(open_.join(own, "c"), percent), "open")
        # the leader is one of the smallest, so that no delta is many times its document's set
        lead = open_.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct(F.floor(F.log2("n")), F.xxhash64("c"), "c")).alias("lead"))
        lead = common.written(lead.filter("low <> high").select("key", F.col("lead.c").alias("g")), "leaders")
        grouped = open_.join(lead, "key").select("g", "c", "label", "own").distinct()
        # step 3
        deltas = common.written(texts.deltas(grouped, percent), "deltas")
        linked = deltas.filter("linked AND g <> c").select(F.col("g").alias("a"), F.col("c").alias("b"))
        # step 4
        deltas = common.written(_relabelled(deltas, linked), "deltas")
        first = _prefixes(deltas, percent)
        led = common.written(_led(first, deltas, percent), "links")
        # step 5
        pairs = _meeting(common.written(_relabelled(first, led), "prefixes"), percent)
        new = common.written(linked.unionByName(led).unionByName(_confirm(texts.of_pairs(pairs, percent), k, percent, margin)), "links")
        if not new.isEmpty():
            labels = components(common.written(found.unionByName(new), "links"))
    classes = classes.join(labels.withColumnRenamed("node", "c"), "c", "left").select("h1", "h2", "n", "id", F.coalesce("label", "c").alias("label"))
    lowest = common.written(classes.groupBy("label").agg(F.min("id").alias("component")), "lowest")
    classes = common.written(classes.select("h1", "h2", "n", "label").join(lowest, "label").drop("label"), "classes")
    placed = sketch.select("id", "n", "h1", "h2").join(classes, ["h1", "h2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    out = placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _feasible(open_: DataFrame, percent: int) -> DataFrame:
    """Rows (key, c, label, n, own) whose document can be linked with one of the bucket by sizes and shingles of one component.

    A link of sets of n and m needs percent * (n + m) / (100 + percent) shingles in common, and a document has n - own to share: that bounds m. The
    bucket's least size and least own stand for those of the partner, so no link is lost.
    """
    least = common.written(open_.groupBy("key").agg(F.min("n").alias("least_n"), F.min("own").alias("least_own")), "least")
    share = F.col("n") - F.col("own")
    possible = ((100 + percent) * share >= percent * (F.col("n") + F.col("least_n"))) & ((100 + percent) * share >= percent * (F.col("n") + share + F.col("least_own")))
    return open_.join(least, "key").filter(possible).drop("least_n", "least_own")


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (c, label, ...) with the label of the component that links (a, b) between the c of rows make of theirs."""
    of = common.written(rows.select("c", "label").distinct(), "labels")
    ends = links.join(of.toDF("a", "label_a"), "a").join(of.toDF("b", "label_b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    joined = components(ends.filter("a <> b").distinct()).toDF("label", "lower")
    return rows.join(joined, "label", "left").withColumn("label", F.coalesce("lower", "label")).select(*rows.columns)


def _prefixes(deltas: DataFrame, percent: int) -> DataFrame:
    """g, e, c, label, n, own, linked, size, rest: the shingles e in which a document's delta has to meet those it can be linked with.

    deltas has g, c, label, n, own, n_g, linked, delta; rest counts the shingles of a delta from e on in the order of its group.
    Sets of n and m are linked if their difference d has (100 + p) * d <= (100 - p) * (n + m), and d is what two deltas have but do not share. So
    deltas of x and y must share ((100 + p) * (x + y) - (100 - p) * (n + m)) / (2 * (100 + p)) or more. What holds for every possible partner is the
    least that a document needs: if it is linked with the leader, its partner is not; if it is not, its partner's delta holds what they share.
    """
    more, less = 100 + percent, 100 - percent
    doc = ["g", "c", "label", "n", "own", "linked", "size", "needs"]
    needs = F.when(F.col("linked"), F.floor((more * F.col("size") + less * (F.col("n_g") - F.col("n"))) / (2.0 * more)) + 1).otherwise(F.ceil((more * F.col("size") - less * (F.col("n") + F.col("n_g"))) / 200.0))
    deltas = deltas.withColumn("size", F.size("delta").cast("long")).withColumn("needs", needs)
    each = deltas.filter("size >= needs").select(*doc, F.explode("delta").alias("e"))
    # shingles of one component come first in the order and meet nobody; only the others are joined
    shared = common.written(each.groupBy("g", "e").agg(F.count("*").alias("count"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("g", "e", "count"), "shared")
    lists = each.join(shared, ["g", "e"]).groupBy(*doc).agg(F.sort_array(F.collect_list(F.struct("count", "e"))).alias("in_order"))  # no more than a document's delta
    alone = F.col("size") - F.size("in_order")
    prefix = F.col("size") - F.col("needs") + 1 - alone
    first = lists.withColumn("alone", alone).filter(prefix > 0).withColumn("in_order", F.slice("in_order", F.lit(1), F.least(prefix, F.size("in_order")).cast("int")))
    return common.written(first.select(*doc, "alone", F.posexplode("in_order").alias("at", "x")).select("g", F.col("x.e").alias("e"), "c", "label", "n", "own", "linked", "size", (F.col("size") - F.col("alone") - F.col("at")).alias("rest")), "prefixes")


def _led(first: DataFrame, deltas: DataFrame, percent: int) -> DataFrame:
    """a, b: links between documents that meet in a shingle of first and leaders of that shingle, of other labels.

    A shingle's leaders are the document of the smallest delta, that of those not linked with the group's leader, and any: what a shingle adds to a
    small delta is most of what its other documents need to share. A link is decided by whole deltas, which hold the difference of the full sets.
    """
    more, less = 100 + percent, 100 - percent
    fields = [F.col(f).alias(f) for f in ("c", "label", "linked", "n", "size")]
    small, far, any_ = (F.min(F.struct(*by, F.xxhash64("c").alias("hash"), F.struct(*fields).alias("lead")))["lead"] for by in (["size"], ["linked", "size"], []))
    leads = first.groupBy("g", "e").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.array(small, far, any_).alias("leads")).filter("low <> high")
    leads = leads.select("g", "e", F.explode(F.array_distinct("leads")).alias("lead"))
    lead = lambda f: F.col(f"lead.{f}")
    y = leads.select(F.col("g").alias("g_a"), F.col("e").alias("e_a"), *[lead(f).alias(f"{f}_a") for f in ("c", "label", "linked", "n", "size")])
    near = more * F.abs(F.col("size") - F.col("size_a")) <= less * (F.col("n") + F.col("n_a"))
    on = (F.col("g") == F.col("g_a")) & (F.col("e") == F.col("e_a")) & (F.col("label") != F.col("label_a")) & ~(F.col("linked") & F.col("linked_a")) & near
    pairs = common.written(first.join(y, on).select("g", F.col("c_a").alias("a"), F.col("c").alias("b"), (F.col("n") + F.col("n_a")).alias("both")).distinct(), "pairs")
    side = lambda x: deltas.select("g", F.col("c").alias(x), F.col("delta").alias(f"delta_{x}"))
    differ = F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
    return pairs.join(side("a"), ["g", "a"]).join(side("b"), ["g", "b"]).filter(more * differ <= less * F.col("both")).select("a", "b").distinct()


def _meeting(first: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of a group of other labels, not both linked with its leader, whose deltas meet in first and can have enough in common.

    The main label of a shingle is that of its smallest delta. Of two documents with other labels one at least has not the main one, so only those look
    for partners.
    """
    more, less = 100 + percent, 100 - percent
    main = first.groupBy("g", "e").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("size", F.xxhash64("c"), "label"))["label"].alias("main")).filter("low <> high").select("g", "e", "main")
    sides = lambda df, x: df.select("g", "e", *[F.col(f).alias(f"{f}_{x}") for f in df.columns[2:]])
    m = main.select(F.col("g").alias("g_m"), F.col("e").alias("e_m"), "main")
    others = first.join(m, (F.col("g") == F.col("g_m")) & (F.col("e") == F.col("e_m")) & (F.col("label") != F.col("main"))).select(*first.columns, "main")
    x, y = sides(others, "a"), sides(first, "b")
    a, b = (lambda f: F.col(f"{f}_a")), (lambda f: F.col(f"{f}_b"))
    enough = 2 * more * F.least(a("rest"), b("rest")) >= more * (a("size") + b("size")) - less * (a("n") + b("n"))
    share = F.least(a("n") - a("own"), b("n") - b("own"))
    able = more * share >= percent * (a("n") + b("n"))
    once = (b("label") == a("main")) | (a("c") < b("c"))
    on = (x["g"] == y["g"]) & (x["e"] == y["e"]) & once & (a("label") != b("label")) & ~(a("linked") & b("linked")) & enough & able
    return x.join(y, on).select(F.least(a("c"), b("c")).alias("a"), F.greatest(a("c"), b("c")).alias("b")).distinct()


class _Texts:
    """Texts and sketches of classes: each has the text of the row that stands for it."""

    def __init__(self, given: DataFrame, members: DataFrame, k: int):
        self.given, self.members, self.k = given, members, k

    def of(self, some: DataFrame, *also: str) -> DataFrame:
        """Rows of some (c, ...) with the text and columns of members; rows that are repeated in the input are one."""
        return some.join(self.members.select("c", "id", "k1", *also), "c").join(self.given, ["id", "k1"]).drop("id", "k1").dropDuplicates(["c"])

    def of_pairs(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Pairs (a, b) of sizes that can be linked, with n, regs and text of both."""
        pairs = common.written(pairs, "pairs")
        some = common.written(self.of(pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct(), "n", "regs"), "texts")
        side = lambda x: some.select(*[F.col(c).alias(x if c == "c" else f"{c}_{x}") for c in ("c", "n", "regs", "text")])
        sized = pairs.join(some.select(F.col("c").alias("a"), F.col("n").alias("n_1")), "a").join(some.select(F.col("c").alias("b"), F.col("n").alias("n_2")), "b")
        sized = sized.filter(f"100 * least(n_1, n_2) >= {percent} * greatest(n_1, n_2)").select("a", "b")
        return sized.join(side("b"), "b").join(side("a"), "a")

    def deltas(self, grouped: DataFrame, percent: int) -> DataFrame:
        """g, c, label, own, n, n_g, linked (with the leader g), delta: shingles of either set that are not of both."""
        k, grouped = self.k, common.written(grouped, "groups")
        some = common.written(self.of(grouped.select("c").unionByName(grouped.select(F.col("g").alias("c"))).distinct()), "texts")
        names = ["g", "c", "label", "own", "n", "n_g", "linked", "delta"]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            leader = _Leader(k)
            for batch in batches:
                for part in common.chunks(batch, "text", MOST_BYTES):
                    value, at = shingles(part.column(5), k)
                    g, n, n_g, sets = part.column(0).to_pylist(), np.diff(at), [], []
                    for i in range(len(part)):
                        lead = leader.of(g[i], part.column(4).slice(i, 1))
                        n_g.append(len(lead))
                        sets.append(np.setxor1d(lead, value[at[i] : at[i + 1]], assume_unique=True))
                    size = np.array([len(x) for x in sets], np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(np.concatenate(sets).view(np.int64)))
                    linked = (100 + percent) * size <= (100 - percent) * (n + np.array(n_g))
                    yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(n.astype(np.int64)), pa.array(n_g, pa.int64()), pa.array(linked), lists], names)

        lead = some.select(F.col("c").alias("g"), F.col("text").alias("text_g"))
        both = grouped.join(some, "c").join(lead, "g").select("g", "c", "label", "own", "text_g", "text")
        return both.mapInArrow(common.lean(rows), "g long, c long, label long, own long, n long, n_g long, linked boolean, delta array<long>")

    def own_shingles(self, labelled: DataFrame) -> DataFrame:
        """c, own: how many shingles of each document (c, label) only documents of its label have, of those given."""
        k = self.k

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in common.chunks(batch, most=MOST_BYTES):
                    value, at = shingles(part.column(2), k)
                    take = pa.array(np.repeat(np.arange(len(part)), np.diff(at)))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(value.view(np.int64))], ["c", "label", "shingle"])

        each = common.written(self.of(labelled).select("c", "label", "text").mapInArrow(common.lean(rows), "c long, label long, shingle long"), "shingles")
        alone = common.written(each.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low = high").select("shingle"), "alone")
        own = each.join(alone, "shingle").groupBy("c").agg(F.count("*").alias("own"))
        return labelled.select("c").join(own, "c", "left").select("c", F.coalesce("own", F.lit(0)).alias("own"))

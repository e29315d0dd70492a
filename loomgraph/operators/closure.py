"""Fixpoints: transitive closure of a relation, and materialised rules, both semi-naive."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .rdf import OWL, RDFS, TERM, TYPE

SUBCLASS, SUBPROPERTY, INVERSE, EQUIVALENT = RDFS + "subClassOf", RDFS + "subPropertyOf", OWL + "inverseOf", OWL + "equivalentClass"
#: A rule table (classes, properties) is a schema, not data; one beyond this many rows is joined as data.
MOST_SCHEMA_ROWS = 100_000


def kept(df: DataFrame) -> DataFrame:
    """df as a Parquet table under spark.checkpoint.dir, read again: a short lineage that outlives executors."""
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="shared-")
        sc.setCheckpointDir(base)
    to = f"{base}/fixpoint-{uuid.uuid4().hex}"
    df.write.parquet(to)
    atexit.register(_gone, spark, to)
    return spark.read.schema(df.schema).parquet(to)


def _gone(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames)


def _each(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of df, once for each value of cols; dealt out first, since few repeat and a first pass over them would hold most of them for nothing."""
    return df.repartition(*cols).dropDuplicates(list(cols))


def numbered(terms: DataFrame) -> DataFrame:
    """Distinct rows of terms, each with an id from 0 up that stays as it is written."""
    return kept(terms.distinct().withColumn("id", F.monotonically_increasing_id()))


def doubled(edges: DataFrame, keys: tuple[str, ...] = (), most_rounds: int = 64) -> DataFrame:
    """keys, a, b: pairs that two or more steps of edges (keys, a, b: a written table, distinct, no nulls) of the same keys lead from a to b, and no step alone.

    After a round all pairs up to 2^n steps apart are known, and which are just that far apart (`far`). The last 2^n steps of a shortest path of up
    to 2^(n+1) lead over one of those, its first steps over a known pair. So a pair is made once for each place that such paths meet in, in a tree
    once in all. One join a round, rounds grow with the logarithm of the longest path, and a round writes only what it finds.
    """
    ends = [*keys, "a", "b"]
    parts = [edges.select(*ends).withColumn("far", F.lit(True))]
    for _ in range(most_rounds):
        known = _union([*(p.withColumn("far", F.lit(False)) for p in parts[:-1]), parts[-1]])
        last = parts[-1].filter("far").select(*keys, F.col("a").alias("m"), "b")
        made = known.select(*keys, "a", F.col("b").alias("m"), "far").join(last, [*keys, "m"]).repartition(*ends).groupBy(*ends).agg(F.min("far").alias("far"))
        parts.append(kept(made.join(known.select(*ends), ends, "left_anti")))
        if parts[-1].filter("far").isEmpty():
            return _union(parts[1:]).select(*ends)
    raise RuntimeError(f"paths of more than 2^{most_rounds} steps")


def transitive(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 64) -> DataFrame:
    """Distinct pairs that one or more steps lead from a to b; cycles end. Terms of many edges go through the rounds as numbers."""
    edges = kept(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null").distinct())
    kind = edges.schema["a"].dataType
    if isinstance(kind, IntegralType) or kind != edges.schema["b"].dataType or edges.count() <= MOST_SCHEMA_ROWS:
        return edges.unionByName(doubled(edges, (), most_rounds)).select(F.col("a").alias(a), F.col("b").alias(b))
    terms = numbered(edges.select(F.col("a").alias("t")).union(edges.select("b")))
    of = lambda c, by: terms.select(F.col("t").alias(c), F.col("id").alias(f"_{c}")) if by == "t" else terms.select(F.col("t").alias(f"_{c}"), F.col("id").alias(c))
    coded = kept(edges.join(of("a", "t"), "a").join(of("b", "t"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    found = doubled(coded, (), most_rounds).join(of("a", "id"), "a").join(of("b", "id"), "b")
    return edges.select(F.col("a").alias(a), F.col("b").alias(b)).unionByName(found.select(F.col("_a").alias(a), F.col("_b").alias(b)))


def leading_to(edges: DataFrame, goal: Column, most_steps: int = 64) -> DataFrame:
    """Distinct a, b: pairs of the closure of edges (a, b) whose b is goal; steps are taken back from there. Where that takes very many, paths are doubled instead."""
    edges = kept(edges.filter("a is not null and b is not null").distinct())
    seen = [kept(edges.filter(F.col("b") == goal).select("a"))]
    for _ in range(most_steps):
        if seen[-1].isEmpty():
            return _union(seen).select("a", goal.alias("b"))
        new = edges.join(small(seen[-1].withColumnRenamed("a", "b")), "b").select("a").distinct()
        seen.append(kept(new.join(_union(seen), "a", "left_anti")))
    return transitive(edges).filter(F.col("b") == goal)


def small(df: DataFrame, most: int = MOST_SCHEMA_ROWS) -> DataFrame:
    """df to be broadcast if it is counted and found small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def class_closure(schema: DataFrame) -> DataFrame:
    """c, d: c is a subclass of d, by any number of steps; equivalent classes are subclasses of each other."""
    sub = schema.filter(F.col("p") == SUBCLASS).select(F.col("s").alias("a"), F.col("o").alias("b"))
    eq = schema.filter(F.col("p") == EQUIVALENT).select(F.col("s").alias("a"), F.col("o").alias("b"))
    return transitive(sub.unionByName(eq).unionByName(eq.select(F.col("b").alias("a"), F.col("a").alias("b")))).select(F.col("a").alias("c"), F.col("b").alias("d"))


def characteristic(schema: DataFrame, kind: str) -> DataFrame:
    """Properties of a kind (TransitiveProperty, SymmetricProperty), as asserted."""
    return schema.filter((F.col("p") == TYPE) & (F.col("o") == OWL + kind)).select(F.col("s").alias("p")).distinct()


def inverses(schema: DataFrame) -> DataFrame:
    inv = schema.filter(F.col("p") == INVERSE).select(F.col("s").alias("p"), F.col("o").alias("q"))
    return inv.unionByName(inv.select(F.col("q").alias("p"), F.col("p").alias("q"))).distinct()


_T = ["s", "s_kind", "p", "o", "o_kind", "o_lang", "o_dt"]


def _types(t: DataFrame, classes: DataFrame) -> DataFrame:
    return t.filter(F.col("p") == TYPE).join(small(classes), F.col("o") == F.col("c")).select("s", "s_kind", "p", F.col("d").alias("o"), F.when(F.startswith("d", F.lit("_:")), "bnode").otherwise("iri").alias("o_kind"), "o_lang", "o_dt")


def rule_paths(schema: DataFrame) -> DataFrame:
    """p, q, turned, plain: a triple of p gives one of q by sub-properties, inverse and symmetric properties in any number of steps, with its ends turned or not; plain: by sub-properties alone, as for literals."""
    sub = schema.filter(F.col("p") == SUBPROPERTY).select(F.col("s").alias("p"), F.col("o").alias("q"))
    swap = inverses(schema).unionByName(characteristic(schema, "SymmetricProperty").select("p", F.col("p").alias("q")))
    way = lambda c, turned: F.struct(F.lit(turned).alias("turned"), F.col(c).alias("p"))
    steps = _union([sub.select(way("p", x).alias("a"), way("q", x).alias("b")) for x in (False, True)] + [swap.select(way("p", x).alias("a"), way("q", not x).alias("b")) for x in (False, True)])
    ways = transitive(steps).filter("not a.turned and a <> b").select(F.col("a.p").alias("p"), F.col("b.p").alias("q"), F.col("b.turned").alias("turned"))
    plain = transitive(sub, "p", "q").withColumn("turned", F.lit(False)).withColumn("plain", F.lit(True))
    return ways.join(plain, ["p", "q", "turned"], "left").withColumn("plain", F.coalesce("plain", F.lit(False)))


def _applied(t: DataFrame, rules: DataFrame) -> DataFrame:
    """What rule paths give of triples."""
    turned = lambda x, y: F.when(F.col("turned"), F.col(y)).otherwise(F.col(x)).alias(x)
    met = t.join(small(rules), "p").filter("plain or o_kind <> 'literal'")
    return met.select(turned("s", "o"), turned("s_kind", "o_kind"), F.col("q").alias("p"), turned("o", "s"), turned("o_kind", "s_kind"), "o_lang", "o_dt")


_NODE = ["v", "kind", "lang", "dt"]


def _subject() -> list[Column]:
    return [F.col("s").alias("v"), F.col("s_kind").alias("kind"), F.lit("").alias("lang"), F.lit("").alias("dt")]


def _object() -> list[Column]:
    return [F.col("o").alias("v"), F.col("o_kind").alias("kind"), F.col("o_lang").alias("lang"), F.col("o_dt").alias("dt")]


def _walked(t: DataFrame, walk: DataFrame, onward: DataFrame, most_rounds: int) -> DataFrame:
    """What transitive properties (walk: p) and the rule paths that read those (onward) give of t, the triples of all that they read or make, and is not in t.

    Ends are nodes of the transitive properties. They go through the rounds as numbers, literals as negative ones, so none has a step on.
    """
    names = numbered(walk.select("p").unionByName(onward.select(F.col("q").alias("p"))))
    names = small(names.join(walk.distinct().withColumn("walks", F.lit(True)), "p", "left").select("p", F.col("id").alias("n"), F.coalesce("walks", F.lit(False)).alias("walks")))
    steps = t.join(names.filter("walks"), "p", "left_semi")
    nodes = numbered(steps.select(*_subject()).unionByName(steps.select(*_object()))).withColumn("id", F.when(F.col("kind") == "literal", -1 - F.col("id")).otherwise(F.col("id")))
    coded = t.join(names.select("p", "n"), "p").select("n", F.struct(*_subject()).alias("x"), F.struct(*_object()).alias("y"))
    at = lambda c, to: nodes.select(F.struct(*_NODE).alias(c), F.col("id").alias(to))
    coded = kept(_each(coded.join(at("x", "a"), "x").join(at("y", "b"), "y").select("n", "a", "b"), "n", "a", "b"))
    n_of = lambda c, to: names.select(F.col("p").alias(c), F.col("n").alias(to))
    rules = small(kept(onward.join(n_of("p", "n"), "p").join(n_of("q", "to"), "q").select("n", "to", "turned", "plain")))
    walking = small(kept(names.filter("walks").select("n")))
    known, found = [coded], []
    for _ in range(most_rounds):
        far = doubled(kept(_union(known).join(walking, "n", "left_semi")), ("n",), most_rounds)
        turned = lambda x, y: F.when(F.col("turned"), F.col(y)).otherwise(F.col(x)).alias(x)
        made = _each(far.join(rules, "n").filter("plain or b >= 0").select(F.col("to").alias("n"), turned("a", "b"), turned("b", "a")), "n", "a", "b")
        before = _union([*known, far]).join(rules.select(F.col("to").alias("n")).distinct(), "n", "left_semi")
        more = kept(made.join(before, ["n", "a", "b"], "left_anti"))
        known, found = [*known, far, more], [*found, far, more]
        if more.join(walking, "n", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"no fixpoint in {most_rounds} rounds")
    node = lambda to, names_: nodes.select(F.col("id").alias(to), *[F.col(c).alias(x) for c, x in zip(_NODE, names_)])
    out = _union(found).join(node("a", ["s", "s_kind"]), "a").join(node("b", ["o", "o_kind", "o_lang", "o_dt"]), "b")
    return out.join(names.select("n", "p"), "n").select(*_T)


def infer(triples: DataFrame, schema: DataFrame, most_rounds: int = 64, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """Triples that follow from triples and schema and are in neither; of the wanted predicates, if some are named.

    Rules: types by subclasses, subclasses' transitivity, sub-properties, transitive, symmetric, inverse properties, equivalent classes. Triples may
    repeat. Only predicates that a rule reads or makes, and that lead to a wanted one, are kept. Rules but transitivity are closed over the schema
    first (rule_paths), so that one join with a triple gives all that follows from it; then transitive properties are closed, with what follows from
    their new pairs; types are closed last, in one join. A schema whose property rules read rdf:type has all that done again until nothing is new.
    """
    schema = kept(schema.select(*_T).distinct())
    classes = kept(class_closure(schema))
    rules = kept(rule_paths(schema))
    walk = kept(characteristic(schema, "TransitiveProperty"))
    types_read = not rules.select("p").unionByName(walk).filter(F.col("p") == TYPE).isEmpty()
    if wanted is not None and not types_read:
        asked = F.col("q").isin(*wanted)
        walk = kept(walk.filter(F.col("p").isin(*wanted)).unionByName(walk.join(rules.filter(asked), "p", "left_semi")).distinct())
        rules = kept(rules.filter(asked).unionByName(rules.join(walk.withColumnRenamed("p", "q"), "q", "left_semi").select(*rules.columns)).distinct())
    asks = lambda p: wanted is None or types_read or p in wanted
    onward = rules.join(walk, "p", "left_semi").select(*rules.columns)
    made = small(kept(rules.select(F.col("q").alias("p")).distinct()))
    walked = small(kept(walk.unionByName(onward.select(F.col("q").alias("p"))).distinct()))
    ends = [p for p in (TYPE, SUBCLASS) if asks(p)]
    named = kept(_union([rules.select("p"), rules.select(F.col("q").alias("p")), walk, schema.select(F.explode(F.array(*[F.lit(p) for p in ends]).cast("array<string>")).alias("p"))]).distinct())
    in_class = small(kept(classes.select(F.col("c").alias("o")).unionByName(classes.select(F.col("d").alias("o"))).distinct()))
    has_rules, has_walk = not rules.isEmpty(), not walk.isEmpty()
    asserted = schema.unionByName(triples.select(*_T)).join(small(named), "p", "left_semi")
    if not types_read:  # types of classes that nothing follows from, and that nothing leads to, are of no use
        asserted = asserted.join(in_class.withColumn("_in", F.lit(True)), "o", "left").filter((F.col("p") != TYPE) | F.col("_in"))
    asserted = kept(asserted.select(*_T))
    bnode = lambda c: F.when(F.startswith(c, F.lit("_:")), "bnode").otherwise("iri")
    subclasses = classes.select(F.col("c").alias("s"), bnode("c").alias("s_kind"), F.lit(SUBCLASS).alias("p"), F.col("d").alias("o"), bnode("d").alias("o_kind"), F.lit("").alias("o_lang"), F.lit("").alias("o_dt"))

    def step(every: DataFrame) -> DataFrame:
        """All that follows from every and is not in it, but for rules that read types that are new."""
        derived = []
        if has_rules:
            known = every.join(made, "p", "left_semi")
            derived.append(kept(_applied(every, rules).dropDuplicates(list(TERM)).join(known, list(TERM), "left_anti").select(*_T)))
        if has_walk:
            derived.append(_walked(_union([every, *derived]).join(walked, "p", "left_semi").select(*_T), walk, onward, most_rounds))
        new = [x if wanted is None or types_read else x.filter(F.col("p").isin(*wanted)) for x in derived]
        of = lambda p: _union([every, *derived]).filter(F.col("p") == p)
        if TYPE in ends:
            known = of(TYPE)
            new.append(_types(known, classes).dropDuplicates(list(TERM)).join(known.join(in_class, "o", "left_semi"), list(TERM), "left_anti").select(*_T))
        if SUBCLASS in ends:
            new.append(subclasses.join(of(SUBCLASS), list(TERM), "left_anti").select(*_T))
        return _union(new) if new else every.limit(0)

    if not types_read:
        return step(asserted)
    found: list[DataFrame] = []
    for _ in range(most_rounds):
        found.append(kept(step(_union([asserted, *found]))))
        if found[-1].isEmpty():
            out = _union(found)
            return out if wanted is None else out.filter(F.col("p").isin(*wanted))
    raise RuntimeError(f"no fixpoint in {most_rounds} rounds")


def novel(quads: DataFrame, graph: str) -> DataFrame:
    """Distinct triples of a graph that no other graph has.

    What comes after the subject tells most triples of others apart: where the graph has few such ends, only triples with the hash of one go into the join.
    """
    end = F.xxhash64("p", "o", "o_kind", "o_lang", "o_dt")
    own, others = quads.filter(F.col("g") == graph).dropDuplicates(list(TERM)), quads.filter(F.col("g") != graph)
    ends = own.select(end.alias("_end")).distinct()
    if ends.limit(MOST_SCHEMA_ROWS + 1).count() <= MOST_SCHEMA_ROWS:
        others = others.withColumn("_end", end).join(F.broadcast(ends), "_end", "left_semi")
    return own.join(others, list(TERM), "left_anti").select(*_T)


def has_value(triples: DataFrame, p: str, value: str, base: str, made: str) -> DataFrame:
    """Members of class base whose p is value are of class made."""
    of = triples.filter((F.col("p") == TYPE) & (F.col("o") == base)).select("s", "s_kind").distinct()
    hit = triples.filter((F.col("p") == p) & (F.col("o") == value)).select("s").distinct()
    return of.join(hit, "s").select("s", "s_kind", F.lit(TYPE).alias("p"), F.lit(made).alias("o"), F.lit("iri").alias("o_kind"), F.lit("").alias("o_lang"), F.lit("").alias("o_dt"))


def disjoint_violations(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """s, a, b: members of two classes (a, b) that are disjoint."""
    types = triples.filter(F.col("p") == TYPE).select("s", "o").distinct()
    return types.withColumnRenamed("o", "a").join(small(pairs), "a").join(types.withColumnRenamed("o", "b"), ["s", "b"]).select("s", "a", "b")


def cardinality_violations(triples: DataFrame, functional: list[str]) -> DataFrame:
    """s, p, n: more than one value of a functional property."""
    return triples.filter(F.col("p").isin(*functional)).groupBy("s", "p").agg(F.count_distinct("o", "o_kind", "o_lang", "o_dt").alias("n")).filter("n > 1")



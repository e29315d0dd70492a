"""Writers: JSON lines, CSV, sorted N-Triples, reports, graphs replaced one by one, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t


def json_lines(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """JSON lines, nulls left out; with an order, files are ranges of it."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").json(path)


def csv(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    df.select(*columns).orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def _escaped(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def triple_line() -> Column:
    """A quad's triple as a line of N-Triples."""
    s = F.when(F.col("s_kind") == "bnode", F.col("s")).otherwise(F.concat(F.lit("<"), "s", F.lit(">")))
    tag = F.when(F.col("o_lang") != "", F.concat(F.lit("@"), "o_lang")).when(F.col("o_dt") != "", F.concat(F.lit("^^<"), "o_dt", F.lit(">"))).otherwise("")
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), "o", F.lit(">"))).when(F.col("o_kind") == "bnode", F.col("o")).otherwise(F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"'), tag))
    return F.concat(s, F.lit(" <"), "p", F.lit("> "), o, F.lit(" ."))


def sorted_triples(quads: DataFrame) -> DataFrame:
    """line: distinct triples in order of subject, predicate, object. N-Triples is Turtle."""
    return quads.dropDuplicates(["s", "p", "o", "o_kind", "o_lang", "o_dt"]).orderBy("s", "p", "o", "o_lang", "o_dt").select(triple_line().alias("line"))


def n_triples(quads: DataFrame, path: str) -> None:
    sorted_triples(quads).write.mode("overwrite").text(path)


def replace_graphs(quads: DataFrame, path: str) -> None:
    """Graphs of quads take the place of those in the store at path; graphs that quads lacks stay."""
    quads.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("g").parquet(path)


def report(df: DataFrame, path: str) -> None:
    """One row as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def upsert(prior: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and of prior where new has none of the key."""
    return prior.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def json_ld(quads: DataFrame, subject: str) -> DataFrame:
    """One JSON-LD document of a subject: @id, and for each predicate its objects."""
    t.check_entity_id(subject.rsplit("/", 1)[-1])
    rows = quads.filter(F.col("s") == subject).dropDuplicates(["s", "p", "o", "o_lang", "o_dt"])
    value = F.when(F.col("o_kind") == "literal", F.to_json(F.struct(F.col("o").alias("@value"), F.nullif("o_lang", F.lit("")).alias("@language"), F.nullif("o_dt", F.lit("")).alias("@type")))).otherwise(F.to_json(F.struct(F.col("o").alias("@id"))))
    per = rows.groupBy("s", "p").agg(F.array_join(F.sort_array(F.collect_list(value)), ",").alias("v"))
    body = F.transform(F.sort_array(F.collect_list(F.struct("p", "v"))), lambda x: F.concat(F.lit('"'), x["p"], F.lit('":['), x["v"], F.lit("]")))
    return per.groupBy("s").agg(F.concat(F.lit('{"@id":"'), F.first("s"), F.lit('",'), F.array_join(body, ","), F.lit("}")).alias("json"))

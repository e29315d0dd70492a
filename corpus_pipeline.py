"""A corpus pipeline of five operators. Each stage reads what the one before it kept and wrote.

1. toxicity: documents that the machine rejects go.
2. near-dedup: one document of each group of near-duplicates stays, that of the smallest id. Documents without an id are linked with nothing and stay.
3. secret scans: secrets in the text are masked; n_chars follows. No document goes.
4. mixing: documents are repeated or left out as the mix of their sources takes them.
5. packing: what is left is packed into sequences; a row for each piece.

Stages that join decide by row, not by id. A null id is linked with nothing, and its row stays; rows of one id are documents of their own, of which
near-dedup keeps one if they are copies (of rows equal in id, the one whose columns hash lowest). A null text is an empty one to every stage and stays
null until it is packed; texts without words are neither toxic nor copies, have size 0 and so are not taken by the mix, as null ids' are. A null
source is a source; nulls in other columns are carried. Very long texts are read whole. Ties are settled by columns, never by place. Columns that
documents have besides are carried to the mix under their own names, whatever those are. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import common, mixing, near_dedup, packing, secrets, toxicity
from loomgraph.llm.queries import vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(docs, common.table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    return scored.filter("predicted = 0").select("kept.*")


#: Tells the column of rows' numbers that run() adds, whatever its name, from one of the documents' own.
MARK = {"loomgraph.row": True}


def row_column(docs: DataFrame) -> str | None:
    return next((f.name for f in docs.schema if f.metadata == MARK), None)


def with_row(docs: DataFrame) -> DataFrame:
    """docs with a unique number of each row, which has to be written with the row to stay the same."""
    name = "_row"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.withColumn(name, F.monotonically_increasing_id().alias(name, metadata=MARK))


def numbered(docs: DataFrame) -> DataFrame:
    return docs if row_column(docs) else common.written(with_row(docs), "numbered")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    row = row_column(rows)
    given = [f"`{c}`" for c in rows.columns if c != row]
    found = near_dedup.near_duplicates(rows.filter("doc_id IS NOT NULL"), id_col=row).select(F.col(row).alias("row"), "component_id")
    order = rows.select(F.col(row).alias("row"), F.struct("doc_id", F.xxhash64(*given).alias("hash"), F.col(row).alias("row")).alias("order"))
    first = found.join(order, "row").groupBy("component_id").agg(F.min("order")["row"].alias(row))
    kept = rows.join(first.select(row), row, "left_semi").unionByName(rows.filter("doc_id IS NULL"))
    return kept.select(*given)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.scan(docs, secrets.train(spark), keep=tuple(docs.columns))
    masked = F.col("n_secrets") > 0
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    old = lambda c: F.col("kept").getField(c)
    return clean.select(*[F.when(masked, new[c]).otherwise(old(c)).alias(c) if c in new else old(c).alias(c, metadata=docs.schema[c].metadata) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    row = row_column(rows)
    return mixing.mixed_rows(rows, mixing.mix(rows, row_col=row), row)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", without_toxic), ("near-dedup", without_near_copies), ("secrets", without_secrets), ("mixing", mixed), ("packing", packed)]
#: A support vector machine, a tokenizer and a forest have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            given = docs.select(*[f"`{c}`" for c in docs.columns if c != row_column(docs)])
            docs = common.written(with_row(given), f"stage-{name}")
    return docs

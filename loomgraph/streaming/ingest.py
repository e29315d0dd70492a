"""Incremental upkeep of a manifest: new JSON-lines files are read as a stream, and each micro-batch is upserted by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import upsert


def manifest_stream(spark: SparkSession, source: str, schema: str, key: str, target: str, checkpoint: str):
    """A query that keeps target/v=N, the manifest after batch N; the highest N is the current one. A batch that runs again overwrites its own version."""

    def batch(rows: DataFrame, n: int) -> None:
        new = rows.filter(F.col(key).isNotNull()).dropDuplicates([key])
        prior = current(rows.sparkSession, target, schema, before=n)
        upsert(prior, new, key).write.mode("overwrite").parquet(f"{target}/v={n}")

    return spark.readStream.schema(schema).json(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str, schema: str, before: int | None = None) -> DataFrame:
    """The latest version under target, or an empty table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [int(x.getPath().getName()[2:]) for x in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    found = [v for v in found if before is None or v < before]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/v={max(found)}")

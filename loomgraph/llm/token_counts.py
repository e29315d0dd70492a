"""Operator 1: token counts of whole texts.

Pre-tokens of a batch are held as ragged numpy arrays; each sequence's lowest-rank pair is joined in all sequences at once, round by round, and
the symbols left are counted (tokenize.ByteBpe). A narrow map over the table: no shuffle, memory of one chunk of texts and a bounded cache.

Nulls and empty texts count 0; doc_id may be null or repeated (a row out for each row in); very long texts are merged whole; other columns are
not read, so their names cannot clash; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokenize import byte_bpe


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit). vocabulary: path of a byte-level BPE .json, at the same place on each worker."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        common.keeps("byte_bpe", byte_bpe.cache_clear)
        for batch in batches:
            for part in common.chunks(batch):
                n = bpe.counts([t or "" for t in part.column(1).to_pylist()])
                size = pa.compute.fill_null(pa.compute.binary_length(part.column(1)), 0)
                yield pa.RecordBatch.from_arrays([part.column(0), size.cast(pa.int64()), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(count, "byte_bpe"), f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

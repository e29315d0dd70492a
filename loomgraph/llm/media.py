"""Operator 10: media columns as progressive JPEG files and RGB tensors.

store() writes a binary column's bytes into the coefficients of progressive files; tensors() reads files, accumulates their scans and gives
full-resolution RGB. The query calls neither: digests() encodes a value, decodes the file's bytes again and hashes what it read, one row at a time
in one narrow map, and keeps neither the file nor the tensor.

Null texts are empty; null or repeated ids keep their rows; equal bytes give equal files, tensors and features; very long texts make larger
images, whose blocks are transformed in slices; other columns are not read; an empty table gives an empty table. A file that is null or cannot be
read gives a null tensor and its error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, jpeg

UNIT = 576


def padded(text: bytes, unit: int = UNIT) -> bytes:
    """With bytes 255 up to a positive multiple of unit."""
    return text + b"\xff" * (unit if not text else -len(text) % unit)


def feature(rgb) -> str:
    """Height, width, mean of each channel and crc32 of the tensor."""
    h, w, _ = rgb.shape
    total = rgb.reshape(-1, 3).sum(0, dtype="int64").tolist()
    return f"{h}x{w};" + ",".join(f"{s / (h * w):.3f}" for s in total) + f";{zlib.crc32(rgb.tobytes()):08x}"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and media, a progressive file that carries the padded UTF-8 text."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([jpeg.carry(padded((t or "").encode())) for t in part.column(1).to_pylist()], pa.binary())], ["id", "media"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(rows), f"id {kind}, media binary").withColumnRenamed("id", id_col)


def tensors(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """doc_id, height, width, rgb (height * width * 3 bytes), error of a binary column of progressive files."""
    common.ship(files.sparkSession)
    kind = files.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                media, got, error = batch.column(1)[i].as_py(), None, None
                try:
                    got = jpeg.Image(media).rgb() if media is not None else None
                except (ValueError, IndexError, KeyError, StopIteration) as e:
                    error = f"{type(e).__name__}: {e}"
                shape = got.shape[:2] if got is not None else (None, None)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([shape[0]], pa.int32()), pa.array([shape[1]], pa.int32()), pa.array([got.tobytes() if got is not None else None], pa.binary()), pa.array([error], pa.string())], ["id", "height", "width", "rgb", "error"])

    out = files.select(F.col(id_col).alias("id"), F.col(media_col).cast("binary").alias("media")).mapInArrow(common.lean(rows), f"id {kind}, height int, width int, rgb binary, error string")
    return out.withColumnRenamed("id", id_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature: what store() keeps, read back."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def digest(text: str | None) -> tuple:
        raw = (text or "").encode()
        media = jpeg.carry(padded(raw))
        image = jpeg.Image(media)
        back = jpeg.carried(image)
        return len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(image.rgb())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.chunks(batch):
                cols = list(zip(*map(digest, part.column(1).to_pylist()), strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["id", *names])

    schema = f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(rows), schema).withColumnRenamed("id", id_col)

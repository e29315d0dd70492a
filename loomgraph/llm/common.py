"""What the training-data operators share: shared storage, batches, words."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python pattern of a word: a run of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
PACKAGE = Path(__file__).resolve().parents[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable on the Python workers, by PYTHONPATH where they are local and as a zip elsewhere."""
    root, sc = str(PACKAGE.parent), spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":  # the default; smaller batches keep workers small
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:  # os.environ of the driver does not reach workers once the JVM runs
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_loom_shipped", False):
        return
    to = Path(tempfile.mkdtemp()) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(PACKAGE.parent))
    sc.addPyFile(str(to))
    sc._loom_shipped = True


#: What a Python worker keeps from one map to the next, by the map that does: how to drop it. A worker serves the maps of all stages.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, drop: Callable[[], None]) -> None:
    """Said on a worker by a map that keeps a cache there."""
    _KEPT[owner] = drop


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """rows for a worker that does not hold more and more: what other maps have kept goes first, and freed memory goes back to the system at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other in [x for x in _KEPT if x != owner]:
            _KEPT.pop(other)()
        try:
            yield from rows(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where that is unset."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="shared-")
        sc.setCheckpointDir(found)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts the lineage and outlives executors. Removed when the driver's Python ends."""
    spark = df.sparkSession
    to = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(to)
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # shuffle files of plans that nothing holds any more go now, not at some later collection
    atexit.register(_remove, spark, to)
    return spark.read.schema(df.schema).parquet(to)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped: the folder belongs to the cluster's cleaner
        return
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions in force."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(text: str = "text"):
    """The text, '' for null."""
    return F.coalesce(F.col(text), F.lit(""))


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most that many bytes of text, or one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words. bytes.split() separates at just the bytes that WORD leaves out."""
    return (text or "").encode().split()

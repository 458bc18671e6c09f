"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from estatelake.sources.shared import shared_dir, stage_path, staged

__all__ = ["Remembered", "documents", "drop_staged", "lean", "shared_dir", "ship", "slices", "stage_path", "staged"]

#: Bytes of an Arrow batch that goes to a Python worker, where the session says nothing: rows may be of any length.
BATCH_BYTES = 6 << 20


def drop_staged(*tables: DataFrame) -> None:
    """Delete tables of staged() that no later step reads, to give their disk back."""
    for t in tables:
        spark = t.sparkSession
        for f in {x.rsplit("/", 1)[0] for x in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where PYTHONPATH does not name it already."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_estatelake_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "estatelake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "estatelake").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(archive))
    context._estatelake_shipped = True


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship(spark)
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit).rstrip("b") == str(64 << 20):  # Spark's own choice
        spark.conf.set(limit, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that the texts of a piece have max_bytes at most, or are one text."""
    if not batch.num_rows:
        return
    start, total = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives its memory back to the system at its end: Spark keeps Python workers for later tasks, and what their
    allocators hold would add up over the steps of a job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


class Remembered(dict):
    """A bounded table with two generations: when the young one is full it becomes the old one, and what is
    asked for again moves back. Look up with get(); only on None ask older()."""

    def __init__(self, size: int) -> None:
        super().__init__()
        self.size, self.old = size, {}

    def older(self, key: str) -> bytes | None:
        if (found := self.old.get(key)) is not None:
            self[key] = found
        return found

    def make_room(self) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()

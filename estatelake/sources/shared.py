"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only where that is unset is another one chosen: the warehouse on a cluster, a fresh
    temporary folder in local mode (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="spark-"))
    return _own_dir[0]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd", **options: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, so that a lost
    executor costs tasks of one step and nothing is computed twice."""
    path = stage_path(df.sparkSession, name)
    df.write.options(compression=codec, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _on_store(spark: SparkSession, path: str) -> tuple:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _on_store(spark, path)
    return store.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder."""
    store, p = _on_store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(p))


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders, on whatever store they are."""
    for path in paths:
        store, p = _on_store(spark, path)
        store.delete(p, True)

"""Sources and sinks of listing data. Writers go to a new folder; Spark's commit makes them all or nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from estatelake.functions.text import key
from estatelake.schema import LISTING
from estatelake.sources.shared import exists, names, remove, staged


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: Characters of the one-byte Cyrillic code page behind its ASCII half, and their bytes as Latin-1; the one byte without a character is left out.
_BYTES = [bytes([b]) for b in range(128, 256)]
_CYRILLIC = [(c, b.decode("latin-1")) for b in _BYTES if (c := b.decode("cp1251", "ignore"))]
CYRILLIC, AS_LATIN = ("".join(x) for x in zip(*_CYRILLIC, strict=True))


def from_windows_1251(content: Column) -> Column:
    """Bytes of that code page as text; no setting of the session is needed."""
    return F.translate(F.decode(content, "ISO-8859-1"), AS_LATIN, CYRILLIC)


def to_windows_1251(text: Column) -> Column:
    """Text as bytes; what the code page lacks becomes a question mark."""
    held = F.regexp_replace(text, f"[^\\x00-\\x7F{CYRILLIC}]", "?")
    return F.encode(F.translate(held, CYRILLIC, AS_LATIN), "ISO-8859-1")


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages as (url, html), by their one-byte Cyrillic code page."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), from_windows_1251(F.col("content")).alias("html"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with the file they come from, its name (log) and its path."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("log"), F.col("_metadata.file_path").alias("path"))


def read_log_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files (line, log, path, is_utf8) as UTF-8, and as Latin-1 where any byte of their file is no UTF-8.

    Files are read in splits, whatever their size: a first pass says of each file whether all its lines are valid, a row for each file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("log"), F.col("_metadata.file_path").alias("path"))
    judged = lines.groupBy(F.col("path").alias("_path")).agg(F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))
    text = F.when(F.col("is_utf8"), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    return lines.join(judged, F.col("path") == F.col("_path")).select(text.alias("line"), "log", "path", "is_utf8")


def read_state(spark: SparkSession, url: str, table: str, status: str, transaction: str, partitions: int = 1, column: str = "listing_id", **options: str) -> DataFrame:
    """State rows over JDBC; both predicates are pushed to the database. With partitions, as many connections read ranges of a numeric column between its bounds."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if partitions > 1:
        low, high = reader.option("query", f"SELECT MIN(\"{column}\") AS \"low\", MAX(\"{column}\") AS \"high\" FROM {table}").load().first()
        if low is not None:
            reader = spark.read.format("jdbc").options(url=url, **options).options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions))
        else:
            reader = spark.read.format("jdbc").options(url=url, **options)
    return state_rows(reader.option("dbtable", table).load(), status, transaction)


def state_rows(rows: DataFrame, status: str, transaction: str) -> DataFrame:
    return rows.where((F.col("status") == status) & (F.col("transaction_type") == transaction) & F.col("source_id").isNotNull()).select("source_id", "listing_id", "price")


def listing_columns(rows: DataFrame) -> DataFrame:
    """The fixed columns in their order and types; absent ones are null, others are dropped."""
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING))


CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "emptyValue": "", "nullValue": ""}
MARK = "\ufeff"


def write_csv(rows: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """CSV files that each start with a byte order mark and one header."""
    first = next(c for c in rows.columns if c not in (partitions or []))
    writer = rows.withColumnRenamed(first, MARK + first).write.mode("append").options(header=True, quote='"', escape='"', emptyValue="", nullValue="")
    (writer.partitionBy(*partitions) if partitions else writer).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, id_col: str = "source_id") -> DataFrame:
    """Rows with an id; quoted newlines and doubled quotes are read, a byte order mark is skipped."""
    rows = spark.read.schema(schema).options(**CSV).csv(path)
    return rows.withColumn(id_col, key(F.col(id_col))).where(F.col(id_col) != "")


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def _judged(lines: DataFrame, schema: str, payload: str | None) -> DataFrame:
    """lines (column value) with the record r, whether the line is blank, and the reason for which it is none."""
    blank = F.trim("value") == ""
    held = lines.withColumn("r", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    is_object = F.trim("value").startswith("{")
    reason = F.when(~is_object | F.col("r._bad").isNotNull() | F.col("r").isNull(), "bad json").when(key(F.col("r.source_id")) == "", "no id")
    if payload:
        reason = reason.when(F.col(f"r.{payload}").isNull(), "no payload")
    return held.withColumns({"blank": blank, "reason": F.when(~blank, reason)})


def read_jsonl(lines: DataFrame, schema: str, payload: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects with a reason) of JSON lines (column value). Blank lines are skipped."""
    judged = _judged(lines, schema, payload)
    return judged.where("reason IS NULL AND NOT blank").select("r.*").drop("_bad"), judged.where("reason IS NOT NULL").select("value", "reason")


def read_jsonl_files(spark: SparkSession, path: str, schema: str, payload: str | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSON lines files; a reject names its file, its line in the file, from 1, and a reason. With strict, reading the records of a file with a reject fails and
    names the first one.

    Files are read in splits, and lines parsed once, into a stored table. A line's number is its place in its split and the lines of the splits before it: a row for
    each split, joined with the rejects alone."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")).withColumn("_at", F.monotonically_increasing_id())
    held = lines.withColumn("value", F.rtrim("value", F.lit("\r")))
    judged = staged(_judged(held, schema, payload), "json-lines")
    splits = judged.groupBy("file", "split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file", "split", "_first", before.alias("_before"))
    bad = judged.where("reason IS NOT NULL").join(starts, ["file", "split"])
    bad = bad.select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), "reason", "value")
    good = judged.where("reason IS NULL AND NOT blank")
    if strict:
        first = bad.agg(F.min(F.struct("file", "line", "reason")).alias("b")).select("b.*")
        told = F.raise_error(F.concat_ws(" ", F.lit("bad record in"), F.col("file"), F.lit("line"), F.col("line").cast("string"), F.col("reason")))
        checked = F.when(F.col("file").isNull(), F.lit(True)).otherwise(told.cast("boolean"))
        good = good.join(F.broadcast(first.select(checked.alias("_ok"))), F.col("_ok"))  # one row
    return good.select("r.*").drop("_bad"), bad


def export_sorted(rows: DataFrame, path: str, columns: list[str], key_col: str = "source_id") -> None:
    """One sorted snapshot in a folder of its own; a failed write leaves the older one as it was."""
    rows.select(*columns).orderBy(key_col).write.mode("errorifexists").parquet(path)


COMMIT = "version long, folder string"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Commit records (version, folder) of a snapshot's root."""
    return spark.read.schema(COMMIT).json(f"{root}/_commits")


def _last(spark: SparkSession, root: str) -> tuple[int, str | None]:
    if not exists(spark, f"{root}/_commits"):
        return 0, None
    row = versions(spark, root).orderBy(F.desc("version"), F.desc("folder")).first()
    return (row.version, row.folder) if row else (0, None)


def publish(rows: DataFrame, root: str, columns: list[str], key_col: str = "source_id") -> int:
    """Replace a sorted snapshot as a whole: the rows go to a folder of their own, and only when all of them are there does a commit record name it as the current version. A
    failed export leaves no record, so that readers go on with the version before."""
    spark = rows.sparkSession
    version = _last(spark, root)[0] + 1
    folder = f"v{version}-{uuid.uuid4().hex}"
    export_sorted(rows, f"{root}/{folder}", columns, key_col)
    spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder")).coalesce(1).write.mode("append").json(f"{root}/_commits")
    return version


def current(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the current version. A reader that has begun goes on with its version while a new one is published."""
    _, folder = _last(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/{folder}")


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of all but the last ``keep`` versions, and what failed exports left; their records stay. Readers of old versions must be done."""
    kept = {r.folder for r in versions(spark, root).orderBy(F.desc("version"), F.desc("folder")).limit(keep).collect()}
    gone = sorted(n for n in names(spark, root) if n.startswith("v") and n not in kept)
    remove(spark, *(f"{root}/{n}" for n in gone))
    return gone


def write_partitioned(rows: DataFrame, ts: str, path: str, transaction: str = "transaction_type") -> None:
    """Rows in folders by transaction and UTC date; what goes into one folder is brought together before, by a hash of all columns
    where a folder is large (adaptive execution splits it)."""
    dated = rows.withColumn("run_date", F.to_date(F.col(ts)))
    dated.hint("rebalance", transaction, "run_date").write.mode("append").partitionBy(transaction, "run_date").parquet(path)


def zero_fill(expected: DataFrame, facts: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """A row for every expected key, with zero counts where there are no facts."""
    return expected.join(facts, keys, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


def selection_faults(selection: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Ids of a stored selection that are blank or occur more than once."""
    return selection.groupBy(key(F.col(id_col)).alias(id_col)).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | (F.col(id_col) == ""))


def write_selection(selection: DataFrame, path: str) -> None:
    """A selection (source_id, position) once: a second write fails and leaves the first as it was."""
    selection.select("source_id", "position").write.mode("errorifexists").parquet(path)


def load_selection(spark: SparkSession, path: str) -> DataFrame:
    """A stored selection; it fails if an id is blank or occurs more than once."""
    stored = spark.read.schema("source_id string, position long").parquet(path)
    fault = selection_faults(stored).agg(F.count(F.lit(1)).alias("faults"))
    checked = F.when(F.col("faults") == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("blank or repeated ids in a stored selection: "), F.col("faults").cast("string"))).cast("boolean"))
    return stored.join(F.broadcast(fault.select(checked.alias("_ok"))), F.col("_ok")).drop("_ok")  # one row

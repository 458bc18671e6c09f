"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Each source gets a target share of all words by weight, stopped at ``max_copies`` times its own
words; what a stopped source leaves is shared among the others by weight. A document then has
``floor(target / source words)`` certain whole copies, and the rest of the target is drawn by Pareto
order sampling: documents are ranked by the odds of a uniform number (from md5 of the row's key and of
its number among the rows of that key, so that reruns agree) divided by the odds of their inclusion
probability, and taken in that order until the words reach the target, the last one by rounding. The
key is a digest of id, text and source, so that rows without an id, or of one id, are drawn one by one. ``preference`` (a column in (0, 1]) makes the
probabilities unequal.

At scale: words are counted once into a staged table of ids, sources and sizes; ranks are not
sorted source by source, since one source may hold a third of all rows: a histogram of rank keys by
source (pre-aggregated, ``BINS`` bins each) finds the bin where the target is met, only rows of that bin
are ordered, and a threshold for each source decides all rows on the map side. Only rows of keys that
repeat are numbered: by the partition that reads them and within it, so that no key is in one task.

Defined cases: null text has size 0; a null source is one source, last; empty tables and sources
without words have target 0; rows that repeat id, text and source are drawn one by one, and which of them
a rerun draws is settled by the order in which the table is read; ties in rank go by key; extra columns
are ignored by ``mix_report`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BINS = 4096
#: Sources up to this number are sent to all tasks as a table; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000
#: Keys of repeated rows up to this number (32 characters each) are sent to all tasks; more are joined by a shuffle.
BROADCAST_KEYS = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(id_col: Column, text: Column, source: Column) -> Column:
    """Digest of what tells rows apart. Null and empty texts are one; null ids and sources are unlike all others."""
    named = (F.md5(F.coalesce(F.concat(F.lit("1"), c.cast("string")), F.lit("0")).cast("binary")) for c in (id_col, source))
    return F.md5(F.concat(*named, F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def uniform(key: Column, nth: Column) -> Column:
    """A number in (0, 1) from a row's key and its number among the rows of that key."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", key, nth.cast("string")).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def repeated_keys(keyed: DataFrame) -> DataFrame:
    """The keys of several rows. Staged."""
    return staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "mix-repeated")


def numbered(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds nth: 1, 2, ... over the rows of each key. A key's rows are numbered within the partition that reads them, and each
    partition goes on where the ones before it stop."""
    n = repeated.count()
    if not n:
        return keyed.withColumn("nth", F.lit(1).cast("long"))
    keys = F.broadcast(repeated) if n <= BROADCAST_KEYS else repeated
    once = keyed.join(keys, "key", "left_anti").withColumn("nth", F.lit(1).cast("long"))
    # written once, since a partition that is read again need not hold the same rows
    placed = staged(keyed.withColumn("shard", F.spark_partition_id()).join(keys, "key", "left_semi"), "mix-repeats")
    counts = placed.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(W.partitionBy("key").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    before = counts.select(F.col("key").alias("_key"), F.col("shard").alias("_shard"), F.coalesce(earlier, F.lit(0)).alias("_before"))
    dealt = placed.repartition("key", "shard").withColumn("within", F.row_number().over(W.partitionBy("key", "shard").orderBy("key")))
    again = dealt.join(before, (F.col("key") == F.col("_key")) & (F.col("shard") == F.col("_shard"))).withColumn("nth", F.col("_before") + F.col("within"))
    return once.unionByName(again.drop("shard", "within", "_key", "_shard", "_before"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: one row for each source.

    The level that fills all targets is found by ordering sources by the level at which they stop; the
    windows run over sources, not documents.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn("stop", F.lit(max_copies) * F.col("source_size") / F.col("weight"))
    by_stop = W.orderBy("stop", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    levels = ranked.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(F.lit(max_copies) * F.col("source_size")).over(by_stop.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("stopped"),
        F.sum("weight").over(by_stop.rowsBetween(0, W.unboundedFollowing)).alias("open_weight"),
    ).withColumn("level", (F.col("total") - F.col("stopped")).cast("double") / F.col("open_weight"))
    # levels fall behind the first source that does not stop, so that the highest one below its stop is that source's
    fill = F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
    return levels.withColumn("fill", fill).select("source", "source_size", F.least(F.col("weight") * F.col("fill"), (F.lit(max_copies) * F.col("source_size")).cast("double")).alias("target"))


def _with_rank(docs: DataFrame, preference: Column | None) -> DataFrame:
    """Adds copies (certain ones), rest (words still to be drawn in the source) and q, the Pareto rank key."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    docs = docs.withColumn("copies", F.floor(ratio)).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    p = (ratio - F.col("copies")) * (preference if preference is not None else F.lit(1.0))
    u = uniform(F.col("key"), F.col("nth"))
    return docs.withColumn("q", F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) / (p / (1 - p))))


def _bin(q: Column) -> Column:
    """Rank keys in (0, inf) to bins in rank order, evenly as far as keys are odds."""
    return F.floor(q / (1 + q) * BINS).cast("int")


def by_length(size: Column) -> Column:
    """Short fragments are less worth an extra copy."""
    return size / (size + 50)


def thresholds(sized: DataFrame, preference: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target, last (rank, key and number of the last document drawn, null if none)."""
    per_source = staged(targets(sized, weights, max_copies), "mix-targets")
    ranked = _with_rank(join_sources(sized, per_source), preference).where("q IS NOT NULL").select("source", "key", "nth", "size", "rest", "q", _bin(F.col("q")).alias("bin"))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"), F.first("rest").alias("rest"))
    up_to = F.sum("in_bin").over(W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    # the last bin whose rows are at least partly drawn: the first one that reaches the target, else the last
    reached = bins.withColumn("before", up_to - F.col("in_bin")).where(F.col("before") <= F.col("rest"))
    edge = reached.groupBy("source").agg(F.max(F.struct("bin", "before")).alias("e")).select("source", "e.bin", "e.before")
    edge = staged(edge, "mix-edges")
    at = edge.select(F.col("source").alias("_source"), F.col("bin").alias("_bin"), "before")
    on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin"))
    rows = ranked.join(F.broadcast(at) if _few(per_source) else at, on).select("source", "key", "nth", "size", "rest", "q", "before")
    so_far = F.sum("size").over(W.partitionBy("source").orderBy("q", "key", "nth").rowsBetween(W.unboundedPreceding, W.currentRow))
    drawn = rows.withColumn("cum", F.col("before") + so_far).where(F.col("cum") - F.col("size") / 2 <= F.col("rest"))
    last = drawn.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("q", "key", "nth")).alias("last"))
    # where no row of the edge bin is drawn, all rows before it are
    edges = edge.select(F.col("source").alias("_source"), F.col("bin").alias("edge_bin"))
    for right in (last, edges):
        per_source = per_source.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return staged(per_source, "mix-thresholds")


def _few(per_source: DataFrame) -> bool:
    return per_source.count() <= BROADCAST_SOURCES


def join_sources(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """docs with their source's columns; the table of sources is broadcast if a count shows it small."""
    right = per_source.withColumnRenamed("source", "_source")
    joined = docs.join(F.broadcast(right) if _few(per_source) else right, docs["source"].eqNullSafe(right["_source"]))
    return joined.drop("_source")


def _decide(docs: DataFrame, preference: Column | None) -> DataFrame:
    """Adds copies in all, from the thresholds of the source."""
    ranked = _with_rank(docs, preference)
    before_edge = _bin(F.col("q")) < F.col("edge_bin")
    drawn = F.when(F.col("q").isNull(), False).when(before_edge, True).otherwise(F.coalesce((_bin(F.col("q")) == F.col("edge_bin")) & (F.struct("q", "key", "nth") <= F.col("last")), F.lit(False)))
    return ranked.withColumn("copies", (F.col("copies") + drawn.cast("int")).cast("int"))


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """doc_id, source, key, size and nth of each document, and the keys that repeat. Staged."""
    key = row_key(docs[id_col], docs[text_col], docs[source_col])
    keyed = staged(docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), key.alias("key"), words(docs[text_col]).alias("size")), "mix-sizes")
    repeated = repeated_keys(keyed)
    if repeated.isEmpty():
        return numbered(keyed, repeated), repeated
    sized = staged(numbered(keyed, repeated), "mix-numbered")
    drop_staged(keyed)
    return sized, repeated


def mix_report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken for each document."""
    sized, _ = sized_documents(docs)
    chosen = _decide(join_sources(sized, thresholds(sized, by_length(F.col("size")), weights, max_copies)), by_length(F.col("size")))
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mixed documents themselves, a row for each copy, with the columns of docs."""
    sized, repeated = sized_documents(docs)
    per_source = thresholds(sized, by_length(F.col("size")), weights, max_copies)
    drop_staged(sized)
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # no name of docs can clash with ours
    key = row_key(docs["doc_id"], docs["text"], docs["source"])
    held = docs.select(*(docs[c].alias(n) for c, n in names.items()), docs["source"].alias("source"), key.alias("key"), words(docs["text"]).alias("size"))
    chosen = _decide(join_sources(numbered(held, repeated), per_source), by_length(F.col("size"))).where("copies > 0")
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*(F.col(n).alias(c) for c, n in names.items()))


#: The same in DuckDB's SQL, over the view documents.
SQL = r"""
WITH keyed_rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(md5(coalesce('1' || doc_id::VARCHAR, '0')) || md5(coalesce('1' || source, '0')) || md5(coalesce(text, ''))) AS key FROM documents),
sized AS (SELECT *, row_number() OVER (PARTITION BY key) AS nth FROM keyed_rows),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, sum(source_size) OVER () AS total FROM src),
stops AS (SELECT *, 3 * source_size::DOUBLE / weight AS stop FROM weighed),
levels AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM stops),
filled AS (SELECT max(level) AS fill FROM levels WHERE level <= stop),
targets AS (SELECT source, source_size, least(weight * fill, (3 * source_size)::DOUBLE) AS target FROM levels, filled),
ranked AS (
  SELECT s.doc_id, s.size, s.key, s.nth, t.source, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS ratio,
    (('0x' || substr(md5(s.key || ':' || s.nth::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
odds AS (SELECT *, floor(ratio) AS copies, (ratio - floor(ratio)) * (size::DOUBLE / (size + 50)) AS p FROM ranked),
keyed AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q, target - copies * source_size AS rest FROM odds),
summed AS (
  SELECT *, sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY q NULLS LAST, key, nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM keyed)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (size * (copies + CASE WHEN q IS NOT NULL AND cum - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""

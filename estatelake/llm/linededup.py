"""Line dedup over the whole corpus. DataFrame functions only.

The non-blank lines of all documents, in the order (doc_id, place), are one long sequence of line
ids. Its suffixes are ranked by prefix doubling: the rank of 2k lines comes from the ranks of the
first and of the next k lines. Ranks follow the sort order of the pairs and equal pairs share one;
they come from one range partitioning of the *distinct* pairs, in which
``monotonically_increasing_id`` over sorted partitions grows with the order (ranks have gaps). A hot
line thus costs one row for each distinct continuation, not for each occurrence. Only lines that occur at
least twice take part, and after each round only suffixes whose rank is shared go on.

Suffixes of one rank at depth 2^d are an interval of the suffix array whose longest common prefix
is at least 2^d lines. Its first member in corpus order is kept; the others are later copies. A later
copy of a maximal run is covered by later copies of the deepest power of two that fits it (one at its
start, one at its end), so that the union of those intervals is exactly the lines to delete.

A run is long enough with ``MIN_LINES`` lines, or as one line of ``MIN_CHARS`` characters. The first
occurrence of every line stays. Lines are compared without outer spaces; blank lines stay.

Defined cases: null text stays null and has no lines; equal rows (same id and text) are one document
and get one result each; rows of one id with different texts are different documents, in the order of
their text's hash; lines of any number and length; an empty table gives an empty result; extra
columns are kept by ``dedup_lines`` whatever their names, but for those that it adds itself, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, staged

MIN_LINES, MIN_CHARS = 2, 10
#: Rounds of doubling at most: runs of 2^40 lines.
MAX_ROUNDS = 40


def _lines(text: Column) -> Column:
    """An array of (pos, hash, hash2, chars) of the non-blank lines."""
    line = lambda x, i: F.struct(i.alias("pos"), F.xxhash64(F.trim(x)).alias("h"), F.xxhash64(F.lit("2"), F.trim(x)).alias("g"), F.length(F.trim(x)).alias("chars"))
    return F.filter(F.transform(F.split(text, "\n"), line), lambda x: x["chars"] > 0)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, dk (hash of the whole text), seq, pos, h, g, chars: a row for each non-blank line."""
    rows = docs.select(docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("dk"), _lines(docs[text_col]).alias("lines"))
    return rows.select("doc", "dk", F.posexplode("lines").alias("seq", "line")).select("doc", "dk", "seq", "line.pos", "line.h", "line.g", "line.chars")


def _named(pairs: DataFrame, cols: list[str], spark_partitions: int) -> DataFrame:
    """Distinct values of cols with an order-preserving number, their count and first member."""
    first = F.min(F.struct("doc", "dk", "seq")).alias("first")
    distinct = pairs.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"), first).where("n > 1")
    ordered = distinct.repartitionByRange(spark_partitions, *cols).sortWithinPartitions(*cols)
    return ordered.select(*(F.col(c).alias(f"_{c}") for c in cols), F.monotonically_increasing_id().alias("rank"), "first")


def _joined(rows: DataFrame, names: DataFrame, cols: list[str]) -> DataFrame:
    on = [F.col(c) == F.col(f"_{c}") for c in cols]
    return rows.join(names, on).drop(*(f"_{c}" for c in cols))


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, dk, seq, len, rank: suffixes whose first ``len`` lines occur earlier in the corpus, by rounds of doubling
    (len = 1, 2, 4, ...), with the rank of that prefix in the suffix array."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = staged(line_table(docs, id_col, text_col), "lines")
    names = staged(_named(lines, ["h", "g"], parts), "line-names")
    # one line table row for each line that occurs twice; equal rows of the input fall together here
    held = staged(_joined(lines.select("doc", "dk", "seq", "h", "g", "chars"), names, ["h", "g"]).drop("h", "g").dropDuplicates(["doc", "dk", "seq"]), "shared-lines")
    drop_staged(lines, names)
    later = ~F.struct("doc", "dk", "seq").eqNullSafe(F.col("first"))
    alone = F.lit(True) if min_lines <= 1 else F.col("chars") >= min_chars
    found = [held.where(later & alone).select("doc", "dk", "seq", F.lit(1).alias("len"), "rank")]
    level, step = held.select("doc", "dk", "seq", "rank"), 1
    for _ in range(MAX_ROUNDS):
        # the rank of the suffix that many lines on; without one, the longer prefix is not shared
        ahead = F.max("r").over(W.partitionBy("doc", "dk").orderBy("seq").rangeBetween(step, step))
        pairs = staged(level.withColumnRenamed("rank", "r").withColumn("x", ahead).where("x IS NOT NULL"), "suffix-pairs")
        names = staged(_named(pairs, ["r", "x"], parts), "suffix-names")
        if names.isEmpty():
            break
        step *= 2
        ranked = staged(_joined(pairs, names, ["r", "x"]).drop("r", "x"), "suffix-ranks")
        drop_staged(pairs, names)
        if step >= min_lines:
            found.append(ranked.where(later).select("doc", "dk", "seq", F.lit(step).alias("len"), "rank"))
        level = ranked.select("doc", "dk", "seq", "rank")
    else:
        raise RuntimeError(f"runs of more than 2^{MAX_ROUNDS} lines")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _covered(copies: DataFrame) -> DataFrame:
    """doc, dk, gone: the non-blank lines (by seq) of each document that a later copy covers."""
    best = copies.groupBy("doc", "dk", "seq").agg((F.col("seq") + F.max("len")).alias("end"))
    # what an earlier copy of the document covers is left out, so that every line comes once
    before = F.max("end").over(W.partitionBy("doc", "dk").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    fresh = best.withColumn("start", F.greatest("seq", F.coalesce(before, "seq"))).where("start < end")
    lines = fresh.select("doc", "dk", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("seq"))
    return lines.groupBy("doc", "dk").agg(F.sort_array(F.collect_list("seq")).alias("gone"))


def _cut(docs: DataFrame, id_col: str, text_col: str, min_lines: int, min_chars: int) -> tuple[DataFrame, dict[str, str]]:
    """docs without later copies, under names that clash with none (old name -> new name), with _lines and _gone (their numbers)."""
    gone = staged(_covered(later_copies(docs, id_col, text_col, min_lines, min_chars)), "deleted-lines")
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    held = docs.select(*(docs[c].alias(n) for c, n in names.items()), docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("dk"))
    right = gone.select(F.col("doc").alias("_doc"), F.col("dk").alias("_dk"), "gone").hint("shuffle_hash")
    both = held.join(right, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("dk") == F.col("_dk")), "left")
    text = F.col(names[text_col])
    parts = F.split(text, "\n")
    full = F.filter(F.transform(parts, lambda x, i: F.when(F.length(F.trim(x)) > 0, i)), lambda x: x.isNotNull())
    deleted = F.transform("gone", lambda s: F.element_at(full, s + 1))
    rest = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), deleted)
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.transform(rest, lambda i: F.element_at(parts, i + 1)), "\n"))
    columns = [(kept if c == text_col else F.col(n)).alias(n) for c, n in names.items()]
    return both.select(*columns, F.coalesce(F.size(full), F.lit(0)).alias("_lines"), F.coalesce(F.size("gone"), F.lit(0)).alias("_gone")), names


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with later copies of line runs cut out of the text; adds n_lines (non-blank) and n_deleted, in place of columns of
    these names."""
    cut, names = _cut(docs, id_col, text_col, min_lines, min_chars)
    return cut.select(*(F.col(n).alias(c) for c, n in names.items() if c not in ("n_lines", "n_deleted")), F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_deleted"))


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs with later copies cut out of the text and all other columns as they were, but for documents of which nothing is
    left (those without any line from the start stay)."""
    cut, names = _cut(docs, id_col, text_col, min_lines, min_chars)
    return cut.where((F.col("_lines") == 0) | (F.col("_gone") < F.col("_lines"))).select(*(F.col(n).alias(c) for c, n in names.items()))


#: The same in DuckDB's SQL, over the view documents: a line goes if it is long enough and not the first of its kind, or if it
#: is in a pair of neighbouring non-blank lines that is not the first of its kind.
SQL = r"""
WITH doc AS (SELECT DISTINCT doc_id, text FROM documents),
split AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM doc),
lines AS (
  SELECT *, trim(line) AS l, row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS seq FROM split WHERE trim(line) <> ''),
paired AS (SELECT *, lead(l) OVER (PARTITION BY doc_id, text ORDER BY seq) AS nl FROM lines),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id, text, seq) AS nth,
    CASE WHEN nl IS NOT NULL THEN row_number() OVER (PARTITION BY l, nl ORDER BY doc_id, text, seq) END AS pair_nth FROM paired),
judged AS (
  SELECT doc_id, text, pos, (nth > 1 AND length(l) >= 10) OR coalesce(pair_nth, 1) > 1
    OR coalesce(lag(pair_nth) OVER (PARTITION BY doc_id, text ORDER BY seq), 1) > 1 AS gone FROM numbered),
kept AS (
  SELECT s.doc_id, s.text, string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (WHERE NOT coalesce(j.gone, false)) AS new_text,
    count(j.pos) AS n_lines, count(*) FILTER (WHERE j.gone) AS n_deleted
  FROM split s LEFT JOIN judged j ON s.doc_id = j.doc_id AND s.text = j.text AND s.pos = j.pos GROUP BY s.doc_id, s.text)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.new_text, '') END AS text,
  coalesce(k.n_lines, 0)::INT AS n_lines, coalesce(k.n_deleted, 0)::INT AS n_deleted
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
"""

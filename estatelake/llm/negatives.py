"""Hard-negative mining by slots of scores.

An anchor's positives are its best rows of its own label. A positive of score p asks for the best rows of other labels with scores from
``share * p`` up to p, so that the windows of one anchor overlap. Their upper limits, in descending order, split the scores into disjoint
slots: slot j holds what lies above limit j + 1 and not above limit j. A row is in one slot only; the best k of each slot are kept by
every task, and once more over all tasks. Merging the slots from the last to the first, k rows at a time, then answers all windows: the
best k of window j are those of the merged slots j and below, cut at the window's lower limit.

Scores: rows are dealt into blocks of about ``BLOCK_ROWS``, anchors into blocks of about ``BLOCK_ANCHORS``, by a hash of their
place in a stored table, so that no label, id or vector makes a block larger. A pair of blocks is one row: its products are one matrix product, and what leaves it
are the best of each anchor, and slot, only. The anchors are a stated query set (every ``every``-th id) against all rows.

Defined cases: rows without id or label, vectors that are null or hold null or non-finite components take no part; vectors of each length are
scored among themselves, empty ones with 0; rows that repeat an id all count, as anchors and as others, and only an anchor's own row is no other of it; equal
scores go by the smaller id, then by the smaller place; a positive below zero has an empty window; an anchor without positives has no rows; an empty table gives
an empty result; a component of a magnitude of 2^27 / scale or more stops the job (see ``vectors.whole``); extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, lean, staged
from estatelake.llm.vectors import finite, matrix, products, whole

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: A window's lower limit is this part (of 100) of its upper one.
SHARE = 80
BLOCK_ROWS, BLOCK_ANCHORS = 8192, 2048
#: Anchors whose scores are in memory at once.
AT_ONCE = 128

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: An entry of an anchor's list: what it is for (slot), score, id and place of the other row.
FOUND = "anchor bigint, slot int, score bigint, vec_id bigint, place bigint"


def valid_rows(table: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """vec_id, label, v of the rows that take part. Where an id is divisible by 7 the label moves on by one of ten."""
    vec_id, label = table[id_col].cast("bigint"), table[label_col].cast("bigint")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return table.where(vec_id.isNotNull() & label.isNotNull() & finite(table[vec_col])).select(vec_id.alias("vec_id"), moved.alias("label"), whole(table[vec_col], scale).alias("v"))


def in_blocks(rows: DataFrame, size: int, name: str, counts: DataFrame) -> DataFrame:
    """dim, name, {name}_rows: rows in arrays of about ``size``, by a hash of their place. counts: dim, n; a row for each length, of which a table
    of c components can have sqrt(2 c) at most."""
    n = F.ceil(F.col("n") / size).cast("int")
    dealt = rows.join(F.broadcast(counts), "dim").withColumn(name, F.pmod(F.xxhash64("place", F.lit(name)), n).cast("int"))
    held = [c for c in rows.columns if c != "dim"]
    return dealt.groupBy("dim", name).agg(F.collect_list(F.struct(*held)).alias(f"{name}_rows"))


def pairs(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """A row for each pair of a block of rows and a block of anchors of one length. rows, anchors: dim, place, ... Both sides are copied once for each block
    of the other one."""
    lengths = lambda t: t.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    row_counts, anchor_counts = staged(lengths(rows), "row-counts"), staged(lengths(anchors), "anchor-counts")
    per = lambda counts, size, name: counts.select(F.col("dim"), F.ceil(F.col("n") / size).cast("int").alias(name))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = in_blocks(rows, BLOCK_ROWS, "block", row_counts).join(F.broadcast(per(anchor_counts, BLOCK_ANCHORS, "_n")), "dim").withColumn("group", every("_n")).drop("_n")
    right = in_blocks(anchors, BLOCK_ANCHORS, "group", anchor_counts).join(F.broadcast(per(row_counts, BLOCK_ROWS, "_n")), "dim").withColumn("block", every("_n")).drop("_n")
    return left.hint("shuffle_hash").join(right, ["dim", "block", "group"]).select("dim", "block_rows", "group_rows")


def _side(column: pa.ListArray, i: int, dim: int) -> tuple[dict[str, np.ndarray], np.ndarray, pa.StructArray]:
    s = column[i].values
    flat = {n: s.field(n).to_numpy(zero_copy_only=False) for n in ("place", "vec_id", "label")}
    return flat, matrix(s.field("v"), dim), s


def _best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, place: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best of each anchor and slot."""
    order = np.lexsort((place, vec_id, -score, slot, anchor))
    anchor, slot, score, vec_id, place = (x[order] for x in (anchor, slot, score, vec_id, place))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    first = np.flatnonzero(new)
    nth = np.arange(len(anchor)) - np.repeat(first, np.diff(np.append(first, len(anchor))))
    kept = nth < k
    return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (anchor, slot.astype(np.int32), score, vec_id, place)], names=[c.split()[0] for c in FOUND.split(", ")])


def _positives(k: int) -> Task:
    """The k best rows of its label for each anchor of a pair of blocks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, dim in enumerate(batch.column("dim").to_pylist()):
                row, x, _ = _side(batch.column("block_rows"), i, dim)
                asked, q, _ = _side(batch.column("group_rows"), i, dim)
                for a in range(0, len(q), AT_ONCE):
                    of = slice(a, a + AT_ONCE)
                    score = products(q[of], x)
                    r, c = np.nonzero((asked["label"][of, None] == row["label"]) & (asked["place"][of, None] != row["place"]))
                    yield _best(asked["place"][of][r], np.zeros(len(r), np.int32), score[r, c], row["vec_id"][c], row["place"][c], k)

    return task


def _negatives(k: int, share: int) -> Task:
    """The k best rows of other labels for each anchor and slot of a pair of blocks. An anchor's ``limits`` are its positives' scores in
    descending order; of a slot only what reaches its window's own lower limit, the lowest that covers it, can be asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, dim in enumerate(batch.column("dim").to_pylist()):
                row, x, _ = _side(batch.column("block_rows"), i, dim)
                asked, q, s = _side(batch.column("group_rows"), i, dim)
                limits = s.field("limits")
                size = np.diff(limits.offsets.to_numpy())
                most = int(size.max(initial=0))
                # a table of limits, filled up below with a score that nothing falls under
                table = np.full((len(q), most), np.iinfo(np.int64).min)
                flat = limits.flatten().to_numpy(zero_copy_only=False)
                table[np.repeat(np.arange(len(q)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
                for a in range(0, len(q), AT_ONCE):
                    of = slice(a, a + AT_ONCE)
                    score, limit = products(q[of], x), table[of]
                    # a row's slot is the last limit that it does not exceed
                    slot = np.full(score.shape, -1, np.int32)
                    for j in range(most):
                        slot[score <= limit[:, j : j + 1]] = j
                    r, c = np.nonzero((slot >= 0) & (asked["label"][of, None] != row["label"]))
                    j = slot[r, c]
                    wanted = 100 * score[r, c] >= share * limit[r, j]
                    r, c, j = r[wanted], c[wanted], j[wanted]
                    yield _best(asked["place"][of][r], j, score[r, c], row["vec_id"][c], row["place"][c], k)

    return task


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and slot over all tasks."""
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "place")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def merged(slots: DataFrame, k: int) -> DataFrame:
    """anchor, windows: for each slot, from the first, the k best of it and of all below it. One pass from the last slot up; each step
    merges k rows with k. slots: FOUND, with k rows of a slot at most."""
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id", "place")
    lists = slots.groupBy("anchor").agg(F.collect_list(F.struct("slot", entry.alias("e"))).alias("all"), F.max("slot").alias("last"))
    none = F.expr("CAST(array() AS array<struct<minus:bigint,vec_id:bigint,place:bigint>>)")
    start = F.struct(none.alias("best"), F.expr("CAST(array() AS array<array<struct<minus:bigint,vec_id:bigint,place:bigint>>>)").alias("out"))

    def step(acc, j):
        own = F.transform(F.filter("all", lambda x: x["slot"] == j), lambda x: x["e"])
        best = F.slice(F.array_sort(F.concat(acc["best"], own)), 1, k)
        return F.struct(best.alias("best"), F.concat(F.array(best), acc["out"]).alias("out"))

    return lists.select("anchor", F.aggregate(F.sequence(F.col("last"), F.lit(0), F.lit(-1)), start, step)["out"].alias("windows"))


def mine(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = SCALE, every: int = EVERY, positives: int = POSITIVES, k: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    # a stored table, whose places are the same when a task is run again
    rows = staged(valid_rows(table, id_col, vec_col, label_col, scale).withColumn("dim", F.size("v")), "whole-rows").withColumn("place", F.monotonically_increasing_id())
    anchors = rows.where(F.col("vec_id") % every == 0)
    near = _top(pairs(rows, anchors).mapInArrow(lean(_positives(positives)), FOUND), positives)
    near = staged(near.select("anchor", (F.col("nth") - 1).cast("int").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    limits = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("window", "positive_score"))), lambda x: x["positive_score"]).alias("limits"))  # ``positives`` at most
    asked = staged(anchors.join(limits, F.col("place") == F.col("anchor")).drop("anchor"), "limits")
    slots = _top(pairs(rows, asked).mapInArrow(lean(_negatives(k, share)), FOUND), k)
    windows = merged(slots, k).select("anchor", F.posexplode("windows").alias("window", "best"))
    told = near.join(windows, ["anchor", "window"]).join(asked.select(F.col("place").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    inside = F.filter("best", lambda e: -e["minus"] * 100 >= F.col("positive_score") * share)
    out = told.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("_nth", "e"))
    out = staged(out.select("anchor_id", "positive_id", (F.col("_nth") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("negative_id"), "positive_score", (-F.col("e.minus")).alias("negative_score")), "negatives")
    drop_staged(near, asked)
    return out


SQL = f"""WITH r AS MATERIALIZED (SELECT row_number() OVER () AS pos, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.pos AS anchor, a.vec_id AS anchor_id, b.pos, b.vec_id, a.label = b.label AS same, CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score FROM r AS a JOIN r AS b ON a.pos <> b.pos AND len(a.v) = len(b.v) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, pos) AS nth FROM s WHERE same) AS x WHERE nth <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY s.score DESC, s.vec_id, s.pos) AS place
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND {SHARE} * p.score <= 100 * s.score AND s.score <= p.score) AS y WHERE place <= {NEGATIVES}"""

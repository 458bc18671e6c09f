"""Centroid clustering over zone maps along a Hilbert curve.

Vectors are put in the order of a Hilbert curve through all dimensions and cut into blocks of ``BLOCK_ROWS``, each with the box of its
components' least and largest values. A round reads the blocks once: distance bounds of a block's box leave the centroids that can be nearest to
a row of it; where one is left the block goes to it as a whole, by its stored sum, else its rows are compared with those centroids
exactly, all at once. A task sends one row for each cluster and dimension, so that a round brings ``clusters * dim`` sums to the driver, whatever
the table's size. All arithmetic is on whole numbers and exact; ties go to the smaller cluster number. When a round changes no
centroid, later ones would not either, and are left out.

Equal vectors are told apart by their place in a stored table, so that a vector that a third of all rows share is cut into blocks, and dealt to
tasks, like any others.

Defined cases: vectors that are null, of another length, or that hold null or non-finite components take no part; rows without an id
are clustered but start no centroid; a repeated id counts once for each row, and may start as many centroids; fewer rows than clusters give as many
clusters as there are rows with an id; an empty table gives an empty result; a component of a magnitude of 2^27 / scale or more stops the job (see
``vectors.whole``); extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import drop_staged, lean, staged
from estatelake.llm.vectors import EXACT, finite, matrix, whole

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
BLOCK_ROWS = 512
#: Bits of each dimension that the curve looks at.
CURVE_BITS = 2

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve through a grid of 2^bits in each dimension, as bytes that sort like it: the axes are turned into the
    curve's transposed form (Gray code with the reflections undone from the highest bit down), whose bits are then woven."""
    axes = [c.astype(np.int64) for c in x.T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i, axis in enumerate(axes):
            up = (axis & q) != 0
            swap = np.where(up, 0, (axes[0] ^ axis) & low)
            axes[0] = axes[0] ^ np.where(up, low, swap)
            if i:
                axes[i] = axis ^ swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(x), np.int64)
    q = top
    while q > 1:
        flip ^= np.where((axes[-1] & q) != 0, q - 1, 0)
        q >>= 1
    woven = np.stack([((axis ^ flip) >> b) & 1 for b in range(bits - 1, -1, -1) for axis in axes], axis=1)
    return np.packbits(woven.astype(np.uint8), axis=1)


def _on_curve(low: int, high: int, dim: int, bits: int) -> Task:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), dim).astype(np.int64)
            cell = ((x - low) << bits) // (high - low + 1)
            keys = pa.array([k.tobytes() for k in hilbert_keys(cell, bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "key"])

    return task


BLOCKS = "ids array<bigint>, low array<int>, high array<int>, total array<bigint>, rows binary"


def _blocks(dim: int, size: int) -> Task:
    """Rows in the curve's order as blocks: ids, box, sum, and the vectors themselves."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        x = np.ascontiguousarray(matrix(t.column("v"), dim).astype(np.int32))
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
        ids = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), t.column("vec_id").combine_chunks())
        return pa.RecordBatch.from_arrays([ids, one(x.min(axis=0), pa.int32()), one(x.max(axis=0), pa.int32()), one(x.sum(axis=0, dtype=np.int64), pa.int64()), pa.array([x.tobytes()], pa.binary())], names=[c.split()[0] for c in BLOCKS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, size - n)
                held.append(piece)
                at, n = at + piece.num_rows, n + piece.num_rows
                if n == size:
                    yield pack(held)
                    held, n = [], 0
        if n:
            yield pack(held)

    return task


def zone_map(vectors: DataFrame, dim: int = DIM, bits: int = CURVE_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks (BLOCKS) of vectors (vec_id, v: array<int> of one length), staged."""
    rows = staged(vectors.select("vec_id", "v"), "whole-vectors")
    least, most = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if least is None:
        return staged(rows.sparkSession.createDataFrame([], BLOCKS), "zone-map")
    # the place in a stored table tells equal vectors apart, and is the same when a task is run again
    placed = rows.withColumn("_at", F.monotonically_increasing_id())
    keyed = placed.mapInArrow(lean(_on_curve(least, most, dim, bits)), "vec_id bigint, v array<int>, _at bigint, key binary")
    keyed = staged(keyed, "curve-keys")
    out = staged(keyed.repartitionByRange("key", "_at").sortWithinPartitions("key", "_at").mapInArrow(lean(_blocks(dim, block_rows)), BLOCKS), "zone-map")
    drop_staged(rows, keyed)
    return out


def candidates(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a point of the box, ties by number. First by the least and largest distance from
    the box; then one is left out if the one with the best bound is nearer everywhere in the box (the difference of the two squared
    distances is linear, so that its largest value is at a corner)."""
    low, high, centres = low.astype(np.int64), high.astype(np.int64), centres.astype(np.int64)
    near = (np.maximum(np.maximum(low - centres, centres - high), 0) ** 2).sum(axis=1)
    far = (np.maximum(np.abs(low - centres), np.abs(high - centres)) ** 2).sum(axis=1)
    best = int(np.argmin(far))
    left = np.flatnonzero(near <= far[best])
    slope = -2 * (centres[best] - centres[left])
    squares = (centres**2).sum(axis=1)
    gap = squares[best] - squares[left] + np.maximum(slope * low, slope * high).sum(axis=1)
    return left[(gap > 0) | ((gap == 0) & (left <= best))]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, and its squared distance, both exact."""
    most = int(max(np.abs(x).max(initial=0), np.abs(centres).max(initial=0)))
    if 4 * most * most * x.shape[1] < EXACT:
        a, b = x.astype(np.float64), centres.astype(np.float64)
        d = ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    else:
        a = x.astype(np.int64)
        d = np.stack([((a - c) ** 2).sum(axis=1) for c in centres.astype(np.int64)], axis=1)
    which = np.argmin(d, axis=1)  # the first of equal ones
    return which, d[np.arange(len(d)), which]


def _each(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row of the batch, lows, highs and vectors of each block."""
    low, high, rows = matrix(batch.column("low"), dim), matrix(batch.column("high"), dim), batch.column("rows")
    for i in range(batch.num_rows):
        yield i, low[i], high[i], np.frombuffer(rows[i].as_buffer(), np.int32).reshape(-1, dim)


def _sums(centres: np.ndarray) -> Task:
    """Count and sum of each cluster over a task's blocks, a row for each cluster and dimension."""
    k, dim = centres.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            sums = matrix(batch.column("total"), dim)
            for i, low, high, x in _each(batch, dim):
                near = candidates(low, high, centres)
                if len(near) == 1:
                    count[near[0]] += len(x)
                    total[near[0]] += sums[i]
                    continue
                which = near[nearest(x, centres[near])[0]]
                count += np.bincount(which, minlength=k)
                for c in near:
                    total[c] += x[which == c].sum(axis=0, dtype=np.int64)
        c, d = np.divmod(np.arange(k * dim), dim)
        if count.any():
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(count[c]), pa.array(total.reshape(-1))], names=["cluster", "dim", "n", "total"])

    return task


def _assigned(centres: np.ndarray) -> Task:
    dim = centres.shape[1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, low, high, x in _each(batch, dim):
                near = candidates(low, high, centres)
                which, distance = nearest(x, centres[near])
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(near[which].astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return task


def update(blocks: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of each that has vectors."""
    dim = centres.shape[1]
    sums = blocks.select("low", "high", "total", "rows").mapInArrow(lean(_sums(centres)), "cluster int, dim int, n bigint, total bigint")
    out = centres.copy()
    for r in sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():  # clusters * dim at most
        if r.n:
            out[r.cluster, r.dim] = r.total // r.n
    assert out.shape[1] == dim
    return out


def first_centres(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the least sha256 of ``seed:id``, in that order; equal ids go by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def cluster(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector that takes part."""
    spark = table.sparkSession
    v = table[vec_col]
    kept = table.where((F.size(v) == dim) & finite(v)).select(table[id_col].cast("bigint").alias("vec_id"), whole(v, scale).alias("v"))
    blocks = zone_map(kept, dim)
    centres = first_centres(kept, k, seed)
    if not len(centres):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        before, centres = centres, update(blocks, centres)
        if np.array_equal(before, centres):
            break
    rows = staged(blocks.select("ids", "low", "high", "rows").mapInArrow(lean(_assigned(centres)), "vec_id bigint, cluster int, distance bigint"), "assigned")
    drop_staged(blocks)
    sums = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum("distance")).collect()}  # k at most
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centres]
    told = spark.createDataFrame([(c, s, sum(sums.values()), digest[c]) for c, s in sums.items()], "_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(told), F.col("cluster") == F.col("_cluster")).drop("_cluster")


def _rounds() -> str:
    """The rounds in SQL, one after the other."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT pos, c, d FROM (SELECT pos, c, d, row_number() OVER (PARTITION BY pos ORDER BY d, c) AS place FROM (SELECT k.pos, m.c, CAST(list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM k, m{i} AS m) AS x) AS y WHERE place = 1)")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (SELECT c, list(q ORDER BY j) AS v FROM (SELECT c, j, CAST((total - ((total % n) + n) % n) // n AS BIGINT) AS q FROM (SELECT a.c, j, CAST(sum(k.v[j]) AS BIGINT) AS total, count(*) AS n FROM a{i} AS a JOIN k ON a.pos = k.pos, range(1, {DIM + 1}) AS r(j) GROUP BY a.c, j) AS t) AS u GROUP BY c),
m{i + 1} AS MATERIALIZED (SELECT m.c, coalesce(s.v, m.v) AS v FROM m{i} AS m LEFT JOIN s{i} AS s ON m.c = s.c)""")
    return ",\n".join(steps)


SQL = f"""WITH k AS MATERIALIZED (SELECT row_number() OVER () AS pos, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256(concat('{SEED}:', CAST(vec_id AS VARCHAR))) AS h, v FROM k WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CLUSTERS}) AS x),
{_rounds()}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} AS a JOIN k ON a.pos = k.pos JOIN m{ROUNDS} AS m ON a.c = m.c"""

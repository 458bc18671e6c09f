"""Approximate nearest neighbours: inverted file with product-quantised residuals and exact reranking.

Fitting takes a bounded sample (``FIT_ROWS`` vectors and ``FIT_VALUES`` numbers at most, by a hash of the row): k-means gives coarse
centroids, and k-means in each of ``PARTS`` slices of the residuals gives the codebooks. Every row is
indexed: its nearest centroid and one code byte for each slice.

Queries go to their best lists, as many as the sample says the recall needs, and to more if these hold fewer rows than are asked for.
Neighbouring lists are put together in cells of about ``BLOCK_ROWS`` rows, and a query goes to each cell once, with the numbers of the
lists that it probes there. The rows and the queries of a cell are cut into blocks (``BLOCK_ROWS``, ``QUERY_BLOCK``), each pair of which
is a group of its own, so that a list with a third of all vectors is many tasks of bounded size. In a group all queries are
answered at once: one table of inner products of query slices with codewords for each query, summed over codes by lookup, plus the
product with the centroid, for rows of the lists that the query probes. Rows that
may reach the query's floor by these products and the codes' known error, however many, are reranked exactly in double
precision on the original vectors. The floor is the k-th best product of the query with a small part of the sample, which its k
nearest cannot fall below. A query that finds fewer than it asks for looks again, in all lists and without a floor. Ties are cut by
smaller id everywhere.

Recall: on data without any structure (the test tables are uniform on a sphere) an inverted file must read a large share of the rows;
``TUNED_RECALL`` is set for about half of them there.

Nearness is the inner product. Defined cases: vectors that are null, empty, zero, without an id, or that hold null or non-finite
components take no part; vectors of each length are searched among themselves; rows that repeat an id all count, as queries and as
candidates, and only a query's own row is no candidate of it; fewer candidates than asked for give all there are; an empty table
gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, lean, staged
from estatelake.llm.jaccard import groups_of

FIT_ROWS, FIT_VALUES, ROUNDS = 20_000, 1 << 22, 8
#: Coarse centroids: one for so many rows, within these bounds, and one for LEAST_IN_SAMPLE rows of the sample at most.
LIST_ROWS, LEAST_LISTS, MOST_LISTS, LEAST_IN_SAMPLE = 8, 8, 4096, 6
PARTS, CODEWORDS = 32, 256
#: Probes are set so that on the sample (up to TUNE_QUERIES of it ask for their nearest) this share of neighbours is in a probed list.
TUNED_RECALL, TUNE_QUERIES, LEAST_PROBES = 0.93, 400, 4
#: Rows of the sample that give a query its floor, a quarter of all rows at most.
FLOOR_ROWS = 2048
BLOCK_ROWS, QUERY_BLOCK = 4096, 2048
QUERY_EVERY, NEAREST = 20, 20


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct rows; empty clusters take the row worst served."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[: min(k, len(distinct))]].astype(np.float64)
    for _ in range(ROUNDS):
        near = nearest(x, centres)
        count = np.bincount(near, minlength=len(centres)).astype(np.float64)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        used = count > 0
        centres[used] = sums[used] / count[used, None]
        if not used.all():
            worst = np.argsort(-((x - centres[near]) ** 2).sum(axis=1), kind="stable")
            centres[~used] = x[worst[: int((~used).sum())]]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid (Euclid) of each row."""
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 8192] @ centres.T - half, axis=1) for i in range(0, len(x), 8192)]) if len(x) else np.zeros(0, np.int64)


@dataclass
class Index:
    """Coarse centroids, and the codebooks by slice of the dimensions."""

    centres: np.ndarray
    books: list[np.ndarray]
    cuts: list[int]
    probes: int = 1
    #: Nearly all of the sample lie nearer than this to what their codes stand for.
    error: float = 0.0

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        which = nearest(x, self.centres)
        rest = x - self.centres[which]
        codes = np.stack([nearest(rest[:, a:b], book) for book, a, b in zip(self.books, self.cuts, self.cuts[1:], strict=False)], axis=1)
        return which, codes.astype(np.uint8)

    def scores(self, queries: np.ndarray, lists: np.ndarray, of: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Approximate inner products, queries x rows; row i is in lists[of[i]]."""
        out = (queries @ self.centres[lists].T)[:, of]
        for p, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:], strict=False)):
            out += (queries[:, a:b] @ book.T)[:, codes[:, p]]
        return out

    def cells(self, sizes: np.ndarray) -> np.ndarray:
        """The cell of each list: lists in the order of coarser clusters, cut after about BLOCK_ROWS rows."""
        near = nearest(self.centres, kmeans(self.centres, int(max(1, sizes.sum() // BLOCK_ROWS)), 99))
        order = np.lexsort((np.arange(len(near)), near))
        out = np.zeros(len(near), np.int32)
        out[order] = (np.cumsum(sizes[order]) - sizes[order]) // BLOCK_ROWS
        return out


def fit_index(vectors: DataFrame, rows: int, dim: int) -> tuple[Index, np.ndarray]:
    """The index, and the rows of its sample that give floors. vectors: row, v (array<double>, valid)."""
    n = min(FIT_ROWS, max(1, FIT_VALUES // dim))
    x = _matrix(vectors.orderBy(F.xxhash64("row"), "row").limit(n).select("v").toArrow().column("v"), dim)
    k = int(max(1, min(MOST_LISTS, max(LEAST_LISTS, rows / LIST_ROWS), max(LEAST_LISTS, len(x) / LEAST_IN_SAMPLE), len(x))))
    centres = kmeans(x, k, 1)
    rest = x - centres[nearest(x, centres)]
    parts = min(PARTS, dim)
    cuts = [round(i * dim / parts) for i in range(parts + 1)]
    books = [kmeans(rest[:, a:b], CODEWORDS, 2 + i) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    # once over the sample's distinct vectors and once over its rows, of which a repeated vector may be many
    index = Index(centres, books, cuts, max(tuned_probes(some, centres) for some in (_once(x), x)))
    which, codes = index.encode(x)
    told = centres[which] + np.concatenate([book[codes[:, p]] for p, book in enumerate(books)], axis=1)
    index.error = float(np.quantile(np.linalg.norm(x - told, axis=1), 0.99)) if len(x) else 0.0
    return index, x[: min(FLOOR_ROWS, rows // 4)]


def _once(x: np.ndarray) -> np.ndarray:
    return x[np.sort(np.unique(x, axis=0, return_index=True)[1])]


def tuned_probes(x: np.ndarray, centres: np.ndarray) -> int:
    """How many lists a query must probe. Nearest neighbours in the whole table are nearer than those in the
    sample, so that the sample's share is a cautious one."""
    which, queries = nearest(x, centres), x[:TUNE_QUERIES]
    products = queries @ x.T
    products[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = np.argsort(-products, axis=1, kind="stable")[:, : min(NEAREST, max(1, len(x) - 1))]
    place = np.argsort(np.argsort(-(queries @ centres.T), axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.sort(np.take_along_axis(place, which[near], axis=1).reshape(-1)) + 1
    return int(max(LEAST_PROBES, needed[min(len(needed) - 1, int(TUNED_RECALL * len(needed)))])) if len(needed) else LEAST_PROBES


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v: usable vectors in double precision, a row for each."""
    v = table.select(table[id_col].cast("long").alias("vec_id"), table[vec_col].cast("array<double>").alias("v"))
    usable = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return v.where(F.coalesce(usable, F.lit(False)))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _encode(index: Index, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, codes = index.encode(_matrix(batch.column("v"), dim))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(which.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], names=["row", "list", "code"])

    return task


QUERIES = "cell int, lists array<int>, row long, vec_id long, floor double, v array<double>"


def _probe(index: Index, sizes: np.ndarray, cells: np.ndarray, floors: np.ndarray | None, dim: int, probes: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each query with its floor, once for each cell with lists that it probes: those whose centroids have the largest products with
    it, as many as ``probes`` and until they hold k rows besides the query."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                q = _matrix(batch.column("v"), dim)
                floor = np.full(len(q), -np.inf)
                if floors is not None and len(floors) > k + 1:
                    # one more than k, since the query itself may be in the sample
                    floor = np.partition(q @ floors.T, len(floors) - k - 1, axis=1)[:, len(floors) - k - 1]
                best = np.argsort(-(q @ index.centres.T), axis=1, kind="stable").astype(np.int32)
                held = np.cumsum(sizes[best], axis=1)
                need = np.maximum(probes, 1 + np.argmax(held >= min(k + 1, sizes.sum()), axis=1))
                row = np.repeat(np.arange(len(q)), need)
                lists = best[row, np.arange(len(row)) - np.repeat(np.cumsum(need) - need, need)]
                order = np.lexsort((lists, cells[lists], row))
                row, lists = row[order], lists[order]
                cell = cells[lists]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])]))
                offsets = np.append(first, len(row)).astype(np.int32)
                at = pa.array(row[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[first]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists)), batch.column("row").take(at), batch.column("vec_id").take(at), pa.array(floor[row[first]]), batch.column("v").take(at)],
                    names=[x.split()[0] for x in QUERIES.split(", ")],
                )

    return task


FOUND = "q_row long, query_id long, vec_id long, row long, score double"


def _search(index: Index, dim: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each block of a cell, the k best rows at most for each query of a block of queries, with exact products."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups_of(batches, ["cell", "block", "q_block"]):
            is_query = g.column("is_query").to_numpy()
            queries, rows = g.filter(pa.array(is_query)), g.filter(pa.array(~is_query))
            if not queries.num_rows or not rows.num_rows:
                continue
            row, vec_id = rows.column("row").to_numpy(), rows.column("vec_id").to_numpy()
            order = np.lexsort((row, vec_id))  # in id order, so that ties are cut by id
            row, vec_id = row[order], vec_id[order]
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, -1)[order]
            columns = np.ascontiguousarray(_matrix(rows.column("v"), dim)[order].T)
            lists, of = np.unique(rows.column("lists").combine_chunks().flatten().to_numpy()[order], return_inverse=True)
            q_row, query_id, floor, q = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy(), queries.column("floor").to_numpy(), _matrix(queries.column("v"), dim)
            asked = queries.column("lists").combine_chunks()
            place = np.searchsorted(lists, asked.flatten().to_numpy())
            here = lists[np.minimum(place, len(lists) - 1)] == asked.flatten().to_numpy()
            probed = np.zeros((len(q), len(lists)), bool)
            probed[np.repeat(np.arange(len(q)), np.diff(asked.offsets.to_numpy()))[here], place[here]] = True
            for a in range(0, len(q), 128):
                some = q[a : a + 128]
                told = index.scores(some, lists, of, codes)
                # by how much codes misjudge a product: that of the error's length along the query, three deviations
                slack = 3 * index.error * np.linalg.norm(some, axis=1) / dim**0.5
                i, j = np.nonzero((told >= (floor[a : a + 128] - slack)[:, None]) & probed[a : a + 128][:, of] & (q_row[a : a + 128, None] != row[None, :]))
                for start in range(0, max(1, len(i)), 1 << 18):
                    yield best_of(q_row, query_id, row, vec_id, a + i[start : start + (1 << 18)], j[start : start + (1 << 18)], q, columns, k)

    return task


def best_of(q_row: np.ndarray, query_id: np.ndarray, row: np.ndarray, vec_id: np.ndarray, i: np.ndarray, j: np.ndarray, q: np.ndarray, columns: np.ndarray, k: int) -> pa.RecordBatch:
    """Exact products of the pairs of query i and row j, and the k best of each query."""
    exact = np.zeros(len(i))
    for d in range(len(columns)):
        exact += q[i, d] * columns[d, j]
    order = np.lexsort((j, -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
    i, j, exact = (x[place < k] for x in (i, j, exact))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (q_row[i], query_id[i], vec_id[j], row[j], exact)], names=["q_row", "query_id", "vec_id", "row", "score"])


def _meet(rows: DataFrame, queries: DataFrame, index: Index, dim: int, k: int) -> DataFrame:
    """The k best of each query (FOUND) among the rows of its lists. Cells are cut by a hash into blocks of rows and of queries, so that no
    group has much more than BLOCK_ROWS and QUERY_BLOCK of them."""
    blocks = lambda t, size, name: t.groupBy(F.col("cell").alias("_cell")).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    cut = blocks(rows, 2 * BLOCK_ROWS, "blocks").join(blocks(queries, QUERY_BLOCK, "q_blocks"), "_cell")
    cut = F.broadcast(staged(cut, "cell-blocks"))  # a row for each cell, MOST_LISTS at most
    own = lambda n: F.pmod(F.xxhash64("row", F.lit("block")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    on = F.col("cell") == F.col("_cell")
    left = rows.join(cut, on).select("cell", own("blocks").alias("block"), every("q_blocks").alias("q_block"), F.lit(False).alias("is_query"), "row", "vec_id", F.lit(None).cast("double").alias("floor"), F.array("list").alias("lists"), "code", "v")
    right = queries.join(cut, on).select("cell", every("blocks").alias("block"), own("q_blocks").alias("q_block"), F.lit(True).alias("is_query"), "row", "vec_id", "floor", "lists", F.lit(None).cast("binary").alias("code"), "v")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = "cell", "block", "q_block"
    found = left.unionByName(right).repartition(n, *key).sortWithinPartitions(*key).mapInArrow(lean(_search(index, dim, k)), FOUND)
    rank = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row"))
    return staged(found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k), "neighbours")


def _of_length(vectors: DataFrame, n: int, dim: int, every: int, k: int) -> DataFrame:
    """q_row, query_id, rank, vec_id, score among the n vectors of one length."""
    index, floors = fit_index(vectors, n, dim)
    probes = min(len(index.centres), index.probes)
    coded = staged(vectors.select("row", "v").mapInArrow(lean(_encode(index, dim)), "row long, list int, code binary"), "codes")
    sizes = np.zeros(len(index.centres), np.int64)
    for r in coded.groupBy("list").count().collect():  # MOST_LISTS at most
        sizes[r[0]] = r[1]
    cells = index.cells(sizes)
    cell_of = vectors.sparkSession.createDataFrame(list(enumerate(cells.tolist())), "_list int, cell int")
    rows = coded.join(F.broadcast(cell_of), F.col("list") == F.col("_list")).drop("_list").join(vectors, "row")
    asked = vectors.where(F.col("vec_id") % every == 0)
    queries = staged(asked.mapInArrow(lean(_probe(index, sizes, cells, floors, dim, probes, k)), QUERIES), "queries")
    found = _meet(rows, queries, index, dim, k)
    drop_staged(queries)
    enough = found.groupBy(F.col("q_row").alias("_row")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, n - 1))
    short = staged(asked.join(enough, F.col("row") == F.col("_row"), "left_anti"), "short-queries")
    if n == 1 or short.isEmpty():
        return found
    again = _meet(rows, short.mapInArrow(lean(_probe(index, sizes, cells, None, dim, len(index.centres), k)), QUERIES), index, dim, k)
    return found.join(short.select(F.col("row").alias("_row")), F.col("q_row") == F.col("_row"), "left_anti").unionByName(again)


def nearest_neighbours(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = QUERY_EVERY, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id is divisible by ``every``."""
    spark = table.sparkSession
    usable = staged(valid_vectors(table, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = sorted(usable.groupBy(F.size("v").alias("dim")).count().collect())  # a row for each length
    found = [_of_length(usable.where(F.size("v") == dim) if len(sizes) > 1 else usable, n, dim, every, k) for dim, n in sizes]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found).select("query_id", "rank", "vec_id", "score")

"""N-gram Jaccard join by chosen paths.

Sets of five-word shingles are joined at Jaccard similarity ``THRESHOLD``:

1. Documents with the same set fall into one class (one pre-aggregated shuffle of digests). The
   following works on one set of each class, so that exact copies cost nothing more.
2. Chosen paths: every run draws positions of the MinHash sketch, each with probability 1 / (threshold
   x positions), and a set goes into a bucket for each drawn position by the token there. Buckets of one
   set end. Large buckets are split again and again by newly drawn positions; small ones, and what is
   left at the greatest depth, are compared by brute force on sketches. In a leaf that is still large, sets are first held
   against its centre, the commonest value at each position among some of its sets: those like it form one group and need no
   comparison among themselves, the rest is compared with all, in blocks. The number of runs follows from the target recall.
3. What looks alike by sketch is put into groups (connected components). Each pair of a small group is compared exactly
   once on the full shingle sets. A large group is described by its centre, the shingles of more than half of its sets: of each
   set only the difference x to the centre is kept. With f = (1 + t) |x| - (1 - t) |set|, two sets are linked if and only if
   the sum of their f is at most 2 (1 + t) times what their differences share. So all pairs with a sum of 0 or less are links,
   which are counted by adding up a histogram of f, without looking at any pair; a sum that is larger than the
   smaller difference allows is none; and only blocks of sets (cut in the order of f) with pairs in between meet and are
   compared on their differences. No pair is written out: a task returns for each set its links' weight and a spanning forest.
4. Linked classes form components, again by joins.

A pair is lost only if no run brings it together and no chain of similar sets does: with ``RECALL`` =
0.9999 at exactly the threshold, less above it. Links that are found are exact (64-bit shingle hashes).

At scale: M near copies of one text cost rows in proportion to M, in leaves and in groups. What can still grow faster is a
group of thousands of sets far from their centre, of which many pairs are close to the threshold: their blocks meet in pairs.

Defined cases: ids are whole numbers (others are cast, what is no number counts as null); null counts as empty; a text without
words has no links and is its own class; a row without an id takes part and gets the least id of its class; repeated
rows count as documents of one class; very long texts are hashed in pieces; an empty table gives an
empty result; extra columns are ignored by ``jaccard_classes`` and kept by ``one_of_each``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, lean, slices, staged
from estatelake.llm.components import components
from estatelake.llm.shingles import Sketcher, mix, set_id, shingle_sets

THRESHOLD, POSITIONS, RECALL = 0.8, 128, 0.9999
#: Buckets above SMALL sets are split again, at most MAX_DEPTH times in all.
SMALL, MAX_DEPTH = 64, 3
#: Sets of a block, when sketches or differences are compared, and shingles of a block; groups of no more are compared at once.
SKETCH_BLOCK, SET_BLOCK, BLOCK_SHINGLES = 512, 256, 4 << 20
#: Sets of a large leaf that give its centre.
PIVOTS = 64
#: Up to so many bytes of pivots and of centres are sent to all tasks; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Sketches of pairs at the threshold agree in threshold x positions places, give or take 0.035 x positions; four of these less.
ALIKE = 0.66
#: Up to so many sets that are like others are sent to all tasks as ids (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000


def survival(depth: int) -> float:
    """Probability that a pair at the threshold shares a path of this depth in one run."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return q


def runs_for(recall: float = RECALL, depth: int = MAX_DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


def _drawn(path: np.ndarray, positions: int, threshold: float) -> np.ndarray:
    """Which positions a path draws: path numbers x positions, booleans."""
    with np.errstate(over="ignore"):
        coins = mix(path[:, None] * np.uint64(2 * positions + 1) + np.arange(positions, dtype=np.uint64) + np.uint64(77))
    return coins < np.uint64(int(2.0**64 / (threshold * positions)))


def _child(path: np.ndarray, position: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(path ^ mix((position.astype(np.uint64) << np.uint64(32)) + token.astype(np.uint64)))


def _binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


# -- tasks ----------------------------------------------------------------------------------------

SETS = "doc_id long, digest long, sid binary, n int, sketch binary"


def _sets(positions: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(positions)
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = shingle_sets(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("digest"), _binary([set_id(s) for s in sets]), pa.array([len(s) for s in sets], pa.int32()), _binary([sketch(s).tobytes() if len(s) else None for s in sets])],
                    names=["doc_id", "digest", "sid", "n", "sketch"],
                )

    return task


def _first_paths(runs: int, positions: int, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        run, position = np.nonzero(_drawn(start, positions, threshold))
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, positions)[:, position]
            keys = _child(start[run][None, :], position[None, :], tokens)
            rid = np.repeat(batch.column("rid").to_numpy(), len(run))
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(keys.reshape(-1).view(np.int64))], names=["rid", "path"])

    return task


def _next_paths(positions: int, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, positions)
            paths = batch.column("path").to_numpy().view(np.uint64)
            distinct, of = np.unique(paths, return_inverse=True)
            row, position = np.nonzero(_drawn(distinct, positions, threshold)[of])
            keys = _child(paths[row], position, tokens[row, position])
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("rid").to_numpy()[row]), pa.array(keys.view(np.int64))], names=["rid", "path"])

    return task


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Neighbouring rows of equal keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            held_key = key
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _edges(us: list[np.ndarray], vs: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def _moved(rid: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest, from each node to its root."""
    root = np.array([forest.find(i) for i in range(len(rid))])
    moved = root != np.arange(len(rid))
    return rid[moved], rid[root[moved]]


def _sketches(column: pa.ChunkedArray | pa.Array, positions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, positions)


def _spelt_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each path of a set, with its sketch."""
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            paths = batch.column("paths")
            at = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(paths.offsets.to_numpy())))
            yield pa.RecordBatch.from_arrays([batch.column("rid").take(at), paths.flatten(), batch.column("sketch").take(at)], names=["rid", "path", "sketch"])


def _compare_sketches(positions: int, alike: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning forests of small leaves, each of one block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = math.ceil(alike * positions)
        us: list[np.ndarray] = []
        vs: list[np.ndarray] = []
        for g in groups_of(batches, ["path"]):
            m = _sketches(g.column("sketch"), positions)
            forest = Forest(len(m))
            for i in range(len(m) - 1):
                for j in (np.flatnonzero((m[i + 1 :] == m[i]).sum(axis=1) >= least) + i + 1).tolist():
                    forest.join(i, j)
            u, v = _moved(g.column("rid").to_numpy(), forest)
            if len(u):
                us.append(u)
                vs.append(v)
            if len(us) >= 1000:
                yield _edges(us, vs)
                us, vs = [], []
        if us:
            yield _edges(us, vs)

    return task


def _centre(sketches: np.ndarray) -> np.ndarray:
    """The commonest value at each position."""
    out = []
    for column in sketches.T:
        values, counts = np.unique(column, return_counts=True)
        out.append(values[counts.argmax()])
    return np.array(out, np.uint32)


def _attach(positions: int, alike: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each set of a large leaf whether it is like the leaf's centre, and the set that stands for the centre (the pivot that is
    most like it). Any centre is right, since whatever is not like it is compared with all; a good one leaves little to compare."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = math.ceil(alike * positions)
        known: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, m = batch.column("path").to_numpy(), _sketches(batch.column("sketch"), positions)
            to, main = np.full(len(m), -1, np.int64), np.zeros(len(m), bool)
            for path in np.unique(paths).tolist():
                rows = np.flatnonzero(paths == path)
                if path not in known:
                    if len(known) > 1000:
                        known.clear()
                    pivots = sorted(batch.column("pivots")[int(rows[0])].as_py(), key=lambda p: p["rid"])
                    sketch = _sketches(pa.array([p["sketch"] for p in pivots]), positions)
                    centre = _centre(sketch)
                    known[path] = centre, pivots[int((sketch == centre).sum(axis=1).argmax())]["rid"]
                centre, rid = known[path]
                main[rows] = (m[rows] == centre).sum(axis=1) >= least
                to[rows] = np.where(main[rows], rid, -1)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("path"), batch.column("m"), pa.array(to), pa.array(main)], names=["rid", "path", "m", "pivot", "main"])

    return task


def _compare_rest(positions: int, alike: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A block of all sets of a large leaf (side 0) against a block of those outside its main cluster (side 1)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = math.ceil(alike * positions)
        for g in groups_of(batches, ["path", "b1", "b2"]):
            m, rid, side = _sketches(g.column("sketch"), positions), g.column("rid").to_numpy(), g.column("side").to_numpy()
            every, rest = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(every):
                continue
            forest = Forest(len(m))
            for i in rest.tolist():
                for j in every[(m[every] == m[i]).sum(axis=1) >= least].tolist():
                    forest.join(i, j)
            u, v = _moved(rid, forest)
            if len(u):
                yield _edges([u], [v])

    return task


def _candidate_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the named texts; of rows that repeat one of them, one for each task."""
    seen: set[int] = set()
    for whole in batches:
        fresh = [not (r in seen or seen.add(r)) for r in whole.column("rid").to_pylist()]
        whole = whole.filter(pa.array(fresh, pa.bool_()))
        for batch in slices(whole, "text"):
            sets = shingle_sets(batch.column("text").to_pylist())
            right = [set_id(s) == sid for s, sid in zip(sets, batch.column("sid").to_pylist(), strict=True)]
            kept = ("rid", "size", "root", "m", "large")
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), _binary([s.tobytes() for s in sets])], names=[*kept, "shingles"])
            yield out.filter(pa.array(right, pa.bool_()))


def _common(parts: list[np.ndarray]) -> Callable[[int, np.ndarray], np.ndarray]:
    """A function of i and others: how many elements parts[i] shares with each of the others."""
    n = np.array([len(p) for p in parts])
    _, flat = np.unique(np.concatenate(parts), return_inverse=True)
    begin = np.cumsum(n) - n
    local = np.split(flat, begin[1:])
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 1, np.uint8)

    def common(i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), np.int64)
        some = np.flatnonzero(n[others])
        if len(some):
            mark[local[i]] = 1
            sizes = n[others[some]]
            out[some] = np.add.reduceat(mark[np.concatenate([local[j] for j in others[some]])].astype(np.int64), np.cumsum(sizes) - sizes)
            mark[local[i]] = 0
        return out

    return common


LINKS = "rid long, root long, weight long"


def _links(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["rid", "root", "weight"])


def _linked_pairs(batches: Iterator[pa.RecordBatch], keys: list[str], read: Callable[[pa.Table], tuple[list[np.ndarray], np.ndarray | None, Callable]]) -> Iterator[pa.RecordBatch]:
    """Weights and forests of groups of neighbouring rows. ``read`` gives a group's arrays, the two sides (or None) and which of
    some others, with so many elements in common, are linked with i."""
    found = []
    for g in groups_of(batches, keys):
        _, once = np.unique(g.column("rid").to_numpy(), return_index=True)  # repeated rows of one document
        g = g.take(pa.array(once))
        rid, size = g.column("rid").to_numpy(), g.column("size").to_numpy()
        parts, side, judge = read(g)
        common = _common(parts)
        every = np.arange(len(rid))
        left, right = (every, every) if side is None else (every[side == 0], every[side == 1])
        forest, weight = Forest(len(rid)), np.zeros(len(rid), np.int64)
        for i in left.tolist():
            others = judge(i, right[right > i] if side is None else right, None)
            if len(others):
                linked = judge(i, others, common(i, others))
                weight[i] += size[linked].sum()
                weight[linked] += size[i]
                for j in linked.tolist():
                    forest.join(i, j)
        hit = np.flatnonzero(weight)
        if len(hit):
            found.append((rid[hit], rid[[forest.find(i) for i in hit.tolist()]], weight[hit]))
        if len(found) >= 1000:
            yield _links(found)
            found = []
    if found:
        yield _links(found)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(s.as_py(), np.uint64) for s in column]


def _compare_sets(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All pairs of a small group, on full sets."""

    def read(g: pa.Table) -> tuple[list[np.ndarray], None, Callable]:
        sets = _arrays(g.column("shingles"))
        n = np.array([len(s) for s in sets])

        def judge(i: int, others: np.ndarray, common: np.ndarray | None) -> np.ndarray:
            if common is None:  # sets of too different sizes cannot reach the threshold
                return others[np.minimum(n[others], n[i]) >= threshold * np.maximum(n[others], n[i]) - 1e-9]
            # exact in integers: common / union >= threshold
            return others[common * 1000 >= round(threshold * 1000) * (n[others] + n[i] - common)]

        return sets, None, judge

    return lambda batches: _linked_pairs(batches, ["root"], read)


def _shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "shingles"):
            roots = batch.column("root").to_numpy()
            for root in np.unique(roots).tolist():
                rows = batch.filter(pa.array(roots == root))
                h, n = np.unique(np.concatenate(_arrays(rows.column("shingles"))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), root)), pa.array(h.view(np.int64)), pa.array(n)], names=["root", "h", "n"])


DIFFS = "rid long, size long, root long, f long, k int, diff binary"


def _differences(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each set's difference to its centre; f in thousandths."""
    t = round(threshold * 1000)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, centre = None, np.zeros(0, np.uint64)
        for whole in batches:
            for batch in slices(whole, "shingles"):
                f, k, diff = [], [], []
                for root, s, c in zip(batch.column("root").to_pylist(), _arrays(batch.column("shingles")), batch.column("centre"), strict=True):
                    if root != held:
                        held, centre = root, np.sort(c.values.to_numpy().view(np.uint64)) if c.is_valid else np.zeros(0, np.uint64)
                    x = np.setxor1d(s, centre, assume_unique=True)
                    f.append((1000 + t) * len(x) - (1000 - t) * len(s))
                    k.append(len(x))
                    diff.append(x.tobytes())
                columns = [*(batch.column(c) for c in ("rid", "size", "root")), pa.array(f, pa.int64()), pa.array(k, pa.int32()), _binary(diff)]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "size", "root", "f", "k", "diff"])

    return task


def _compare_differences(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs of two blocks (or of one) that f leaves open."""
    t = round(threshold * 1000)

    def read(g: pa.Table) -> tuple[list[np.ndarray], np.ndarray | None, Callable]:
        f, k = g.column("f").to_numpy(), g.column("k").to_numpy().astype(np.int64)

        def judge(i: int, others: np.ndarray, common: np.ndarray | None) -> np.ndarray:
            total = f[others] + f[i]
            shared = np.minimum(k[others], k[i]) if common is None else common
            return others[(total > 0) & (total <= 2 * (1000 + t) * shared)]

        same = g.column("b1")[0].as_py() == g.column("b2")[0].as_py()
        return _arrays(g.column("diff")), None if same else g.column("side").to_numpy(), judge

    return lambda batches: _linked_pairs(batches, ["root", "b1", "b2"], read)


# -- the job --------------------------------------------------------------------------------------


def _buckets(paths: DataFrame, last: bool) -> DataFrame:
    """path, m (sets in it) of buckets with two sets or more; of leaves with the same sets one stays. Buckets that are still to
    be split all stay, whatever they hold: each path draws anew, and the runs count as independent tries."""
    counted = paths.groupBy("path").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("rid")).alias("sig")).where("m > 1")
    split = F.lit(None).cast("long") if last else F.when(F.col("m") > SMALL, F.col("path"))
    return counted.groupBy("m", "sig", split.alias("_split")).agg(F.min("path").alias("path")).select(F.col("path").alias("_path"), "m")


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *keys).sortWithinPartitions(*keys)


def _spread(rows: DataFrame, right: DataFrame, on: Column, width: Column) -> DataFrame:
    """A left join with a table of few but wide rows, which goes to all tasks if a sum shows it small."""
    few = (right.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(right) if few else right, on, "left")


def _with_sketches(paths: DataFrame, sketches: DataFrame) -> DataFrame:
    """rid, path, sketch. A set's paths, some runs' at most, are put together before the join, which so makes one row for each set; near copies keep many paths
    each, and all of them would meet the same sketch."""
    held = paths.groupBy(F.col("rid").alias("_rid")).agg(F.collect_list("path").alias("paths"))
    return held.join(sketches, F.col("_rid") == F.col("rid")).select("rid", "paths", "sketch").mapInArrow(lean(_spelt_out), "rid long, path long, sketch binary")


def _large_leaf_edges(leaf: DataFrame, sketches: DataFrame, positions: int) -> DataFrame:
    """u, v of leaves with more than SKETCH_BLOCK sets: by their centre, and by blocks of what is not like it."""
    held = leaf.join(sketches, "rid")
    order = F.struct(F.xxhash64("rid", "path").alias("h"), "rid", "sketch")
    # the sets of least hash, one for each of PIVOTS cells, so that the choice pre-aggregates
    cell = F.pmod(F.xxhash64(F.lit("cell"), "rid"), F.lit(PIVOTS))
    pivots = held.groupBy("path", cell.alias("cell")).agg(F.min(order).alias("p")).groupBy(F.col("path").alias("_path")).agg(F.collect_list(F.struct("p.rid", "p.sketch")).alias("pivots"))
    pivots = staged(pivots, "leaf-pivots")
    met = _spread(held, pivots, F.col("path") == F.col("_path"), F.lit(PIVOTS * 4 * positions))
    told = staged(met.select("rid", "path", "m", "sketch", "pivots").mapInArrow(lean(_attach(positions, ALIKE)), "rid long, path long, m long, pivot long, main boolean"), "leaf-sets")
    by_pivot = told.where("pivot >= 0 AND pivot <> rid").select(F.col("rid").alias("u"), F.col("pivot").alias("v"))
    rest = told.where("NOT main")
    n_rest = staged(rest.groupBy(F.col("path").alias("_path")).agg(F.ceil(F.count(F.lit(1)) / SKETCH_BLOCK).cast("int").alias("_rest")), "leaf-rest")
    if n_rest.isEmpty():
        return by_pivot
    own = lambda n: F.pmod(F.xxhash64("rid", F.lit("block")), n).cast("int")
    blocks = F.ceil(F.col("m") / SKETCH_BLOCK).cast("int")
    both = told.join(n_rest, F.col("path") == F.col("_path")).drop("_path")
    every = both.select("rid", "path", own(blocks).alias("b1"), F.explode(F.sequence(F.lit(0), F.col("_rest") - 1)).alias("b2"), F.lit(0).alias("side"))
    few = both.where("NOT main").select("rid", "path", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b1"), own(F.col("_rest")).alias("b2"), F.lit(1).alias("side"))
    placed = every.unionByName(few).join(sketches, "rid").select("rid", "path", "b1", "b2", "side", "sketch")
    return by_pivot.unionByName(_dealt(placed, "path", "b1", "b2").mapInArrow(lean(_compare_rest(positions, ALIKE)), "u long, v long"))


def similar_groups(reps: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, positions: int = POSITIONS) -> DataFrame:
    """node, root over rid: chosen-path runs over the sketches of reps (rid, sketch)."""
    sketches = reps.select("rid", "sketch")
    level = staged(sketches.mapInArrow(lean(_first_paths(runs_for(recall), positions, threshold)), "rid long, path long"), "paths")
    leaves: list[DataFrame] = []
    for depth in range(1, MAX_DEPTH + 1):
        last = depth == MAX_DEPTH
        live = staged(level.join(_buckets(level, last), F.col("path") == F.col("_path")).drop("_path"), "live-paths")
        drop_staged(level)
        leaves.append(live if last else live.where(F.col("m") <= SMALL))
        if last:
            break
        large = live.where(F.col("m") > SMALL).select("rid", "path")
        level = staged(_with_sketches(large, sketches).mapInArrow(lean(_next_paths(positions, threshold)), "rid long, path long"), "paths")
    leaf = reduce(DataFrame.unionByName, leaves)
    small = _with_sketches(leaf.where(F.col("m") <= SKETCH_BLOCK), sketches)
    edges = _dealt(small, "path").mapInArrow(lean(_compare_sketches(positions, ALIKE)), "u long, v long")
    large = leaves[-1].where(F.col("m") > SKETCH_BLOCK)
    if not large.isEmpty():
        edges = edges.unionByName(_large_leaf_edges(large, sketches, positions))
    out = components(edges, "u", "v")
    drop_staged(*leaves)
    return out


def _large_group_links(sets: DataFrame, threshold: float) -> DataFrame:
    """rid, root, weight for the sets (rid, size, root, m, shingles) of large groups, by differences to their centres."""
    t = round(threshold * 1000)
    counts = sets.select("root", "shingles").mapInArrow(lean(_shingle_counts), "root long, h long, n long").groupBy("root", "h").agg(F.sum("n").alias("n"))
    in_group = sets.groupBy(F.col("root").alias("_root")).agg(F.countDistinct("rid").alias("_m"))
    centre = counts.join(in_group, F.col("root") == F.col("_root")).where(2 * F.col("n") > F.col("_m")).groupBy("_root").agg(F.collect_list("h").alias("centre"))
    centre = staged(centre, "group-centres")
    near = _spread(sets, centre, F.col("root") == F.col("_root"), 8 * F.size("centre")).select("rid", "size", "root", "shingles", "centre")
    diffs = staged(near.mapInArrow(lean(_differences(threshold)), DIFFS).dropDuplicates(["rid"]), "group-differences")
    # sure links: the weight of all sets whose f is at most -f, from the sums by f
    by_f = staged(diffs.groupBy("root", "f").agg(F.sum("size").alias("w"), F.sum(1 / F.lit(SET_BLOCK) + F.col("k") / BLOCK_SHINGLES).alias("room")), "group-sums")
    asked = by_f.select("root", "f", F.col("f").alias("v"), "w", F.lit(0).alias("kind")).unionByName(by_f.select("root", "f", (-F.col("f")).alias("v"), F.lit(0).cast("long").alias("w"), F.lit(1).alias("kind")))
    up_to = W.partitionBy("root").orderBy("v", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    sure = asked.withColumn("sure", F.sum("w").over(up_to)).where("kind = 1").select(F.col("root").alias("_root"), F.col("f").alias("_f"), "sure")
    before = F.sum("room").over(W.partitionBy("root").orderBy("f").rowsBetween(W.unboundedPreceding, -1))
    cut = by_f.select("root", "f", F.floor(F.coalesce(before, F.lit(0.0))).cast("long").alias("block"), F.ceil("room").cast("long").alias("parts")).join(sure, (F.col("root") == F.col("_root")) & (F.col("f") == F.col("_f"))).drop("root", "f")
    cut = staged(cut, "group-cuts")
    here = diffs.groupBy(F.col("root").alias("_r")).agg(F.min(F.struct("f", "rid")).alias("nearest"), F.max("f").alias("_most"))
    told = _spread(diffs, cut, (F.col("root") == F.col("_root")) & (F.col("f") == F.col("_f")), F.lit(40))
    told = _spread(told, staged(here, "group-ends"), F.col("root") == F.col("_r"), F.lit(32))
    weight = F.col("sure") - F.when(F.col("f") <= 0, F.col("size")).otherwise(0)
    certain = told.withColumn("weight", weight).where("weight > 0").select("rid", F.col("nearest.rid").alias("root"), "weight")
    # open pairs: of blocks in the order of f
    block = F.col("block") + F.pmod(F.xxhash64("rid", F.lit("block")), F.greatest("parts", F.lit(1)))
    open_ = staged(told.where(F.col("f") > -F.col("_most")).select("rid", "size", "root", "f", "k", "diff", block.alias("block")), "group-open")
    stats = staged(open_.groupBy("root", "block").agg(F.min("f").alias("low"), F.max("f").alias("high"), F.max("k").cast("long").alias("k")), "group-blocks")
    a, b = (stats.select(*(F.col(c).alias(f"{x}_{c}") for c in stats.columns)) for x in ("a", "b"))
    meet = (F.col("a_root") == F.col("b_root")) & (F.col("a_block") <= F.col("b_block")) & (F.col("a_high") + F.col("b_high") > 0) & (F.col("a_low") + F.col("b_low") <= 2 * (1000 + t) * F.least("a_k", "b_k"))
    pairs = staged(a.join(b, meet).select(F.col("a_root").alias("_root"), F.col("a_block").alias("b1"), F.col("b_block").alias("b2")), "block-pairs")
    if pairs.isEmpty():
        return certain
    sides = pairs.select("*", F.col("b1").alias("_block"), F.lit(0).alias("side")).unionByName(pairs.where("b1 <> b2").select("*", F.col("b2").alias("_block"), F.lit(1).alias("side")))
    placed = open_.join(sides, (F.col("root") == F.col("_root")) & (F.col("block") == F.col("_block"))).select("rid", "size", "root", "b1", "b2", "side", "f", "k", "diff")
    return certain.unionByName(_dealt(placed, "root", "b1", "b2").mapInArrow(lean(_compare_differences(threshold)), LINKS))


def _judged(docs: DataFrame, id_col: str, text_col: str, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest of the text, sid) of all rows, and by sid of sets with copies or links: class_id, set_id, n_links and whether
    it is the set of the document that stands for its class."""
    spark = docs.sparkSession
    source = docs.select(docs[id_col].try_cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("digest"))
    sets = staged(source.mapInArrow(lean(_sets(POSITIONS)), SETS), "shingle-sets")
    # of a set's documents the one with the least id is named, and by its digest found again
    by_set = sets.where("sid IS NOT NULL").groupBy("sid").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("rep"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    reps = staged(by_set.select("sid", "size", "n", "sketch", F.col("rep.doc_id").alias("rep"), F.col("rep.digest").alias("digest"), F.monotonically_increasing_id().alias("rid")), "set-reps")
    alike = staged(similar_groups(reps, threshold, recall), "similar-groups")
    known = reps.drop("sketch")
    named = alike.join(known.withColumnRenamed("rid", "node"), "node")
    groups = named.groupBy(F.col("root").alias("_root")).agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("n").cast("long")).alias("shingles"))
    large = (F.col("m") > SET_BLOCK) | (F.col("shingles") > BLOCK_SHINGLES)
    members = named.join(groups, F.col("root") == F.col("_root")).select(F.col("node").alias("rid"), "root", "m", "sid", "size", F.col("rep").alias("_rep"), F.col("digest").alias("_digest"), large.alias("large"))
    members = staged(members, "members")
    few = members.count() <= BROADCAST_IDS
    texts = source.join(F.broadcast(members) if few else members, F.col("doc_id").eqNullSafe(F.col("_rep")) & (F.col("digest") == F.col("_digest")))
    full = staged(texts.select("rid", "size", "root", "m", "large", "sid", "text").mapInArrow(lean(_candidate_sets), "rid long, size long, root long, m long, large boolean, shingles binary"), "group-sets")
    links = _dealt(full.where("NOT large").select("rid", "size", "root", "shingles"), "root").mapInArrow(lean(_compare_sets(threshold)), LINKS)
    large_sets = full.where("large")
    if not large_sets.isEmpty():
        links = links.unionByName(_large_group_links(large_sets.select("rid", "size", "root", "shingles"), threshold))
    links = staged(links, "links")
    drop_staged(full, members, alike)
    joined = components(links.select("rid", "root"), "rid", "root")
    weights = links.groupBy("rid").agg(F.sum("weight").alias("weight"))
    linked = known.join(weights, "rid", "left").join(joined.withColumnRenamed("node", "rid"), "rid", "left")
    classed = staged(linked.where("size > 1 OR weight IS NOT NULL").select("sid", "size", "rep", F.coalesce("weight", F.lit(0)).alias("weight"), F.coalesce("root", "rid").alias("root")), "linked-sets")
    least = classed.groupBy(F.col("root").alias("_root")).agg(F.min(F.struct(F.col("rep").isNull().alias("unnamed"), "rep", "sid")).alias("least"))
    told = classed.join(least, F.col("root") == F.col("_root")).select(
        F.col("sid").alias("_sid"), F.col("least.rep").alias("class_id"), F.col("rep").alias("set_id"), (F.col("size") - 1 + F.col("weight")).alias("n_links"), (F.col("sid") == F.col("least.sid")).alias("stands")
    )
    return sets.select("doc_id", "digest", "sid"), told


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (the least doc_id among all documents that links join), set_id (the least doc_id with the same
    set of shingles), n_links (other documents at the threshold or above, copies included)."""
    rows, told = _judged(docs, id_col, text_col, threshold, recall)
    out = rows.join(told, F.col("sid") == F.col("_sid"), "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("set_id", "doc_id").alias("set_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """docs without near duplicates, with all their columns: of each class the document with the least id stays, once (of two
    texts with that id the one of the least set; of rows that differ in other columns only the first in JSON). Rows without an id stay, all of them; so do texts without words, those that
    repeat id and text once."""
    rows, told = _judged(docs, id_col, text_col, threshold, recall)
    both = rows.where("doc_id IS NOT NULL").join(told, F.col("sid") == F.col("_sid"), "left")
    stays = F.col("stands").isNull() | (F.col("stands") & (F.col("doc_id") == F.col("class_id")))
    # repeats of one id and text have one decision
    decided = staged(both.groupBy("doc_id", "digest").agg(F.bool_and(stays).alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "copies")
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    held = docs.select(*(docs[c].alias(n) for c, n in names.items()), docs[id_col].try_cast("long").alias("_id"), F.xxhash64(docs[text_col]).alias("_text"))
    few = decided.count() <= BROADCAST_IDS
    known = held.join(F.broadcast(decided) if few else decided, (F.col("_id") == F.col("doc_id")) & (F.col("_text") == F.col("digest")), "left")
    columns = [F.col(n).alias(c) for c, n in names.items()]
    single = known.where("n IS NULL").select(*columns)
    again = decided.where("stays AND n > 1")
    if again.isEmpty():
        return single
    # only rows that repeat are dealt out, to stay once
    whole = F.struct(*names.values())
    repeated = known.where("stays AND n > 1").groupBy("_id", "_text").agg(F.min_by(whole, F.to_json(whole)).alias("row"))
    return single.unionByName(repeated.select(*(F.col(f"row.{n}").alias(c) for c, n in names.items())))


#: The same by brute force in DuckDB's SQL, over the view documents.
SQL = r"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))]) AS s FROM split WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y, c = p.n AND c = q.n AS same FROM common JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE c * 10 >= 8 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
class AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n_links, min(y) FILTER (WHERE same) AS same FROM links GROUP BY x)
SELECT d.doc_id, least(d.doc_id, class.y) AS class_id, least(d.doc_id, counts.same) AS set_id, coalesce(counts.n_links, 0)::BIGINT AS n_links
FROM documents d LEFT JOIN class ON d.doc_id = class.x LEFT JOIN counts ON d.doc_id = counts.x
"""

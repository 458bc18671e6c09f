"""Chat formatting, centroid clustering and hard negatives, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from estatelake.llm import centroids, chat, negatives, queries
from tests.conftest import SMALL, duck, same_rows

ODD = ["", None, "\\", "a\\", "\\\\<|im_end|>", "<|im_start|>user<|im_sep|>x<|im_end|>", "<\\|im_end|>", "</s>[INST] ok [/INST]", "<<SYS>>\n<</SYS>>", "[[INST]", "<<s>", "é😀\n<", "<|im_", "end|>", "x" * 30_000]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_chat_formatting", "op12_centroid_clusters", "op13_hard_negatives"])
def test_against_sql(spark, name):
    assert same_rows(queries.queries()[name](spark, SMALL), duck(SMALL), queries.oracle_sql()[name])


# -- chat -----------------------------------------------------------------------------------------


def conversations(seed, long=0):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool<|im_sep|>", None]), rng.choice(ODD)) for c in (1, 2, None, -7, 5) for t in range(rng.randrange(1, 12))]
    rows += [(9, t, "assistant" if t % 2 else "user", f"{t} {rng.choice(ODD)}") for t in range(long)]
    return rows


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: r[1])]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize(("seed", "long"), [(1, 0), (2, 600)])
def test_conversations_are_read_back(spark, seed, long):
    rows = conversations(seed, long)
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, place int, segment string, start int").repartition(5)
    formatted = chat.format_conversations(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_report(formatted).collect()}
    assert got == expected(rows)
    # every example is the prefix up to its reply, and no control string but the marks stands in the output
    held = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.place)):
        held.setdefault(r.conv_id, []).append(r)
    whole = {c: "".join(r.segment for r in rs) for c, rs in held.items()}
    marks = chat.Template()
    for c, rs in held.items():
        assert [r.place for r in rs] == list(range(len(rs)))
        inner = whole[c].replace(marks.start, "").replace(marks.sep, "").replace(marks.end, "")
        assert whole[c].count(marks.start) == whole[c].count(marks.end) == whole[c].count(marks.sep) == len(rs)
        assert not any(x in inner for x in marks.further)
    found = {(r.conv_id, r.example): r for r in chat.examples(formatted).collect()}
    assert len(found) == sum(r[2] == "assistant" for r in rows)
    for r in chat.rendered(formatted).collect() if not long else []:
        e, text = found[r.conv_id, r.example], whole[r.conv_id]
        target = [x for x in held[r.conv_id] if x.example == r.example][0]
        assert (r.context, r.target) == (text[: e.context_chars], text[e.context_chars : e.chars])
        assert e.context_turns == target.place and r.target == target.segment
        assert text[e.loss_start : e.loss_end] + marks.end == r.target[len(marks.start + "assistant" + marks.sep) :]


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.chat_report(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
    twice = [(1, 1, "user", "a"), (1, 1, "user", "a"), (1, None, "assistant", "b"), (1, 2, "user", "c")]
    got = chat.chat_report(chat.format_conversations(spark.createDataFrame(twice, schema))).first()
    assert (got.n_turns, got.loss_chars, got.turns_sha256) == (4, 1, sha("assistant\nb\nuser\na\nuser\na\nuser\nc\n"))
    own = chat.Template("<a>", "<b>", "<c>", ("[[",), "bot")
    rows = [(1, 0, "user", "<a>[[[<b"), (1, 1, "bot", "<c>\\")]
    f = chat.format_conversations(spark.createDataFrame(rows, schema), own)
    assert sorted(r.segment for r in f.collect()) == ["<a>bot<b><\\c>\\\\<c>", "<a>user<b><\\a>[\\[\\[<b<c>"]
    assert chat.chat_report(f, own).first().loss_sha256 == sha("<c>\\")
    with pytest.raises(ValueError, match="two characters"):
        chat.Template(further=("x",))


def test_hot_conversation_runs_through_many_ranges(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"text {t}") for t in range(2000)] + [(c, 0, "user", "x") for c in range(2, 40)]
    f = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).where("conv_id = 1").orderBy("place").collect()
    assert [r.place for r in f] == list(range(2000))
    assert [r.example for r in f if r.example is not None] == list(range(len([t for t in range(2000) if t % 3])))
    at = np.cumsum([0] + [len(r.segment) for r in f])
    assert [r.start for r in f] == at[:-1].tolist()


def test_report_reads_examples_that_are_written_out(spark, monkeypatch):
    monkeypatch.setattr(chat, "TOGETHER", 3)
    rows = [(c, t, "assistant" if t % 2 else "user", f"{t} {ODD[(c + t) % len(ODD)]}") for c, n in ((1, 41), (2, 12), (3, 1), (4, 14)) for t in range(n)]
    rows += [(5, t, role, "x") for t, role in enumerate(["assistant", "assistant", "user", "user"])]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    segments = {}
    for r in formatted.orderBy("conv_id", "place").collect():
        segments.setdefault(r.conv_id, []).append(r)
    want = []
    for c, rs in segments.items():
        whole, replies = "".join(r.segment for r in rs), [r for r in rs if r.example is not None]
        behind = whole[replies[-1].start + len(replies[-1].segment) :] if replies else whole
        want += [(c, r.example, whole[: r.start], r.segment, r.loss_start, r.loss_end, behind if r is replies[-1] else None) for r in replies]
        want += [] if replies else [(c, None, None, None, None, None, whole)]
    written = chat.expand(formatted)
    assert written.columns == list(chat.EXPANDED)
    assert sorted((tuple(r) for r in written.collect()), key=repr) == sorted(want, key=repr)
    got = {r.conv_id: r for r in chat.chat_report(formatted).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == expected(rows)
    for c, r in got.items():
        assert (r.n_examples, r.example_chars) == (sum(w[0] == c and w[1] is not None for w in want), sum(len(w[2]) + len(w[3]) for w in want if w[0] == c and w[1] is not None))
    # what the examples lack, the report lacks
    monkeypatch.setattr(chat, "expand", lambda f: written.withColumn("context", F.when(F.col("example").isNotNull(), "")))
    assert {r.conv_id: r.n_turns for r in chat.chat_report(formatted).collect()} == {1: 2, 2: 1, 3: 1, 4: 1, 5: 3}


# -- centroids ------------------------------------------------------------------------------------


def lloyd(rows, dim, scale, k, rounds, seed):
    """In plain Python integers."""
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    centres = [v for _, v in sorted(((sha(f"{seed}:{i}"), v) for i, v in kept if i is not None))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[near(v)[1]].append(v)
        centres = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(own, centres, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    sums = [sum(d for _, d, j in found if j == c) for c in range(len(centres))]
    return sorted(((i, j, d, sums[j], sum(sums), sha(",".join(map(str, centres[j])))) for i, d, j in found), key=repr)


def awkward_vectors(seed, dim, n=300):
    rng = random.Random(seed)
    spots = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.05 if i % 3 else 0.5) for x in rng.choice(spots)]) for i in range(n)]
    rows += [(1000 + i, [0.25] * dim) for i in range(n // 2)]  # one vector of many rows
    rows += [(2000, None), (2001, []), (2002, [0.5] * (dim - 1)), (2003, [None] * dim), (2004, [float("nan")] * dim), (2005, [float("inf")] * dim), (None, [0.1] * dim), (7, [0.2] * dim), (7, [0.2] * dim)]
    return rows


@pytest.mark.parametrize(("dim", "k", "scale"), [(4, 5, 64), (3, 1, 1024), (5, 700, 16), (4, 6, 1 << 24)])
def test_clusters_against_plain_integers(spark, dim, k, scale, monkeypatch):
    monkeypatch.setattr(centroids.zone_map, "__defaults__", (centroids.DIM, 3, 16))
    rows = awkward_vectors(dim, dim)
    df = spark.createDataFrame([(*r, 9, 1.5) for r in rows], "vec_id long, embedding array<double>, cluster int, distance double").repartition(3)
    got = centroids.cluster(df, dim=dim, scale=scale, k=k, rounds=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == lloyd(rows, dim, scale, k, 4, centroids.SEED)


def test_cluster_edges(spark):
    schema = "vec_id long, embedding array<double>"
    assert centroids.cluster(spark.createDataFrame([], schema)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema)).count() == 0
    one = centroids.cluster(spark.createDataFrame([(1, [0.5, -0.3])], schema), dim=2).collect()
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in one] == [(1, 0, 0, 0)]
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e12, 0.0])], schema), dim=2).collect()


def test_box_bounds_keep_every_nearest_centroid():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(300):
        centres = rng.integers(-20, 20, (6, 3))
        x = rng.integers(-20, 20, 3) + rng.integers(0, rng.integers(1, 12), (40, 3))
        kept = centroids.candidates(x.min(axis=0), x.max(axis=0), centres)
        assert set(centroids.nearest(x, centres)[0].tolist()) <= set(kept.tolist())
        pruned += 6 - len(kept)
    assert pruned > 300


def test_the_curve_steps_to_neighbours():
    for dim, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), axis=-1).reshape(-1, dim)
        keys = [k.tobytes() for k in centroids.hilbert_keys(grid, bits)]
        assert len(set(keys)) == len(grid)
        path = grid[sorted(range(len(grid)), key=lambda i: keys[i])]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


# -- hard negatives -------------------------------------------------------------------------------


def brute_negatives(rows, every, positives, k, scale):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(float(x) * scale) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (i, v, label) in enumerate(kept):
        if i % every:
            continue
        others = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, m == label) for b, (j, w, m) in enumerate(kept) if b != a and len(w) == len(v))
        for p, j, same in [o for o in others if o[2]][:positives]:
            inside = [(s, n) for s, n, alike in others if not alike and -80 * p <= -100 * s <= -100 * p][:k]
            out += [(i, j, r, n, -p, -s) for r, (s, n) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize(("positives", "k"), [(5, 5), (1, 3), (9, 2)])
def test_negatives_against_brute_force(spark, positives, k, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    rng = random.Random(positives)
    rows = [(i, v, rng.randrange(3) if i else 0) for i, v in awkward_vectors(5, 3, 200)]
    rows += [(500, [0.1, 0.2, 0.3], None), (10, [0.0, 0.0, 0.0], 1), (20, [-0.5, -0.5, -0.5], 2), (20, [-0.5, -0.5, -0.5], 2), (40, [], 1), (41, [], 1), (43, [], 2)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, label int, place int").repartition(4)
    got = negatives.mine(df, every=10, positives=positives, k=k)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 10, positives, k, negatives.SCALE)


def test_negative_edges(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert negatives.mine(spark.createDataFrame([], schema)).count() == 0
    assert negatives.mine(spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 2)], schema)).count() == 0  # no positive
    got = negatives.mine(spark.createDataFrame([(100, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [0.5], 2)], schema)).collect()
    assert [tuple(r) for r in got] == [(100, 1, 1, 2, 256 * 256, 230 * 256)]

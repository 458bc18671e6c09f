"""The n-gram Jaccard join on large groups, awkward ids and repeated rows."""

import random

import pytest

from estatelake.llm import components as stars
from estatelake.llm import jaccard, linededup
from tests.llm.test_corpus_operators import brute_links, classes


def edited(rng, words, edits):
    copy = list(words)
    for _ in range(edits):
        copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
    return " ".join(copy)


@pytest.mark.parametrize("seed", [1, 2])
def test_centres_and_pivots_against_brute_force(spark, monkeypatch, seed):
    for name, value in (("SMALL", 4), ("SKETCH_BLOCK", 10), ("SET_BLOCK", 8), ("PIVOTS", 3)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(seed)
    texts = []
    for _ in range(3):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        # from copies that are all linked to copies around the threshold and beyond it; some twice
        texts += [edited(rng, words, rng.choice([0, 1, 1, 2, 3, 4])) for _ in range(45)]
    texts += texts[:5]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in jaccard.jaccard_classes(df).collect()}
    links = brute_links(texts)
    assert {i: got[i].n_links for i in got} == {i: len(x) for i, x in enumerate(links)}
    assert [got[i].class_id for i in range(len(texts))] == classes(list(range(len(texts))), links)


def test_rows_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    dealt = []
    deal = jaccard._dealt
    monkeypatch.setattr(jaccard, "_dealt", lambda rows, *keys: dealt.append(rows.count()) or deal(rows, *keys))
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(220)]
    made = []
    for n in (1000, 3000):
        texts = [edited(rng, words, 1) for _ in range(n)]
        dealt.clear()
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = jaccard.jaccard_classes(df).collect()
        assert {(r.class_id, r.n_links) for r in got} == {(0, n - 1)}
        made.append(sum(dealt))
    # in pairs of blocks, every leaf and the group would deal out n^2 / 512 and n^2 / 256 rows
    assert made[0] <= 4 * 1000
    assert made[1] <= 4 * 3000


A, B, C = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")


def test_one_of_each_loses_no_text(spark):
    def kept(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, _copy int, n int, digest string").repartition(3)
        out = jaccard.one_of_each(df)
        assert out.columns == df.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    rest = (7, 3, None)
    # an id with two texts, one of them a copy
    assert kept([(1, A, *rest), (5, A, *rest), (5, B, *rest), (7, C, *rest)]) == [(1, A), (5, B), (7, C)]
    # rows without an id stay whether or not other ids repeat
    assert kept([(None, B, *rest), (None, B, *rest), (3, A, *rest), (3, A, *rest)]) == sorted([(None, B), (None, B), (3, A)], key=repr)
    assert kept([(None, B, *rest), (None, B, *rest), (3, A, *rest)]) == sorted([(None, B), (None, B), (3, A)], key=repr)
    # one id, two near texts: one stays; texts without words stay, repeats of one row once
    near = A + " more"
    assert len(kept([(1, A, *rest), (1, near, *rest)])) == 1
    assert kept([(1, "", *rest), (2, "", *rest), (2, "", *rest), (4, None, *rest)]) == sorted([(1, ""), (2, ""), (4, None)], key=repr)


def test_ids_that_are_no_numbers_and_rows_without_one(spark):
    df = spark.createDataFrame([("x", A), ("5", A), (None, A), (None, B), (None, B + " end")], "doc_id string, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.jaccard_classes(df).collect()), key=repr)
    assert got == sorted([(5, 5, 2), (None, 5, 2), (None, 5, 2), (None, None, 1), (None, None, 1)], key=repr)


def test_rounds_that_run_out_are_no_result(spark, monkeypatch):
    monkeypatch.setattr(stars, "MAX_ROUNDS", 1)
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")
    with pytest.raises(RuntimeError, match="not settled"):
        stars.components(edges, "u", "v")
    monkeypatch.setattr(linededup, "MAX_ROUNDS", 1)
    text = "\n".join(f"line number {i}" for i in range(8))
    with pytest.raises(RuntimeError, match="lines"):
        linededup.dedup_lines(spark.createDataFrame([(0, text), (1, text)], "doc_id long, text string"))


def test_counts_of_line_dedup_clash_with_no_column(spark):
    line = "one and the same long line"
    df = spark.createDataFrame([(0, line + "\nown", 90, 91, "q"), (1, line, 92, 93, "r")], "doc_id long, text string, n_lines int, n_deleted int, gone string")
    kept = linededup.first_copies(df)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.collect()] == [(0, line + "\nown", 90, 91, "q")]
    assert sorted((r.doc_id, r.n_lines, r.n_deleted, r.gone) for r in linededup.dedup_lines(df).collect()) == [(0, 2, 0, "q"), (1, 1, 1, "r")]

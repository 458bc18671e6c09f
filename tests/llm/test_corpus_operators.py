"""Operators over the whole corpus, against brute force."""

import random

import numpy as np
import pytest

from estatelake.llm import jaccard, linededup, media, mixing, neighbours, pages, pieces, queries, secrets, tokenfiles
from estatelake.llm.components import components
from tests.conftest import SMALL, duck, same_rows
from tests.llm.fixtures import DOCS, documents


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_links(rows):
    sets = [shingles(t) for t in rows]
    return [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]


def classes(ids, links):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, js in enumerate(links):
        for j in js:
            root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    return [least[find(i)] for i in range(len(ids))]


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append(" ".join(copy))
    return rows


@pytest.mark.parametrize("texts", [[d[1] for d in DOCS[:16]], near_copies(1) + near_copies(2)])
def test_jaccard_against_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in jaccard.jaccard_classes(df).collect()}
    links = brute_links(texts)
    assert {i: got[i].n_links for i in got} == {i: len(x) for i, x in enumerate(links)}
    assert [got[i].class_id for i in range(len(texts))] == classes(list(range(len(texts))), links)


def test_blocks_and_deep_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 3)
    monkeypatch.setattr(jaccard, "SKETCH_BLOCK", 4)
    monkeypatch.setattr(jaccard, "SET_BLOCK", 3)
    base = " ".join(f"b{i}" for i in range(300))
    texts = [base + f" t{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.class_id, r.n_links) for r in jaccard.jaccard_classes(df).collect()} == {(0, 39)}


def test_many_near_copies_of_long_texts_at_the_real_bounds(spark):
    rows = []
    for seed in (2, 3, 7):  # texts for which one try by the whole group finds no path to the end
        rng = random.Random(seed)
        words = [f"w{rng.randrange(50_000)}" for _ in range(10_000)]
        for i in range(70):
            copy = list(words)
            copy[rng.randrange(len(copy))] = f"x{i}"
            rows.append((len(rows), " ".join(copy)))
    assert jaccard.SMALL < 70
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {(r.doc_id // 70, r.class_id, r.n_links) for r in jaccard.jaccard_classes(df).collect()} == {(g, 70 * g, 69) for g in range(3)}


def test_one_of_each_keeps_columns_and_repeated_rows_once(spark):
    docs = documents(spark)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5, 6, 8, 9, 10, 11, 13, 14]


def test_runs_follow_from_recall():
    assert jaccard.runs_for(0.9999) > jaccard.runs_for(0.9)
    assert 1 - (1 - jaccard.survival(jaccard.MAX_DEPTH)) ** jaccard.runs_for(0.999) >= 0.999


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    assert all(got[i] == 1 for i in range(1, 31))
    assert all(got[i] == 100 for i in range(100, 140))


def brute_lines(rows):
    """doc_id -> kept text, by comparing runs of non-blank lines."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen_line, seen_pair, out = set(), set(), {}
    for i, text in docs:
        lines = text.split("\n")
        solid = [(p, x.strip(" ")) for p, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for n, (p, x) in enumerate(solid):
            if x in seen_line and len(x) >= 10:
                gone.add(p)
            seen_line.add(x)
            if n + 1 < len(solid):
                pair = (x, solid[n + 1][1])
                if pair in seen_pair:
                    gone |= {p, solid[n + 1][0]}
                seen_pair.add(pair)
        out[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_line_dedup_against_brute_force(spark, seed):
    if seed is None:
        rows = [(d[0], d[1]) for d in DOCS]
        docs = documents(spark)
    else:
        rng = random.Random(seed)
        rows = [(i, "\n".join(rng.choice(["a", "b", "c c c c c c c", "d", "", "  ", "long line number one", "z" * 12]) for _ in range(rng.randrange(0, 14)))) for i in range(30)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = linededup.dedup_lines(docs)
    want = brute_lines(rows)
    assert {r.doc_id: r.text for r in got.collect()} == {i: want.get(i) for i, _ in rows}
    assert got.columns[: len(docs.columns)] == docs.columns


@pytest.mark.parametrize("name", ["op1_jaccard_join", "op7_line_dedup", "op8_source_mix"])
def test_queries_against_their_sql(spark, name):
    same_rows(queries.queries()[name](spark, SMALL), duck(SMALL), queries.oracle_sql()[name])


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "en", rng.choice(["b", "a", None, "c", "c", "c", "c"])) for i in range(3000)]
    docs = documents(spark, rows)
    got = mixing.mix_report(docs).collect()
    assert len(got) == 3000
    total = sum(r.size for r in got)
    by_source = {}
    for r in got:
        source = rows[r.doc_id][3]
        by_source.setdefault(source, []).append(r)
        assert r.taken <= 3 * r.size
    assert abs(sum(v[0].target for v in by_source.values()) - total) < 1e-6 * total
    order = sorted((s for s in by_source if s is not None)) + [None]
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    level = max(v[0].target / weights[s] for s, v in by_source.items())
    for s, v in by_source.items():
        assert abs(sum(r.taken for r in v) - v[0].target) <= 60
        assert v[0].target == pytest.approx(min(weights[s] * level, 3 * v[0].source_size))
    assert mixing.mix(docs).columns == docs.columns
    copies = {}
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert all(copies.get(r.doc_id, 0) * r.size == r.taken for r in got)


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><nav><a href=x>Menu {0}</a></nav>
<div class="cookie-notice">Accept</div><div class="teaser">Always the same words here</div><div class="content"><h1>Title {0}</h1><p>One&nbsp;two <b>x</b>y<br>z{0} &#8212; &lt;k&gt;</p><!-- c --><div class="ad">buy</div></div>
<form><input><p>field</p></form><section id="comments"><p>nice {0}</p></section><footer>&copy; F</footer></body></html>"""


def test_pages_by_template(spark):
    rows = [(i, "http://h.example/x", PAGE.format(i)) for i in range(8)] + [(20, "http://one.example/", PAGE.format(20)), (21, None, None), (22, "bad", "<p>open <b>text &amp"), (23, "http://h.example/y", "<article><p>A</p><aside>no</aside>B</article><p>out</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumnRenamed("x", "x")
    got = {r.page_id: r for r in pages.extract_main_text(df).collect()}
    assert got[3].text == "Title 3 One two xy z3 — <k>"
    assert got[20].text == "Always the same words here Title 20 One two xy z20 — <k>"
    assert (got[21].text, got[21].n_chars) == ("", 0)
    assert got[22].text == "open text &"
    assert got[23].text == "A B"


def test_template_inside_the_article(spark):
    def page(i):
        said = ["the story of one", "one story the of"][i % 2]  # words of all pages in no one order
        return f"<html><body><nav>Menu</nav><article><h1>Title {i}</h1><div class=teaser>Always the same words here</div><p>{said} a{i} b{i}</p><p>Write to the editor of this story</p></article></body></html>"

    rows = [(i, "http://h.example/x", page(i)) for i in range(8)] + [(10 + i, "http://copies.example/x", page(3)) for i in range(6)]
    got = {r.page_id: r.text for r in pages.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == "Title 2 the story of one a2 b2"
    assert got[3] == "Title 3 one story the of a3 b3"
    assert got[10] == "Title 3 Always the same words here one story the of a3 b3 Write to the editor of this story"


def test_templates_of_any_length(spark, monkeypatch):
    menu = "<div class=list>" + "".join(f"<p>entry{i}</p>" for i in range(2500)) + "</div>"
    rows = [(i, "http://h.example/x", f"<html><body>{menu}<div><p>own{i} text{i}</p></div></body></html>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for bound in (pages.BROADCAST_TOKENS, 0):  # as a broadcast and by a shuffle
        monkeypatch.setattr(pages, "BROADCAST_TOKENS", bound)
        assert {r.page_id: r.text for r in pages.extract_main_text(df).collect()} == {i: f"own{i} text{i}" for i in range(6)}


def test_neighbours_recall_and_cases(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).round(3)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] * 16, 1), (2060, [1.0] * 3, 1), (2080, [None] * 16, 1), (2100, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in neighbours.nearest_neighbours(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 20))
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s[v] - c) < 1e-9 for _, v, c in found)
        assert all((b[2] < a[2]) or (b[2] == a[2] and a[1] < b[1]) for a, b in zip(found, found[1:], strict=False))
        hit += len(set(want.tolist()) & {f[1] for f in found})
    assert hit / (20 * len(got)) >= 0.9
    assert neighbours.nearest_neighbours(df.limit(3)).count() == 2
    assert neighbours.nearest_neighbours(df.limit(1)).count() == 0
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0


def test_neighbours_of_repeated_ids_and_other_lengths(spark):
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int, list int, v int").repartition(3)
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [5.0, 1.0]), (2, [2.0, 0.0]), (0, [3.0, 0.5]), (20, [1.0, 2.0, 3.0]), (21, [0.0, 1.0, 0.0]), (40, [7.0])]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest_neighbours(table([(*r, 1, 2, 3) for r in rows])).collect())
    one = [(0, 1, 1, 5.0), (0, 2, 0, 3.0), (0, 3, 2, 2.0), (0, 4, 1, 1.0)]
    two = [(0, 1, 1, 15.5), (0, 2, 2, 6.0), (0, 3, 1, 3.5), (0, 4, 0, 3.0)]
    assert got == sorted([*one, *two, (20, 1, 21, 2.0)])


@pytest.mark.parametrize("blocks", [None, 7])
def test_every_query_finds_twenty(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(neighbours, "BLOCK_ROWS", blocks)
        monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
        monkeypatch.setattr(neighbours, "TUNED_RECALL", 0.0)  # too few lists and a floor that is rarely reached
        monkeypatch.setattr(neighbours, "LEAST_PROBES", 1)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(1, 8)), 150, axis=0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest_neighbours(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: sorted(r for r, _, _ in f) for q, f in got.items()} == {q: list(range(1, 21)) for q in range(0, 450, 20)}
    for q, found in got.items():
        assert len({v for _, v, _ in found} - {q}) == 20
        assert all(abs(x[q] @ x[v] - s) < 1e-9 for _, v, s in found)


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    html = spark.createDataFrame([], "page_id long, url string, html string")
    made = (
        jaccard.jaccard_classes(none), linededup.dedup_lines(none), mixing.mix_report(none), mixing.mix(none), secrets.scan_secrets(none), media.media_report(none), pages.extract_main_text(html),
        pieces.encode_pieces(none, queries.tokenizer_file("piece_bpe_32k.model")), tokenfiles.token_files_report(none, queries.tokenizer_file("byte_bpe_50k.json")),
    )
    assert [m.count() for m in made] == [0] * len(made)


def corpus():
    rng = random.Random(11)
    words = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    shared = ["a passage that stands in many documents", "and its second line, also in many"]
    rows = []
    for i in range(90):
        lines = [words(rng.randrange(8, 40)) for _ in range(rng.randrange(1, 4))]
        if i % 4 == 0:
            lines[1:1] = shared
        rows.append((i, "\n".join(lines), "en", rng.choice(["b", "a", "c", "c", "c", None])))
    rows += [(100 + i, rows[i][1], "en", "a") for i in range(6)]  # copies
    rows += [(110 + i, rows[i][1].replace("w1", "v1", 1) + " end", "en", "b") for i in range(6)]  # near copies
    junk = [(200 + i, "BUY NOW!!! $$$ click click click " * rng.randrange(1, 9), "en", "a") for i in range(40)]
    odd = [(300, None, "en", None), (301, "", None, "a"), (302, " \n ", "en", "b"), (303, "one", "en", "c"), (None, words(30), "en", "a"), (5, rows[5][1], "en", "c")]
    labels = [(i, 1) for i in range(0, 90, 2)] + [(200 + i, 0) for i in range(0, 40, 2)]
    return rows + junk + odd, labels


def test_each_stage_against_brute_force(spark, tmp_path, monkeypatch):
    """Every stage on what the one before it kept: texts, columns, copies and tokens."""
    import hashlib
    from array import array

    import corpus_pipeline as c
    from estatelake.llm import quality

    rows, labels = corpus()
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    monkeypatch.setattr(c, "documents", lambda spark, sf_dir, name: table)
    model = quality.fit_quality(docs, table)
    assert [name for name, _ in c.STAGES] == ["quality_filter", "line_dedup", "near_duplicates", "source_mix", "tokenise"]
    key = lambda r: repr(tuple(r))
    held = sorted(docs.collect(), key=key)
    columns = docs.columns
    at = {n: columns.index(n) for n in ("doc_id", "text", "source", "n_chars")}
    for name, stage in c.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = sorted(docs.collect(), key=key)
        if name == "quality_filter":
            assert [tuple(r) for r in got] == [tuple(r) for r in held if model.score([r.text or ""])[0] >= quality.THRESHOLD]
            assert {r.doc_id for r in got if r.doc_id is not None} >= {i for i in range(90)}
            assert not {r.doc_id for r in got if r.doc_id is not None} & {200 + i for i in range(40)}
        elif name == "line_dedup":
            some = [(r.doc_id, r.text) for r in held if r.text is not None]
            kept = brute_lines(some)
            solid = lambda t: any(x.strip(" ") for x in t.split("\n"))
            want = []
            for r in held:
                text = kept[r.doc_id] if r.text is not None else None
                if text is None or solid(text) or not solid(r.text):
                    want.append((*r[: at["text"]], text, *r[at["text"] + 1 : at["n_chars"]], None if text is None else len(text), *r[at["n_chars"] + 1 :]))
            assert [tuple(r) for r in got] == sorted(want, key=key)
        elif name == "near_duplicates":
            named = sorted({(r.doc_id, r.text or "") for r in held if r.doc_id is not None})
            of = classes([i for i, _ in named], brute_links([t for _, t in named]))
            want = {i for (i, _), k in zip(named, of, strict=True) if i == k}
            assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(want)
            assert sum(r.doc_id is None for r in got) == sum(r.doc_id is None for r in held)
            assert {tuple(r) for r in got} <= {tuple(r) for r in held}
        elif name == "source_mix":
            import duckdb
            import pyarrow as pa

            documents_ = pa.Table.from_pylist([r.asDict() for r in held], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("source", pa.string())]))  # noqa: F841
            con = duckdb.connect()
            con.register("documents", documents_)
            # texts without words come in their source's whole copies
            taken = {i: (n // size if size else int(target // of) if of else 0) for i, size, of, target, n in con.execute(mixing.SQL).fetchall()}
            assert sorted((tuple(r) for r in got), key=repr) == sorted((tuple(r) for r in held for _ in range(taken[r.doc_id])), key=repr)
        else:
            lib = pieces.piece_model(queries.tokenizer_file("piece_bpe_32k.model")).library
            want = []
            for r in held:
                ids = lib.encode(r.text or "", add_bos=True, add_eos=True)
                want.append((r.doc_id, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
            assert [tuple(r) for r in got] == sorted(want, key=key)
        if name != "tokenise":
            assert docs.columns == columns
        held = got


def test_run_on_the_small_tables(spark):
    import corpus_pipeline as c
    from estatelake.llm.common import documents as table

    sizes = {r.doc_id: r.size for r in mixing.sized_documents(table(spark, SMALL))[0].collect()}
    out = c.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} <= set(sizes)
    assert all(sum(r.doc_id == i for r in out) <= 3 for i in sizes)


def test_mixing_of_repeated_rows_and_ties(spark):
    rows = [(7, "w " * 10, "en", "a")] * 5 + [(i, "w " * 10, "en", "a") for i in range(20, 60)] + [(i, "w " * 10, "en", "b") for i in range(100, 130)] + [(200, None, "en", "b"), (None, "w w", "en", "b"), (None, "w w", "en", None)]
    got = mixing.mix_report(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for source in {r.source_size for r in got}:
        some = [r for r in got if r.source_size == source]
        assert abs(sum(r.taken for r in some) - some[0].target) <= 50 + 10
    again = mixing.mix_report(documents(spark, rows[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def mixed_as_sql(rows):
    import duckdb
    import pyarrow as pa

    names = ("doc_id", "text", "lang", "source")
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=pa.schema([("doc_id", pa.int64()), *((n, pa.string()) for n in names[1:])])))
    return con


@pytest.mark.parametrize("keys", [0, 100_000])
def test_rows_without_id_or_of_one_id_meet_their_target(spark, monkeypatch, keys):
    """Drawn one by one, whether their keys are broadcast or shuffled; the same rows whatever the layout."""
    monkeypatch.setattr(mixing, "BROADCAST_KEYS", keys)
    rng = random.Random(8)
    rows = [(None, "w " * rng.randrange(5, 35), "en", "a") for _ in range(300)]
    rows += [(4, "same text of six words here", "en", "b") for _ in range(300)]
    rows += [(5, f"text {i} of an id that repeats", "en", "c") for i in range(300)]
    rows += [(1000 + i, "x " * rng.randrange(1, 30), "en", "d") for i in range(200)] + [(None, None, "en", None), (None, "", "en", None), (None, "", "en", None)]
    docs = documents(spark, rows)
    got = mixing.mix_report(docs)
    by_target = {}
    for r in got.collect():
        by_target.setdefault((r.target, r.source_size), []).append(r)
    assert len(by_target) == 5
    for (target, _), some in by_target.items():
        assert abs(sum(r.taken for r in some) - target) <= max(r.size for r in some)
    same_rows(mixing.mix_report(documents(spark, rows[::-1]).repartition(7)), mixed_as_sql(rows), mixing.SQL)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    taken = sum(len(r.text.split()) for r in out.collect() if r.text)
    assert taken == sum(r.taken for some in by_target.values() for r in some)

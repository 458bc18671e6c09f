"""Template deduction against a brute-force version, and its awkward cases."""

import random
from collections import Counter, defaultdict

import pytest

from estatelake.llm import pages

SCHEMA = "page_id long, url string, html string, host int, key string, tokens string"


def table(spark, rows, n=3):
    """With extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "k", "t") for r in rows], SCHEMA).repartition(n)


def texts(spark, rows):
    return sorted(((r.page_id, r.text) for r in pages.extract_main_text(table(spark, rows)).collect()), key=repr)


def brute_template(htmls):
    """Valid classes of one host, from whole occurrence vectors."""
    read = [pages.parse(h) for h in htmls]
    every = {t if isinstance(t, str) else " ".join(t) for p in read for t in p.distinct()}
    parsed = [[(t, pages.part_of(t), place) for t, place in p.found(pages.Wanted(every))] for p in read]
    n = len(parsed)
    if n < pages.LEAST_PAGES:
        return set()
    vectors, part = defaultdict(lambda: [0] * n), {}
    for i, tokens in enumerate(parsed):
        for t, p, _ in tokens:
            vectors[t][i] += 1
            part[t] = p
    classes = defaultdict(list)
    for t, v in vectors.items():
        on = sum(x > 0 for x in v)
        if on >= max(pages.LEAST_PAGES, pages.SUPPORT * n):
            classes[tuple(v)].append(t)
    parts = []
    for v, tokens in classes.items():
        if len(tokens) >= pages.LEAST_TOKENS:
            by = defaultdict(set)
            for t in tokens:
                by[part[t]].add(t)
            parts += [(sum(x > 0 for x in v), c) for c in by.values()]
    where = lambda c, tokens: sorted(((place, t) for t, _, place in tokens if t in c), key=lambda x: x[0])

    def rounds(seen):
        k = len(set(seen))
        return tuple(seen[:k]) if len(seen) % k == 0 and seen == seen[:k] * (len(seen) // k) else tuple(seen)

    valid = []
    for on, c in sorted(parts, key=lambda x: (-x[0], -len(x[1]))):
        if len({rounds([t for _, t in w]) for tokens in parsed if (w := where(c, tokens))}) > 1:
            continue
        gaps = []
        for p in valid:
            found = set()
            for tokens in parsed:
                mine, theirs = where(c, tokens), [x for x, _ in where(p, tokens)]
                if mine and theirs:
                    found |= {sum(x < place for x in theirs) for place, _ in mine}
            gaps.append(len(found) <= 1)
        if all(gaps):
            valid.append(c)
    return set().union(*valid) if valid else set()


def site(rng, i, articles):
    words = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    body = "".join(f"<p>{words(rng.randrange(3, 12))}</p>" for _ in range(rng.randrange(1, 4)))
    optional = "<div class=box><p>Now in our shop</p><p>Buy it today</p></div>" if i % 3 else ""
    main = f"<h2>{words(4)}</h2>{body}<div class=teaser>Read more of this every day</div>{optional}"
    tag = "article" if articles else "div"
    return f"<html><body><div class=top>Welcome to our site</div><{tag}>{main}</{tag}><div class=end>All rights are ours</div></body></html>"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(pages, "GROUP_PAGES", 7)  # a host of several groups
    rng = random.Random(seed)
    sites = {f"h{k}.example": [site(rng, i, k % 2 == 0) for i in range(n)] for k, n in enumerate((30, 12, 9, 4))}
    rows = [(1000 * k + i, f"http://{h}/x", text) for k, (h, all_) in enumerate(sites.items()) for i, text in enumerate(all_)]
    got = {r.host: {t for c in r.template for t in c.tokens} for r in pages.deduce_templates(pages.parsed_pages(table(spark, rows))).collect()}
    want = {h: brute_template(all_) for h, all_ in sites.items()}
    assert {h: got.get(h, set()) for h in want} == want
    assert all(want[h] for h in list(want)[:3])
    assert not want["h3.example"]
    for _, text in texts(spark, rows[:51]):
        assert "Welcome" not in text
        assert "Read more" not in text
        assert "rights" not in text


def test_parents_and_gaps(spark):
    rng = random.Random(4)
    rows = [(i, "http://h.example/", site(rng, i, True)) for i in range(20)]
    (r,) = pages.deduce_templates(pages.parsed_pages(table(spark, rows))).collect()
    known = {c["class"]: c for c in r.template}
    top = max(r.template, key=lambda c: (c.support, len(c.tokens)))
    assert top.parent is None
    assert all(c.parent in known and c.gap >= 0 for c in r.template if c["class"] != top["class"])
    assert any(c.support < 20 for c in r.template)


def test_repeated_pages_and_pages_without_an_id(spark):
    page = lambda i: f"<html><body><div class=t>Always the same words here</div><div><h1>Title {i}</h1><p>body{i} of page{i}</p></div><div>Also constant here too</div></body></html>"
    want = sorted((f"Title {i} body{i} of page{i}") for i in range(12))
    once = [(i, "http://h.example/", page(i)) for i in range(12)]
    assert sorted(t for _, t in texts(spark, once)) == want
    assert sorted(t for _, t in texts(spark, once * 2)) == sorted(want * 2)
    assert sorted(t for _, t in texts(spark, [(None, u, h) for _, u, h in once] * 2)) == sorted(want * 2)


def test_null_empty_long_and_broken_pages(spark):
    long = "<article>" + "".join(f"<p>para {i} &amp; more</p>" for i in range(30_000)) + "</article>"
    rows = [(1, None, None), (2, "http://h.example/", ""), (3, "http://h.example/", "<p>open <b>bold <br> next"), (4, "http://h.example/", long), (None, None, "<article>x</article>")]
    got = dict(texts(spark, rows))
    assert (got[1], got[2], got[3], got[None]) == ("", "", "open bold next", "x")
    assert got[4] == " ".join(f"para {i} & more" for i in range(30_000))
    assert pages.extract_main_text(table(spark, rows).limit(0)).count() == 0


def test_frequent_tokens_of_groups_hold_those_of_the_host():
    rng = random.Random(6)
    htmls = [site(rng, i, True) for i in range(40)]
    sets = [pages.parse(h).distinct() for h in htmls]
    on = Counter(t for s in sets for t in s)
    named = set()
    for a in range(0, 40, 9):
        group = sets[a : a + 9]
        local = Counter(t for s in group for t in s)
        named |= {t for t, c in local.items() if c >= pages.SUPPORT * len(group)}
    assert {t for t, c in on.items() if c >= pages.SUPPORT * 40} <= named


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p class=it's>one two</p><p>three four</p>", "one two three four"),
        ("<p><a href=x\"y'z>a</a> b</p><p>c</p>", "a b c"),
        ("<p title=\"a > b\" class = 'c > d'>x</p>y", "x y"),
        ("<p a'b>x</p><p \"q>y</p>", "x y"),
        ("<p title=>x</p><p title= >y</p>", "x y"),
        ("x<p title=\"never closed>y</p>", "x"),
        ("<p class='it>s'>x</p>", "x"),
    ],
)
def test_quotes_open_a_value_behind_an_equals_sign_only(spark, html, want):
    assert texts(spark, [(1, "http://h/1", html)]) == [(1, want)]

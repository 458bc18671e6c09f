"""Elements, text nodes and character references, against a tree built by the standard library's parser."""

import html
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from estatelake.operators import markup as mk
from estatelake.operators import reconcile, runstate
from estatelake.plans import proxies
from tests.conftest import SMALL


class Tree(HTMLParser):
    """The content of the first element of a kind and class, by depth, as its text nodes."""

    def __init__(self, tag, name):
        super().__init__(convert_charrefs=True)
        self.tag, self.name, self.depth, self.nodes, self.done = tag, name, 0, [], False

    def handle_starttag(self, tag, attrs):
        if self.depth and tag == self.tag:
            self.depth += 1
        elif not self.depth and not self.done and tag == self.tag and self.name in (dict(attrs).get("class") or "").split():
            self.depth = 1
        self.new = True

    def handle_endtag(self, tag):
        if self.depth and tag == self.tag:
            self.depth -= 1
            self.done = self.depth == 0
        self.new = True

    def handle_data(self, data):
        if self.depth:
            self.nodes.append(data)


def evaluate(spark, expression, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, h string")
    return [r.v for r in df.select("i", F.expr(expression).alias("v")).orderBy("i").collect()]


def test_references_are_decoded_like_the_standard_library(spark):
    rng = random.Random(4)
    pieces = ["&", "amp;", "#", "38", "x", "lt", ";", "#38;", "notit;", "é", "copy", "#x41", "#xD800;", "#0;", "#128", "&#13;", "acE;", "#99999999999999999999;"]
    values = [f"{a}&{n}{b}" for n in mk.NAMES for a, b in (("", ""), ("é", "b;"))] + [f"&#{i};x&#x{i:X}" for i in (*range(300), 0xD800, 0xFDD0, 0xFFFE, 0x10FFFF, 0x110000)]
    values += ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(2000)]
    assert evaluate(spark, mk.decode("h"), values) == [html.unescape(v) for v in values]
    assert evaluate(spark, mk.decode("h"), [None, ""]) == [None, ""]
    mk.register(spark)
    assert evaluate(spark, "decode_references(h)", [*values[:50], None]) == [html.unescape(v) for v in values[:50]] + [None]


def page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 4)):
        kind = rng.randrange(5)
        if kind == 0 or depth > 4:
            out.append(rng.choice(["a", " b ", "&lt;div&gt;", "x &amp; y", " ", "&nbsp;c"]))
        elif kind < 4:
            name = rng.choice(["price", "info", "price top", "other"])
            quote = rng.choice(['"', "'"])
            out.append(f"<div data-a=1 class={quote}{name}{quote}>{page(rng, depth + 1)}</div>")
        else:
            out.append(f"<span>{page(rng, depth + 1)}</span><br>")
    return "".join(out)


@pytest.mark.parametrize("name", ["price", "top"])
def test_elements_end_at_their_own_depth(spark, name):
    rng = random.Random(7)
    pages = [page(rng) for _ in range(400)]
    want = []
    for p in pages:
        t = Tree("div", name)
        t.feed(p)
        t.close()
        nodes = [n.strip() for n in t.nodes]
        want.append("|".join(n for n in nodes if n) if t.done else None)
    got = evaluate(spark, mk.let("found", mk.element(mk.tidy("h"), "div", name), f"CASE WHEN found IS NOT NULL THEN {mk.text('found', '|')} END"), pages)
    assert sum(w is not None for w in want) > 100
    assert got == want


@pytest.mark.parametrize(
    ("expression", "value", "want"),
    [
        (mk.children("h", "div"), "x<div>a<div>b</div></div>y<DIV id=1>c</div></div><div>d", ["a<div>b</div>", "c", "d"]),
        (mk.children("h", "div"), "", []),
        (mk.children("h", "div"), None, None),
        (mk.element("h", "div", "a"), "<div class=ab>1</div><div class='b a'>2<divx></div>", "2<divx>"),
        (mk.element("h", "div", "a"), "<div class=a>never <b>closed", "never <b>closed"),
        (mk.element("h", "a"), None, None),
        (mk.attribute(mk.tidy("h"), "href"), "<a data-href=1 HREF='x?a=1&amp;b=&quot;2'>", 'x?a=1&b="2'),
        (mk.attribute("h", "id"), "<div id=ida7>", "ida7"),
        (mk.attribute("h", "id"), "<div>", None),
        (mk.text(mk.tidy("h"), " "), "a<!-- <b>no</b> --> b<script>no < no</script><style>no</style><p> &#38;lt; </p>&nbsp;<i></i>", "a b &lt;"),
        (mk.text(mk.tidy("h")), "<!-- open", ""),
    ],
)
def test_awkward_markup(spark, expression, value, want):
    assert evaluate(spark, expression, [value]) == [want]


def test_missing_only_from_complete_scans(spark):
    state = spark.createDataFrame([(f"{t}{i}", i, s, t) for t in ("sale", "rental", "lease", "odd", "none") for i, s in ((1, "active"), (2, "active"), (3, "inactive"))], "source_id string, listing_id long, status string, transaction_type string")
    seen = spark.createDataFrame([(" sale1", "sale"), ("sale2", "rental"), ("rental1", "rental"), (None, "sale")], "source_id string, transaction_type string")
    expected = spark.createDataFrame([(t, r) for t in ("sale", "rental", "lease", "odd") for r in ("a", "b")], "transaction_type string, region string")
    done = [(t, r, r, "region_complete", None, 5) for t, r in (("sale", "a"), ("sale", "b"), ("rental", "a"), ("rental", "b"), ("lease", "a"), ("odd", "a"), ("odd", "b"), ("odd", "c"))]
    units = [("sale", "a", "a/x", "failed", "fetch_failed", 1), ("sale", "a", "a/x", "cleared", None, 2), ("rental", "b", "b:0-5", "cleared", None, 1), ("rental", "b", "b:0-5", "failed", "fetch_failed", 3)]
    events = spark.createDataFrame(done + units, "transaction_type string, region string, unit string, kind string, reason string, seq long")
    gate = runstate.missing_gate(expected, events)
    rows = reconcile.missing_gated(state, seen, gate)
    # sale2 was seen as a rental only; ids belong to a transaction
    assert [(r.source_id, r.listing_id, r.action, r.old_price, r.new_price) for r in rows.collect()] == [("sale2", 2, "missing", None, None)]
    report = {r.transaction_type: (r.missing_allowed, r.reason, r.missing) for r in reconcile.missing_report(rows, gate).collect()}
    assert report == {"sale": (True, "complete", 1), "rental": (False, "1 failed units", 0), "lease": (False, "1 pending regions", 0), "odd": (False, "regions that were not expected", 0)}


def test_statuses_and_ties_of_the_state(spark):
    state = spark.createDataFrame(
        [("a", 1, "sold", 5.0), ("b", 1, "inactive", 5.0), ("b", 2, "active", 6.0), ("c", 3, "active", 5.0), ("c", 9, "active", 7.0), ("c", None, "active", 8.0), ("d", None, "active", 5.0), ("e", 4, "inactive", None), ("e", 3, "inactive", 2.0), (None, 1, "active", 5.0)],
        "source_id string, listing_id long, status string, price double",
    )
    scan = spark.createDataFrame([(x, 7.0) for x in "abcdef"] + [(" ", 7.0)], "source_id string, price double")
    got = {r.source_id: (r.action, r.listing_id, r.old_price) for r in reconcile.classify(scan, state).collect()}
    assert got == {"a": ("new", None, None), "b": ("changed", 2, 6.0), "c": ("unchanged", None, None), "d": ("changed", None, 5.0), "e": ("reappeared", 4, None), "f": ("new", None, None)}


@pytest.mark.parametrize("name", ["nested_pages", "nested_details", "portal_pages", "portal_details"])
def test_pages_are_made_in_as_many_tasks_as_a_shuffle_has(spark, name):
    assert proxies.proxy(spark, SMALL, name).rdd.getNumPartitions() == 4

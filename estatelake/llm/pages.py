"""HTML extraction by template deduction over equivalence classes of tokens.

Pages of one host share a template. A page is read as a sequence of tokens: tags and words, each
with the path of open blocks it stands in (two occurrences of a tag in different places are different
tokens), and the whole text of each slot. Tokens whose occurrence vectors over the host's pages are equal form an equivalence
class. A class that is large, frequent and ordered (the same cycle of tokens on every page; words: by path) and nested (on each page
all of it in one and the same gap between the tokens of each valid class of larger support that the page has) is valid. The valid classes,
each with its parent and gap, are the template; what stands between their tokens are slots. A slot whose text or words
are themselves template (the same on the pages of the host) is boilerplate; the remaining slots hold data, and those that are page
furniture by element or class name (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) are
left out. Words and whole texts of slots count inside the article as outside of it. The main text is the data of the article's
slots, if it has any, else of all remaining slots.

At scale: pages are dealt out once by host, large hosts in groups of about ``GROUP_PAGES``, parsed there, and the parsed blocks are
staged. A token on half of a host's pages is on half of the pages of some group: so each group names its own frequent tokens, and
only these candidates are counted over all pages, exactly. An occurrence vector is never gathered: it is stood for by the number of
pages and three sums of hashes of (page, count), which tasks add up before the shuffle. A host with a third of all pages costs no task
more than its share. Classes and templates are joined with the pages by host, as a broadcast only if a sum shows them small.

Defined cases: null html is empty text; a host with fewer than ``LEAST_PAGES`` pages has no template and
falls back to elements alone; truncated or unbalanced markup is read as far as it goes; repeated
pages and pages without an id count as pages, and an article of nothing but template stays; very long pages are groups of
their own; a url without a host is one host; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import drop_staged, lean, slices, staged

#: A template token stands on at least this share of the host's pages, of which there are so many at least.
SUPPORT, LEAST_PAGES, LEAST_TOKENS = 0.5, 5, 3

# Fixed values of HTML: elements without content, of raw text, that stand inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements, roles and words of class or id that are page furniture.
FURNITURE = frozenset("head nav header footer aside form script style noscript template iframe button select option textarea input dialog menu svg canvas object embed audio video xmp noembed noframes title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer header masthead topbar "
    "cookie cookies consent gdpr notice notices banner popup modal newsletter subscribe signup login share sharing social related recommended comment comments discussion respond replies reply disqus form search pagination pager".split()
)
#: Elements that hold the article; headers inside one belong to it unless they are furniture by name.
ARTICLE = frozenset(("article", "main"))
P_ENDS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: A quote opens a value right behind an equals sign only; in an unquoted value it is a character.
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|=)*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
NAME_WORD = re.compile(r"[a-z]+")


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def is_furniture(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether an element is page furniture by its kind, role, visibility or name."""
    if tag in FURNITURE and not (tag == "header" and in_article):
        return True
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if tag in ("body", "html", *ARTICLE):
        return False
    return any(w in NAMES for k in ("class", "id") for w in NAME_WORD.findall(attrs.get(k, "").lower()))


class Block:
    """The text between two block boundaries, with the path and the number of its slot, the element around it, and how many tags
    stand before it."""

    __slots__ = ("path", "pieces", "furniture", "article", "slot", "at")

    def __init__(self, path: str, furniture: bool, article: bool, slot: int, at: int) -> None:
        self.path, self.furniture, self.article, self.slot, self.at, self.pieces = path, furniture, article, slot, at, []

    def words(self) -> list[str]:
        return "".join(self.pieces).split()


def read_page(page: str) -> tuple[list[str], list[Block]]:
    """(tag tokens in order, blocks in order). A token is the path of an element that opens or closes."""
    tokens: list[str] = []
    blocks: list[Block] = []
    stack: list[tuple[str, str, bool, bool, int]] = [("", "", False, False, 0)]  # tag, path, furniture, in the article, slot

    def block() -> Block:
        if not blocks or blocks[-1] is not current[0]:
            blocks.append(current[0])
        return blocks[-1]

    current = [Block("", False, False, 0, 0)]

    def boundary() -> None:
        current[0] = Block(*stack[-1][1:], len(tokens))

    def text(piece: str) -> None:
        if piece:
            block().pieces.append(html.unescape(piece))

    def close(tag: str) -> None:
        popped, path = stack.pop()[:2]
        if popped not in INLINE:
            tokens.append(f"/{path}")
            boundary()

    at = 0
    while at < len(page):
        m = MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, inline = m[2].lower(), m[2].lower() in INLINE
        if m[1]:
            if any(s[0] == tag for s in stack):
                while stack[-1][0] != tag:
                    close(stack[-1][0])
                if inline:
                    was = stack.pop()
                    if was[2] != stack[-1][2]:
                        boundary()
                else:
                    close(tag)
            elif tag in ("p", "br"):
                boundary()
            continue
        if not inline:
            if tag in P_ENDS and any(s[0] == "p" for s in stack):
                k = max(i for i, s in enumerate(stack) if s[0] == "p")
                if all(s[0] in INLINE or s[0] == "p" for s in stack[k:]):
                    while len(stack) > k:
                        close(stack[-1][0])
            for t in SAME_ENDS.get(tag, ()):
                if stack[-1][0] == t:
                    close(t)
        attrs = attributes(m[3] or "")
        _, path, furniture, article, slot = stack[-1]
        here = path if inline else f"{path}/{tag}"
        if not inline:
            name = ".".join(sorted(set(attrs.get("class", "").lower().split()) | ({"#" + attrs["id"].lower()} if attrs.get("id") else set())))
            here += f".{name}" if name else ""
            tokens.append(here)
        is_out = furniture or is_furniture(tag, attrs, article)
        if tag in VOID:
            if not inline:
                boundary()
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            if not inline:
                tokens.append(f"/{here}")
                boundary()
            continue
        stack.append((tag, here, is_out, article or tag in ARTICLE, slot if inline else len(tokens)))
        if not inline or is_out != furniture:
            boundary()
    return tokens, blocks


@dataclass
class Page:
    """A parsed page: its tags, and of its blocks with text the path, words (one space between), flags, slot and place among the tags.

    Tokens are tags (paths, which hold no white space), words (``path word``) and whole texts of slots (path, line end, text).
    """

    tags: list[str]
    paths: list[str]
    texts: list[str]
    furniture: list[bool]
    article: list[bool]
    slots: list[int]
    at: list[int]

    def slot_texts(self) -> dict[int, tuple[str, str]]:
        """Slot -> its path and its text, across line breaks, without furniture inside it."""
        out: dict[int, tuple[str, str]] = {}
        for path, text, furniture, slot in zip(self.paths, self.texts, self.furniture, self.slots, strict=True):
            if not furniture:
                out[slot] = (path, f"{out[slot][1]} {text}" if slot in out else text)
        return out

    def distinct(self) -> set[str | tuple[str, str]]:
        """All tokens, words as (path, word)."""
        out: set[str | tuple[str, str]] = set(self.tags)
        for path, text in zip(self.paths, self.texts, strict=True):
            out.update(zip(repeat(path), text.split(" ")))
        out.update(f"{path}\n{text}" for path, text in self.slot_texts().values())
        return out

    def found(self, wanted: Wanted) -> Iterator[tuple[str, int]]:
        """(token, place) of the wanted tokens: tags in order, words in order, and texts, just before their first word."""
        for i, t in enumerate(self.tags):
            if t in wanted.tags:
                yield t, i * WIDE
        first: dict[int, int] = {}
        last, place = None, 0
        for path, text, slot, at in zip(self.paths, self.texts, self.slots, self.at, strict=True):
            if at != last:
                last, place = at, at * WIDE - WIDE
            first.setdefault(slot, place + 1)
            known = wanted.words.get(path)
            if known:
                for k, w in enumerate(text.split(" "), 1):
                    if w in known:
                        yield f"{path} {w}", place + 2 * k
            place += 2 * (text.count(" ") + 1)
        if wanted.texts:
            for slot, (path, text) in self.slot_texts().items():
                if (t := f"{path}\n{text}") in wanted.texts:
                    yield t, first[slot]


#: Places of words between two tags.
WIDE = 1 << 32


def part_of(token: str) -> str:
    """The part of a class that a token must keep an order with: tags are one, words of one path are, a text is one by itself."""
    return token if "\n" in token else token[: token.index(" ") + 1] if " " in token else ""


class Wanted:
    """Some tokens, by kind."""

    def __init__(self, tokens: Iterable[str]) -> None:
        self.tags, self.texts, self.words = set(), set(), {}
        for t in tokens:
            if "\n" in t:
                self.texts.add(t)
            elif " " in t:
                path, word = t.split(" ", 1)
                self.words.setdefault(path, set()).add(word)
            else:
                self.tags.add(t)


def parse(html_text: str) -> Page:
    tags, blocks = read_page(html_text)
    found = [(b, " ".join(w)) for b in blocks if (w := b.words())]
    return Page(tags, [b.path for b, _ in found], [t for _, t in found], [b.furniture for b, _ in found], [b.article for b, _ in found], [b.slot for b, _ in found], [b.at for b, _ in found])


def main_text(page: Page, template: Wanted) -> str:
    """Data of the article's slots, or of all slots that are neither furniture nor template. An article that is nothing but
    template, as on a host of copies, stays."""
    boilerplate = set()
    if template.texts or template.words:
        for slot, (path, text) in page.slot_texts().items():
            known = template.words.get(path)
            if f"{path}\n{text}" in template.texts or (known and known.issuperset(text.split(" "))):
                boilerplate.add(slot)
    kept = [i for i, f in enumerate(page.furniture) if not f]
    data = [i for i in kept if page.slots[i] not in boilerplate]
    chosen = [i for i in data if page.article[i]] or data or [i for i in kept if page.article[i]]
    return " ".join(page.texts[i] for i in chosen)


# -- the Spark jobs -------------------------------------------------------------------------------

#: Pages and bytes of a group, in which frequent tokens are named.
GROUP_PAGES, GROUP_BYTES = 100, 8 << 20
PARSED = "host string, page_id long, url string, key long, tags array<string>, paths array<string>, texts array<string>, flags array<int>, slots array<int>, at array<int>, pages int, frequent array<string>"
_PARSED = pa.schema([
    ("host", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("key", pa.int64()), *((c, pa.list_(pa.string())) for c in ("tags", "paths", "texts")),
    *((c, pa.list_(pa.int32())) for c in ("flags", "slots", "at")), ("pages", pa.int32()), ("frequent", pa.list_(pa.string())),
])


KEYED = "host string, part int, page_id long, url string, key long"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages travel compressed."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    names = [x.split()[0] for x in KEYED.split(", ")]
    for whole in batches:
        for batch in slices(whole, "html"):
            data = [pack((t or "").encode("utf-8")) for t in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(data, pa.binary())], names=[*names, "data"])


def _parse_groups(support: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each page, and one for each group with its number of pages and its frequent tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        on: Counter[str | tuple[str, str]] = Counter()
        key, n, size = None, 0, 0

        def group() -> pa.RecordBatch:
            frequent = [t if isinstance(t, str) else " ".join(t) for t, c in on.items() if c >= support * n]
            return pa.RecordBatch.from_pylist([{"host": key[0], "pages": n, "frequent": frequent}], schema=_PARSED)

        for whole in batches:
            for batch in slices(whole, "data", 1 << 18):
                rows = []
                for host, part, page_id, url, mark, data in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "page_id", "url", "key", "data")), strict=True):
                    text = unpack(data).decode("utf-8")
                    if n and (key != (host, part) or size > GROUP_BYTES):
                        yield group()
                        on.clear()
                        n = size = 0
                    key = host, part
                    page = parse(text)
                    on.update(page.distinct())
                    n, size = n + 1, size + len(text)
                    flags = [f + 2 * a for f, a in zip(page.furniture, page.article, strict=True)]
                    rows.append({"host": host, "page_id": page_id, "url": url, "key": mark, "tags": page.tags, "paths": page.paths, "texts": page.texts, "flags": flags, "slots": page.slots, "at": page.at})
                yield pa.RecordBatch.from_pylist(rows, schema=_PARSED)
        if n:
            yield group()

    return task


def _pages_of(batch: pa.RecordBatch) -> Iterator[Page]:
    for tags, paths, texts, flags, slots, at in zip(*(batch.column(c).to_pylist() for c in ("tags", "paths", "texts", "flags", "slots", "at")), strict=True):
        yield Page(tags, paths, texts, [f % 2 == 1 for f in flags], [f >= 2 for f in flags], slots, at)


_COLUMNS = ("tags", "paths", "texts", "flags", "slots", "at")
VECTORS = "host string, token string, on long, v1 long, v2 long, v3 long"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Support and sums of hashes of (page, count) of each candidate token, added up over the pages of the task."""
    held: str | None = None
    sums: dict[str, list[int]] = {}
    wanted = Wanted(())

    def out() -> pa.RecordBatch:
        columns = [pa.array([held] * len(sums), pa.string()), pa.array(sums, pa.string()), *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(4))]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in VECTORS.split(", ")])

    for batch in batches:
        for host, key, candidates, page in zip(batch.column("host").to_pylist(), batch.column("key").to_pylist(), batch.column("candidates"), _pages_of(batch), strict=True):
            if host != held:
                if sums:
                    yield out()
                held, sums, wanted = host, {}, Wanted(candidates.as_py())
            marks: dict[int, int] = {}
            for t, n in Counter(t for t, _ in page.found(wanted)).items():
                if n not in marks:
                    marks[n] = xxhash.xxh3_128_intdigest(f"{key} {n}")
                h, s = marks[n], sums.setdefault(t, [0, 0, 0, 0])
                s[0] += 1
                s[1] += h & 0x7FFFFFFF
                s[2] += h >> 31 & 0x7FFFFFFF
                s[3] += h >> 62 & 0x7FFFFFFF
    if sums:
        yield out()


def _cycle(seen: list[str]) -> tuple[str, ...]:
    """The tokens of a class in order, once if they come in equal rounds."""
    n = len(set(seen))
    return tuple(seen[:n]) if len(seen) % n == 0 and seen == seen[:n] * (len(seen) // n) else tuple(seen)


ORDERS = "host string, class long, order long, outer long, gap long"


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class: in which order its tokens come (outer: null), and in which gap of each class of larger support it lies (-1: in
    more than one); each different finding once for the pages of a host in the task."""
    held: str | None = None
    found: set[tuple[int, int | None, int | None, int | None]] = set()
    of: dict[str, int] = {}
    wanted = Wanted(())
    rank: dict[int, int] = {}

    def out() -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array([held] * len(found), pa.string()), *(pa.array(list(c), pa.int64()) for c in columns)], names=[x.split()[0] for x in ORDERS.split(", ")])

    for batch in batches:
        for host, classes, page in zip(batch.column("host").to_pylist(), batch.column("classes"), _pages_of(batch), strict=True):
            if host != held:
                if found:
                    yield out()
                listed = classes.as_py()
                held, found = host, set()
                of = {t: c["class"] for c in listed for t in c["tokens"]}
                wanted = Wanted(of)
                # larger support first, then more tokens
                rank = {c["class"]: i for i, c in enumerate(sorted(listed, key=lambda c: (-c["support"], -len(c["tokens"]), c["class"])))}
            seen: dict[int, list[tuple[int, str]]] = {}
            for t, place in page.found(wanted):
                seen.setdefault(of[t], []).append((place, t))
            places = {c: sorted(x) for c, x in seen.items()}
            starts = {c: [p for p, _ in x] for c, x in places.items()}
            for c, x in places.items():
                found.add((c, xxhash.xxh64_intdigest(repr(_cycle([t for _, t in x]))) - (1 << 63), None, None))
                for outer, y in starts.items():
                    if rank[outer] < rank[c]:
                        first = bisect_left(y, x[0][0])
                        found.add((c, None, outer, first if first == bisect_right(y, x[-1][0]) else -1))
    if found:
        yield out()


TEMPLATE = "host string, template array<struct<class:long,parent:long,gap:long,support:long,tokens:array<string>>>"


def nest(classes: list[dict], unordered: set[int], gaps: dict[tuple[int, int], int]) -> list[dict]:
    """The valid classes with their parents: those in order that lie in one gap of each valid class of larger support that they meet.
    The parent is the innermost of these: the last one in the order of support."""
    out: list[dict] = []
    for c in sorted(classes, key=lambda c: (-c["support"], -len(c["tokens"]), c["class"])):
        met = [(p["class"], gaps[c["class"], p["class"]]) for p in out if (c["class"], p["class"]) in gaps]
        if c["class"] not in unordered and all(g >= 0 for _, g in met):
            parent, gap = met[-1] if met else (None, None)
            out.append({**c, "parent": parent, "gap": gap})
    return out


def _nest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, out = [], []
        for r in batch.to_pylist():
            hosts.append(r["host"])
            gaps = {(g["class"], g["outer"]): g["gap"] for g in r["gaps"] or ()}
            out.append(nest(r["classes"], set(r["unordered"] or ()), gaps))
        kind = pa.list_(pa.struct([*((k, pa.int64()) for k in ("class", "parent", "gap", "support")), ("tokens", pa.list_(pa.string()))]))
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(out, kind)], names=["host", "template"])


#: Tables by host of up to so many tokens in all (about 16 MB) are sent to all tasks; larger ones are joined by a shuffle on the host.
BROADCAST_TOKENS = 200_000


def _join_hosts(pages: DataFrame, by_host: DataFrame, size: Column, how: str) -> DataFrame:
    right = by_host.withColumnRenamed("host", "_host")
    few = (by_host.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_TOKENS
    return pages.join(F.broadcast(right) if few else right, F.col("host") == F.col("_host"), how).drop("_host")


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    # rows are numbered where they are read: behind a join a task that runs again would number them in another order
    held = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], pages["html"], F.monotonically_increasing_id().alias("nth"))
    return held.withColumn("host", host)


def parsed_pages(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Pages dealt out by host and group, parsed, with a row of frequent tokens for each group. Staged."""
    with_host = _with_host(pages)
    groups = with_host.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / GROUP_PAGES).cast("int").alias("groups"))
    keyed = _join_hosts(with_host, groups, F.lit(4), "inner").withColumn("key", F.xxhash64("page_id", "html"))
    placed = keyed.withColumn("part", F.pmod(F.xxhash64("key", "nth"), F.col("groups")).cast("int"))
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = placed.select("host", "part", "page_id", "url", "key", "html").mapInArrow(lean(_packed), f"{KEYED}, data binary")
    dealt = packed.repartition(n, "host", "part").sortWithinPartitions("host", "part")
    return staged(dealt.mapInArrow(lean(_parse_groups(support)), PARSED), "parsed-pages")


def deduce_templates(parsed: DataFrame, support: float = SUPPORT) -> DataFrame:
    """host, template (its valid equivalence classes, each with parent and gap) for hosts of LEAST_PAGES or more."""
    groups = parsed.where("pages IS NOT NULL")
    totals = groups.groupBy("host").agg(F.sum("pages").alias("total")).where(F.col("total") >= LEAST_PAGES)
    named = groups.select("host", F.explode("frequent").alias("token")).distinct().groupBy("host").agg(F.collect_list("token").alias("candidates"))
    candidates = staged(named.join(totals.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host")).drop("_host"), "candidate-tokens")
    rows = parsed.where("pages IS NULL")
    vectors = _join_hosts(rows.select("host", "key", *_COLUMNS), candidates.select("host", "candidates"), F.size("candidates"), "inner").mapInArrow(lean(_vectors), VECTORS)
    exact = vectors.groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("on", "v1", "v2", "v3"))).where(F.col("on") >= LEAST_PAGES)
    frequent = _join_hosts(exact, candidates.select("host", "total"), F.lit(2), "inner").where(F.col("on") >= support * F.col("total"))
    # as part_of() says
    part = F.when(F.col("token").contains("\n"), F.col("token")).when(F.col("token").contains(" "), F.substring_index("token", " ", 1)).otherwise("")
    classes = frequent.groupBy("host", "on", "v1", "v2", "v3").agg(F.collect_list(F.struct(part.alias("part"), "token")).alias("members")).where(F.size("members") >= LEAST_TOKENS)
    # an article's words that fall into a class by chance keep no order: they must not cost the class more than the words of their path
    parts = classes.select("host", "on", F.xxhash64("on", "v1", "v2", "v3").alias("v"), F.explode("members").alias("x")).groupBy("host", "on", F.xxhash64("v", "x.part").alias("class")).agg(F.collect_list("x.token").alias("tokens"))
    by_host = staged(parts.groupBy("host").agg(F.collect_list(F.struct("class", F.col("on").alias("support"), "tokens")).alias("classes")), "token-classes")
    orders = _join_hosts(rows.select("host", *_COLUMNS), by_host, F.size(F.flatten("classes.tokens")), "inner").mapInArrow(lean(_orders), ORDERS)
    seen = orders.groupBy("host", "class", "outer").agg(F.min("order").alias("a"), F.max("order").alias("b"), F.min("gap").alias("g"), F.max("gap").alias("h"))
    said = seen.groupBy(F.col("host").alias("_host")).agg(
        F.collect_list(F.when(F.col("outer").isNull() & (F.col("a") != F.col("b")), F.col("class"))).alias("unordered"),
        F.collect_list(F.when(F.col("outer").isNotNull(), F.struct("class", "outer", F.when(F.col("g") == F.col("h"), F.col("g")).otherwise(-1).alias("gap")))).alias("gaps"),
    )
    nested = by_host.join(said, F.col("host") == F.col("_host")).select("host", "classes", "unordered", "gaps").mapInArrow(lean(_nest), TEMPLATE)
    templates = staged(nested, "templates")
    drop_staged(candidates, by_host)
    return templates


RESULT = "page_id long, url string, text string, n_chars long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, tokens = None, Wanted(())
    for batch in batches:
        out = []
        for host, template, page in zip(batch.column("host").to_pylist(), batch.column("tokens"), _pages_of(batch), strict=True):
            if host != held:
                held, tokens = host, Wanted(template.as_py() or ())
            out.append(main_text(page, tokens))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page."""
    parsed = parsed_pages(pages)
    tokens = deduce_templates(parsed).select("host", F.flatten("template.tokens").alias("tokens"))
    joined = _join_hosts(parsed.where("pages IS NULL").select("host", "page_id", "url", *_COLUMNS), tokens, F.size("tokens"), "left")
    return joined.mapInArrow(lean(_extract), RESULT)

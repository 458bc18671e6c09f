"""Secret scans by one combined deterministic automaton.

All rules are compiled together: regex -> position automaton -> subset construction ->
minimisation -> transition arrays. A text is scanned once, byte by byte, for all rules; only
where some rule accepts are that rule's start (a backward automaton) and longest end (a forward
one) looked up. Texts are UTF-8 bytes; spans are given in code points.

Defined cases: a null or empty text has no spans; an empty table gives an empty
result; extra columns are ignored; repeated rows give repeated results; very long texts take memory in proportion to
their own length only; ties (several rules at one place) are ordered by start, then rule order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from estatelake.llm.common import lean, slices


@dataclass(frozen=True)
class Rule:
    """A pattern over bytes; ``least`` bytes must be in the match, ``tail_least`` in the value behind its
    separator, else the match is dropped. Letters of ``nocase_prefix`` stand in either case."""

    name: str
    pattern: str
    nocase_prefix: str = ""
    least: int = 0
    tail_least: int = 0


#: The three base kinds of the contract. The hexadecimal rule may count inside the automaton,
#: since its matches are whole runs either way.
BASE = (
    Rule("assign", r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"(password|passwd|secret|token|api_?key)", tail_least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)
#: Further kinds, the public formats of tokens, and key files. Lengths are asked of the match, not counted in
#: the automaton, which stays small.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("private_key", r"-----BEGIN[A-Z ]* PRIVATE KEY-----"),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]+", least=26),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("npm", r"npm_[A-Za-z0-9]+", least=40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)


# -- regex -> syntax tree -------------------------------------------------------------------------
# Nodes: ("set", frozenset of bytes), ("cat", [..]), ("alt", [..]), ("star", x), ("eps",)


def parse(pattern: str, nocase: bool = False) -> tuple:
    """A small byte-regex grammar: literals, \\x and \\. escapes, classes, groups, |, ?, *, +, {m,}, {m,n}, {m}."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "\\":
            c = pattern[at]
            at += 1
            if c == "x":
                at += 2
                return int(pattern[at - 2 : at], 16)
        return ord(c)

    def fold(chars: set[int]) -> tuple:
        if nocase:
            chars = chars | {ord(chr(c).swapcase()) for c in chars if c < 128 and chr(c).isalpha()}
        return ("set", frozenset(chars))

    def char_class() -> tuple:
        nonlocal at
        out: set[int] = set()
        while pattern[at] != "]":
            low = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                out |= set(range(low, char() + 1))
            else:
                out.add(low)
        at += 1
        return fold(out)

    def repeat(node: tuple) -> tuple:
        nonlocal at
        while at < len(pattern) and pattern[at] in "?*+{":
            c = pattern[at]
            at += 1
            if c == "?":
                node = ("alt", [node, ("eps",)])
            elif c == "*":
                node = ("star", node)
            elif c == "+":
                node = ("cat", [node, ("star", node)])
            else:
                end = pattern.index("}", at)
                low, _, high = pattern[at:end].partition(",")
                least, bounded = int(low), "," not in pattern[at:end] or high
                most = int(high or low)
                at = end + 1
                rest = [("alt", [node, ("eps",)])] * (most - least) if bounded else [("star", node)]
                node = ("cat", [node] * least + rest)
        return node

    def alternatives() -> tuple:
        nonlocal at
        options, seq = [], []
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                options.append(("cat", seq))
                seq = []
                continue
            if pattern[at] == "(":
                at += 1
                node = alternatives()
                at += 1
            elif pattern[at] == "[":
                at += 1
                node = char_class()
            else:
                node = fold({char()})
            seq.append(repeat(node))
        return ("alt", [*options, ("cat", seq)])

    return alternatives()


def backwards(node: tuple) -> tuple:
    if node[0] == "cat":
        return ("cat", [backwards(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [backwards(x) for x in node[1]])
    return ("star", backwards(node[1])) if node[0] == "star" else node


def without_tail(node: tuple) -> tuple:
    """The pattern without repetitions at its end, which change where a match ends but not whether there is one."""
    if node[0] == "cat":
        parts = list(node[1])
        while parts and parts[-1][0] == "star":
            parts.pop()
        return ("cat", [*parts[:-1], without_tail(parts[-1])]) if parts else ("eps",)
    return ("alt", [without_tail(x) for x in node[1]]) if node[0] == "alt" else node


# -- syntax tree -> automaton ---------------------------------------------------------------------


class Positions:
    """The position automaton of some rules: which bytes a position reads and which may follow it."""

    def __init__(self) -> None:
        self.reads: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.first: set[int] = set()
        self.accepts: dict[int, int] = {}

    def add(self, node: tuple, mark: int) -> None:
        _, first, last = self._walk(node)
        self.first |= first
        for p in last:
            self.accepts[p] = self.accepts.get(p, 0) | mark

    def _walk(self, node: tuple) -> tuple[bool, set[int], set[int]]:
        """(may be empty, first positions, last positions)"""
        kind = node[0]
        if kind == "eps":
            return True, set(), set()
        if kind == "set":
            self.reads.append(node[1])
            self.follow.append(set())
            p = {len(self.reads) - 1}
            return False, p, p
        if kind == "star":
            _, first, last = self._walk(node[1])
            for p in last:
                self.follow[p] |= first
            return True, first, last
        parts = [self._walk(x) for x in node[1]]
        if kind == "alt":
            return any(p[0] for p in parts), set().union(*(p[1] for p in parts)), set().union(*(p[2] for p in parts))
        empty, first, last = True, set(), set()
        for e, f, l in parts:
            for p in last:
                self.follow[p] |= f
            first = first | f if empty else first
            last = last | l if e else l
            empty = empty and e
        return empty, first, last


def byte_classes(reads: list[frozenset[int]]) -> tuple[list[int], list[int]]:
    """Bytes that no position tells apart share a class: (class of each byte, a byte of each class)."""
    seen: dict[tuple[bool, ...], int] = {}
    of, sample = [], []
    distinct = list(dict.fromkeys(reads))
    for b in range(256):
        key = tuple(b in r for r in distinct)
        if key not in seen:
            seen[key] = len(seen)
            sample.append(b)
        of.append(seen[key])
    return of, sample


def determinise(auto: Positions, anywhere: bool) -> tuple[list[list[int]], list[int], list[int]]:
    """Subset construction: (next state by state and byte class, accept mask by state, class of each byte).

    State 0 is the start. ``anywhere``: a match may start at any byte. A dead state is an ordinary state.
    """
    of, sample = byte_classes(auto.reads)
    can = [frozenset(p for p, r in enumerate(auto.reads) if b in r) for b in sample]
    start = (frozenset(), True)  # (positions just read, at the start)
    states, todo, table = {start: 0}, [start], []
    while len(table) < len(todo):
        held, fresh = todo[len(table)]
        may = set(auto.first) if fresh or anywhere else set()
        for p in held:
            may |= auto.follow[p]
        row = []
        for c in can:
            to = (frozenset(may & c), False) if not anywhere else (frozenset(may & c), True)
            if to not in states:
                states[to] = len(todo)
                todo.append(to)
            row.append(states[to])
        table.append(row)
    masks = []
    for held, _ in todo:
        m = 0
        for p in held:
            m |= auto.accepts.get(p, 0)
        masks.append(m)
    return table, masks, of


def minimise(table: list[list[int]], masks: list[int]) -> tuple[list[list[int]], list[int]]:
    """Partition refinement: states stay apart as long as their masks or the blocks of their successors differ."""
    block, count = list(masks), len(set(masks))
    while True:
        names: dict[tuple, int] = {}
        block = [names.setdefault((block[s], *(block[t] for t in table[s])), len(names)) for s in range(len(table))]
        if len(names) == count:
            break
        count = len(names)
    rows: dict[int, list[int]] = {}
    for s, b in enumerate(block):
        rows.setdefault(b, [block[t] for t in table[s]])
    first = dict.fromkeys(block)  # the start's block comes first
    order = {b: i for i, b in enumerate(first)}
    out = [[order[t] for t in rows[b]] for b in first]
    mask_of = dict(zip(block, masks, strict=True))
    return out, [mask_of[b] for b in first]


class Dfa:
    """Transition arrays as linked rows: row[byte] is the next row, row[256] the number of the set of rules that accept
    there (0: none; ``sets`` has their masks), row[257] 1 if no byte leads out (dead)."""

    def __init__(self, auto: Positions, anywhere: bool) -> None:
        table, masks, of = determinise(auto, anywhere)
        table, masks = minimise(table, masks)
        self.states = len(table)
        self.sets = sorted({0, *masks})
        number = {m: i for i, m in enumerate(self.sets)}
        rows: list[list] = [[] for _ in table]
        for s, row in enumerate(rows):
            row.extend(rows[table[s][c]] for c in of)
            row.append(number[masks[s]])
            row.append(int(not masks[s] and set(table[s]) == {s}))
        self.start = rows[0]

    def longest(self, data: bytes) -> int:
        """Length of the longest match at the start of data, -1 if none."""
        row, best = self.start, -1
        for i, b in enumerate(data):
            row = row[b]
            if row[256]:
                best = i + 1
            elif row[257]:
                break
        return best


class Scanner:
    """All rules in one automaton, which says where a rule's shortest matches end (so that rules in the middle of a long tail do
    not multiply its states), with a backward and a forward automaton for each rule."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        union, self.back, self.ahead = Positions(), [], []
        for k, r in enumerate(rules):
            tree = ("cat", [parse(r.nocase_prefix, nocase=True), parse(r.pattern)])
            union.add(without_tail(tree), 1 << k)
            for found, t in ((self.back, backwards(tree)), (self.ahead, tree)):
                one = Positions()
                one.add(t, 1)
                found.append(Dfa(one, anywhere=False))
        self.union = Dfa(union, anywhere=True)
        #: By rule: which numbers of accept sets hold it.
        self.accepting = [np.array([bool(m >> k & 1) for m in self.union.sets]) for k in range(len(rules))]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in bytes, leftmost and non-overlapping for each rule, longest at its start."""
        numbers = map(itemgetter(256), accumulate(data, getitem, initial=self.union.start))
        flags = np.frombuffer(bytes(numbers), np.uint8) if len(self.union.sets) <= 256 else np.fromiter(numbers, np.uint32, len(data) + 1)
        places = np.flatnonzero(flags)
        if not len(places):
            return []
        found = flags[places]
        out = []
        for k, rule in enumerate(self.rules):
            hits = places[self.accepting[k][found]].tolist()
            free = i = 0
            while i < len(hits):
                n = self.back[k].longest(memoryview(data)[free : hits[i]][::-1])
                if n < 0:
                    i += 1
                    continue
                start = hits[i] - n
                free = start + self.ahead[k].longest(memoryview(data)[start:])
                if free - start >= rule.least and free - self._tail(rule, data, start, free) >= rule.tail_least:
                    out.append((start, k, free))
                i = bisect_right(hits, free, i)
        return sorted(out)

    @staticmethod
    def _tail(rule: Rule, data: bytes, start: int, end: int) -> int:
        """Where the trailing group starts: after the separator, spaces and a quote."""
        if not rule.tail_least:
            return start
        at = start
        while data[at] not in b":=":
            at += 1
        at += 1
        while data[at] == 0x20:
            at += 1
        return at + (data[at] in b"\"'")


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once in each Python worker."""
    return Scanner(rules)


def code_points(data: bytes, places: list[int]) -> dict[int, int]:
    """Byte offsets (ascending) -> code point offsets."""
    out, at, n = {}, 0, 0
    for p in places:
        n += len(data[at:p].decode("utf-8"))
        at = p
        out[p] = n
    return out


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """One row for each document: its id, counts of the base kinds, a digest of their spans and all spans
    as ``kind:start:end`` by start, then rule order. No shuffle: each task scans the texts it reads."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(_scan_task(rules)), SCHEMA)


def _scan_task(rules: tuple[Rule, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [r.name for r in rules]
    base = {r.name for r in BASE}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(rules)
        for whole in batches:
            for batch in slices(whole, "text"):
                out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
                for text in batch.column("text").to_pylist():
                    data = (text or "").encode("utf-8", "surrogatepass")
                    spans = scan.spans(data)
                    at = code_points(data, sorted({p for s, _, e in spans for p in (s, e)})) if spans else {}
                    said = [(names[k], f"{names[k]}:{at[s]}:{at[e]}") for s, k, e in spans]
                    for n in ("assign", "access", "hex"):
                        out[f"n_{n}"].append(sum(x[0] == n for x in said))
                    out["base_sha256"].append(hashlib.sha256(",".join(x for n, x in said if n in base).encode()).hexdigest())
                    out["spans"].append(",".join(x for _, x in said))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(out[f"n_{n}"], pa.int64()) for n in ("assign", "access", "hex")), pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return task

"""HTML as text: elements by depth, text nodes and character references, as Spark SQL expressions.

Functions take an expression (a column's name, say) and give one, as texts, so that they can be nested; ``F.expr`` makes a column of the result. What an
expression needs more than once is bound to a name with ``let``, so that a plan holds each part once, whatever is built from it.
"""

from __future__ import annotations

import html
import html.entities
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def literal(x: str) -> str:
    """A string literal; every character but plain ones is written by its code."""
    return "'" + "".join(c if c.isascii() and c.isalnum() or c in " -_.,:;#=<>/()[]{}^?*+|&!" else "\\\\" if c == "\\" else f"\\u{ord(c):04x}" if ord(c) < 0x10000 else f"\\U{ord(c):08x}" for c in x) + "'"


def let(name: str, x: str, body: str) -> str:
    """body with a name for x in it, which is evaluated once."""
    return f"get(transform(array({x}), {name} -> {body}), 0)"


# -- character references -------------------------------------------------------------------------

#: All names of HTML with the characters they stand for; those without a semicolon at their end may go without one.
NAMES = html.entities.html5
OPEN_NAMES = sorted((n for n in NAMES if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers that are controls but stand for a character all the same: those of a one-byte code page, as HTML reads them, zero and the carriage return.
_MOVED = {0: "�", 13: "\r", **{b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0)}}


def _table(entries: dict[str, str]) -> str:
    return f"from_json({literal(json.dumps(entries))}, 'map<string,string>')"


def _character(code: str) -> str:
    """The character of a code point; what is none is the replacement character, controls and non-characters are left out."""
    control = f"{code} BETWEEN 1 AND 8 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} BETWEEN 127 AND 159 OR {code} BETWEEN 64976 AND 65007 OR pmod({code}, 65536) >= 65534"
    moved = f"try_element_at({_table({str(k): v for k, v in _MOVED.items()})}, CAST({code} AS STRING))"
    own = f"decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32')"
    return f"CASE WHEN {code} BETWEEN 55296 AND 57343 OR {code} > 1114111 THEN {literal(_MOVED[0])} ELSE coalesce({moved}, CASE WHEN {control} THEN '' ELSE {own} END) END"


def _reference(piece: str) -> str:
    """What the reference stands for that a piece of text, which starts with an ampersand, starts with, and what follows it: (char, rest), null if it starts with
    none."""
    digits, hexes = (f"regexp_extract({piece}, {literal(p)}, 1)" for p in (r"\A&#(\d+)", r"\A&#[xX]([0-9a-fA-F]+)"))
    # more digits than any code point has stand for none
    short = lambda d: f"CASE WHEN length(ltrim('0', {d})) <= 9 THEN {d} END"
    code = f"coalesce(try_cast(CASE WHEN {digits} <> '' THEN {short(digits)} ELSE conv({short(hexes)}, 16, 10) END AS BIGINT), 1114112)"
    number = f"struct({let('code', code, _character('code'))} AS char, regexp_replace({piece}, {literal(r'\A&#(?:\d+|[xX][0-9a-fA-F]+);?')}, '') AS rest)"
    names = f"array(regexp_extract({piece}, {literal(r'\A&([A-Za-z][A-Za-z0-9]{0,31};)')}, 1), regexp_extract({piece}, {literal(rf'\A&({"|".join(OPEN_NAMES)})')}, 1))"
    known = f"filter(transform({names}, n -> struct(try_element_at({_table(NAMES)}, n) AS char, substring({piece}, length(n) + 2) AS rest)), k -> k.char IS NOT NULL)"
    return f"CASE WHEN {piece} LIKE '&#%' THEN CASE WHEN {digits} <> '' OR {hexes} <> '' THEN {number} END ELSE get({known}, 0) END"


#: Characters that mean something in markup, and the non-characters that stand for them while a page's references are decoded but its tags still stand.
_MARKUP, _STAND_INS = (literal(x) for x in ("<>&\"'", "﷐﷑﷒﷓﷔"))


def decoded(x: str) -> str:
    """x with its character references decoded, from left to right and each once; decoded characters that mean something in markup are stand-ins
    until ``plain``, so that this can be done once for a page, before anything is cut out of it."""
    put = let("found", _reference("piece"), f"coalesce(concat(translate(found.char, {_MARKUP}, {_STAND_INS}), found.rest), piece)")
    one = f"CASE WHEN piece RLIKE {literal(r'\A&[#A-Za-z]')} THEN {put} ELSE piece END"
    return let("whole", x, f"CASE WHEN contains(whole, '&') THEN array_join(transform(split(whole, '(?=&)'), piece -> {one}), '') ELSE whole END")


def plain(x: str) -> str:
    return f"translate({x}, {_STAND_INS}, {_MARKUP})"


def decode(x: str) -> str:
    """Text with its character references decoded: what one of them gives is not read again."""
    return plain(decoded(x))


def register(spark: SparkSession, name: str = "decode_references") -> None:
    """The decoder for SQL, in Arrow batches."""

    @F.pandas_udf("string")
    def unescaped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(html.unescape, na_action="ignore")

    spark.udf.register(name, unescaped)


# -- elements -------------------------------------------------------------------------------------


def tidy(x: str) -> str:
    """A page without comments, scripts and styles (a mark that ends a text node stays), references decoded: what all functions below read."""
    return decoded(f"regexp_replace({x}, {literal(r'(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?</\1\s*>')}, '<!>')")


def _attribute(name: str, value: str, last: str) -> str:
    """A pattern of an attribute in any quotes; value is a pattern with {q} for what may stand in them, last ends an unquoted value."""
    in_quotes = "|".join(q + value.replace("{q}", f"[^{q}]") + q for q in ('"', "'"))
    return rf"\s{name}\s*=\s*(?:{in_quotes}|{value.replace('{q}', r'[^\s>]')}{last})"


def open_tag(tag: str, name: str | None = None) -> str:
    """A pattern of a start tag, with a class name if one is given."""
    if name is None:
        return rf"<{tag}\b[^>]*>"
    return rf"<{tag}(?=\s)[^>]*?{_attribute('class', rf'(?:{{q}}*\s)?{name}(?:\s{{q}}*)?', r'(?=[\s>])')}[^>]*>"


def id_tag(tag: str, prefix: str) -> str:
    """A pattern of the beginning of a start tag whose id starts with a prefix."""
    return rf"<{tag}(?=\s)[^>]*?\sid\s*=\s*[\"']?{prefix}"


def has(x: str, pattern: str) -> str:
    return f"({x}) RLIKE {literal(f'(?i){pattern}')}"


def start_tag(x: str, tag: str, name: str | None = None) -> str:
    return f"nullif(regexp_extract({x}, {literal(f'(?is){open_tag(tag, name)}')}, 0), '')"


def attribute(tag: str, name: str) -> str:
    """Value of an attribute of a start tag, null without it."""
    pattern = literal(rf"(?is)\A<[^>]*?\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
    value = ", ".join(f"regexp_extract(tag, {pattern}, {i})" for i in (1, 2, 3))
    return let("tag", tag, f"CASE WHEN tag RLIKE {pattern} THEN {plain(f'concat({value})')} END")


def _pieces(x: str, tag: str) -> str:
    """x cut before each start and end tag of a kind."""
    return f"split({x}, {literal(rf'(?i)(?=</?{tag}(?![\w-]))')})"


def _without_tag(x: str) -> str:
    """What follows the start tag that x begins with."""
    return f"substring({x}, locate('>', {x}) + 1)"


def inside(x: str, tag: str) -> str:
    """Content of the element whose start tag x begins with, up to the end tag of the same depth, or all of x if none closes it."""
    closed = "acc.n > 0 AND acc.depth = 0"
    fold = f"aggregate(cut, struct(0 AS depth, 0 AS n), (acc, p) -> CASE WHEN {closed} THEN acc ELSE struct(acc.depth + CASE WHEN startswith(p, '</') THEN -1 ELSE 1 END AS depth, acc.n + 1 AS n) END)"
    content = let("acc", fold, f"array_join(slice(cut, 1, CASE WHEN {closed} THEN acc.n - 1 ELSE acc.n END), '')")
    return let("held", let("cut", _pieces(x, tag), content), _without_tag("held"))


def element(x: str, tag: str, name: str | None = None) -> str:
    """Content of the first element of a kind, and class, with all that is nested in it; null without one."""
    return let("found", f"regexp_extract({x}, {literal(f'(?is){open_tag(tag, name)}.*')}, 0)", f"CASE WHEN found <> '' THEN {inside('found', tag)} END")


def children(x: str, tag: str) -> str:
    """Contents of all elements of a kind that are in no other of that kind, in order."""
    start = "struct(0 AS depth, '' AS held, CAST(array() AS ARRAY<STRING>) AS out)"
    depth = "greatest(acc.depth + CASE WHEN startswith(p, '</') THEN -1 ELSE 1 END, 0)"
    step = f"struct({depth} AS depth, CASE WHEN {depth} > 0 THEN concat(acc.held, p) ELSE '' END AS held, CASE WHEN acc.depth > 0 AND {depth} = 0 THEN array_append(acc.out, acc.held) ELSE acc.out END AS out)"
    # what stands before the first tag is a piece of its own, whatever it begins with
    cut = let("cut", _pieces(f"concat('.', {x})", tag), "slice(cut, 2, size(cut))")
    whole = let("acc", f"aggregate({cut}, {start}, (acc, p) -> {step})", "CASE WHEN acc.held <> '' THEN array_append(acc.out, acc.held) ELSE acc.out END")
    return f"transform({whole}, e -> {_without_tag('e')})"


# -- text -----------------------------------------------------------------------------------------

#: White space of any alphabet.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(x: str) -> str:
    """Without white space at both ends."""
    return f"trim(BOTH {literal(SPACES)} FROM {x})"


def texts(x: str) -> str:
    """The text nodes of a fragment, stripped, empty ones left out."""
    return f"filter(transform(split({x}, '<[^>]*>'), t -> {strip('t')}), t -> t <> '')"


def text(x: str, separator: str = "") -> str:
    """The text nodes of a fragment put together."""
    return plain(f"array_join({texts(x)}, {literal(separator)})")

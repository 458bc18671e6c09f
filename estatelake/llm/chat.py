"""Chat formatting by prefix-target expansion, with DataFrame functions only.

A template writes each turn as ``start role sep text end``. Control strings inside roles and texts are broken by a backslash behind their first character, and
backslashes are doubled, so that no control string but the template's own stands in the output and every text can be had back.

Every assistant turn becomes an example of its own: all turns before it are its context, and only its text is trainable. ``expand`` writes every example
out whole, context and target, with the characters that its loss mask covers, and the turns that no example holds; ``chat_report`` reads these rows
back. The contexts of a conversation are as long as all its prefixes together, which grows with the square of its length, as the method has it. No row is longer than
a conversation, and the examples of a long one are dealt over tasks, ``TOGETHER`` to each.

Turns are put in order over ranges (conversation, turn), and one row for each range that a conversation runs through carries how many turns,
characters and examples came before, so that a conversation of any length is many tasks.

Defined cases: null texts and roles count as empty; a null turn comes first; rows that repeat a turn go by role, then by a hash of their text, and all
count; rows without a conversation id are one conversation; a conversation without assistant turns is formatted and has no example; turns
behind the last assistant turn are in no example; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import drop_staged, staged


@dataclass(frozen=True)
class Template:
    """Marks around turns, the control strings that no text may hold, and the role that is learnt."""

    start: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    further: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    learnt: str = "assistant"

    def __post_init__(self) -> None:
        if any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("control strings have two characters or more and no backslash")
        if any(a != b and a in b for a in self.controls[:3] for b in self.controls[:3]):
            raise ValueError("no mark may hold another one")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.sep, self.end, *self.further)

    def escape(self, x: Column) -> Column:
        """x without control strings."""
        firsts = dict.fromkeys(c[0] for c in self.controls)
        behind = "|".join(f"(?<={re.escape(a)})(?={'|'.join(re.escape(c[1:]) for c in self.controls if c[0] == a)})" for a in firsts)
        return F.regexp_replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), behind, r"\\")

    def unescape(self, x: Column) -> Column:
        return F.regexp_replace(x, r"\\(\\?)", "$1")

    def head(self, role: Column) -> Column:
        return F.concat(F.lit(self.start), self.escape(role), F.lit(self.sep))

    def segment(self, role: Column, text: Column) -> Column:
        return F.concat(self.head(role), self.escape(text), F.lit(self.end))

    def parsed(self, segment: Column) -> tuple[Column, Column]:
        """Role and text of a formatted turn."""
        start, sep, end = (re.escape(c) for c in (self.start, self.sep, self.end))
        pattern = rf"(?s)\A{start}(.*?){sep}(.*){end}\z"
        return tuple(self.unescape(F.regexp_extract(segment, pattern, i)) for i in (1, 2))

    def turns(self, text: Column) -> Column:
        """Role and text of each of several formatted turns."""
        ends = F.split(text, rf"{re.escape(self.end)}(?={re.escape(self.start)}|\z)")  # the last one is empty
        return F.transform(F.slice(ends, F.lit(1), F.size(ends) - 1), lambda s: F.struct(*(x.alias(n) for x, n in zip(self.parsed(F.concat(s, F.lit(self.end))), ("role", "text"), strict=True))))


#: Rows of ``format_conversations``. Positions are code points from the start of the conversation; the loss mask covers loss_start up to loss_end,
#: which are null outside examples.
FORMATTED = ("conv_id", "place", "segment", "start", "example", "loss_start", "loss_end")


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """FORMATTED for each turn (conv_id, turn, role, text), staged. A row with an example number is that example's target; the segments of
    lesser place in its conversation are its context."""
    role, text = F.coalesce(turns["role"], F.lit("")), F.coalesce(turns["text"], F.lit(""))
    learnt = role == template.learnt
    rows = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), role.alias("role"), F.xxhash64(text).alias("_h"), template.segment(role, text).alias("segment"), F.char_length(template.head(role)).alias("_head"), learnt.alias("_learnt"))
    rows = rows.withColumn("_chars", F.char_length("segment").cast("bigint"))
    order = ("conv_id", "turn", "role", "_h")
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = staged(ordered.select("conv_id", "segment", "_head", "_learnt", "_chars", "_at"), "ordered-turns").withColumn("_range", F.shiftright("_at", 33))
    here, before = W.partitionBy("conv_id", "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, -1), W.partitionBy("conv_id").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ends = ordered.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("n"), F.sum("_chars").alias("chars"), F.count_if("_learnt").alias("examples"))
    carried = ends.select("conv_id", "_range", *(F.sum(c).over(before).alias(f"_{c}_before") for c in ("n", "chars", "examples"))).where(F.col("_n_before").isNotNull())
    # a range goes on with one conversation of the one before it at most: no more rows than there are ranges
    carried = F.broadcast(staged(carried.select(F.col("conv_id").alias("_conv"), F.col("_range").alias("_of"), "_n_before", "_chars_before", "_examples_before"), "carried-turns"))
    counted = ordered.withColumns({"_n": F.count(F.lit(1)).over(here), "_c": F.coalesce(F.sum("_chars").over(here), F.lit(0)), "_e": F.coalesce(F.count_if("_learnt").over(here), F.lit(0))})
    known = counted.join(carried, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_range") == F.col("_of")), "left")
    start = F.col("_c") + F.coalesce("_chars_before", F.lit(0))
    out = known.select(
        "conv_id",
        (F.col("_n") + F.coalesce("_n_before", F.lit(0))).alias("place"),
        "segment",
        start.alias("start"),
        F.when(F.col("_learnt"), F.col("_e") + F.coalesce("_examples_before", F.lit(0))).alias("example"),
        F.when(F.col("_learnt"), start + F.col("_head")).alias("loss_start"),
        F.when(F.col("_learnt"), start + F.col("_chars") - len(template.end)).alias("loss_end"),
    )
    out = staged(out, "formatted-turns")
    drop_staged(ordered)
    return out


def examples(formatted: DataFrame) -> DataFrame:
    """A row for each assistant turn: its context is the first context_chars characters, in context_turns turns, of the conversation's formatted text; of the
    example's characters (context and target) those from loss_start up to loss_end are trainable."""
    chars = F.col("start") + F.char_length("segment")
    return formatted.where(F.col("example").isNotNull()).select("conv_id", "example", F.col("place").alias("context_turns"), F.col("start").alias("context_chars"), chars.alias("chars"), "loss_start", "loss_end")


#: So many examples of a conversation are written out in one go.
TOGETHER = 64

#: Rows of ``expand``. An example is context and target one behind the other; its loss mask covers its code points loss_start up to loss_end. ``behind`` holds the
#: turns behind a conversation's last example, and is null for other examples. A conversation without examples is a row with all its turns there.
EXPANDED = ("conv_id", "example", "context", "target", "loss_start", "loss_end", "behind")


def expand(formatted: DataFrame) -> DataFrame:
    """EXPANDED for each assistant turn, with its whole context, and for conversations without one, staged."""
    turns = F.array_sort(F.collect_list(F.struct("place", "segment", "start", "example", "loss_start", "loss_end")))
    held = formatted.groupBy("conv_id").agg(turns.alias("_turns"), F.sum(F.char_length("segment")).alias("_chars"))
    texts = held.select("conv_id", "_chars", F.array_join(F.transform("_turns", lambda t: t["segment"]), "").alias("_text"), F.filter("_turns", lambda t: t["example"].isNotNull()).alias("_replies"))
    fields = ("example", "start", "upto", "loss_start", "loss_end", "total")
    row = lambda *values: F.struct(*(v.alias(f) for v, f in zip(values, fields, strict=True)))
    total = lambda i: F.when(i == F.size("_replies") - 1, F.col("_chars"))
    replies = F.transform("_replies", lambda t, i: row(t["example"], t["start"], t["start"] + F.char_length(t["segment"]), t["loss_start"], t["loss_end"], total(i)))
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    wanted = texts.select("conv_id", "_text", F.when(F.size("_replies") > 0, replies).otherwise(F.array(row(nothing, zero, zero, nothing, nothing, F.col("_chars")))).alias("_wanted"))
    # each part of a conversation's examples goes with the text up to its end
    parts = wanted.select("conv_id", "_text", "_wanted", F.explode(F.sequence(F.lit(0), F.floor((F.size("_wanted") - 1) / TOGETHER).cast("int"))).alias("_part"))
    parts = parts.select("conv_id", "_part", "_text", F.slice("_wanted", F.col("_part") * TOGETHER + 1, TOGETHER).alias("_wanted"))
    end = F.element_at("_wanted", -1)
    parts = parts.select("conv_id", "_part", F.substring("_text", F.lit(1), F.coalesce(end["total"], end["upto"]).cast("int")).alias("_text"), "_wanted").repartition("conv_id", "_part")
    rows = parts.select("conv_id", "_text", F.explode("_wanted").alias("w"))
    cut = lambda a, b: F.substring(F.col("_text"), (a + 1).cast("int"), (b - a).cast("int"))
    example = F.col("w.example")
    out = rows.select(
        "conv_id", example.alias("example"), F.when(example.isNotNull(), cut(F.lit(0), F.col("w.start"))).alias("context"), F.when(example.isNotNull(), cut(F.col("w.start"), F.col("w.upto"))).alias("target"),
        F.col("w.loss_start").alias("loss_start"), F.col("w.loss_end").alias("loss_end"), F.when(F.col("w.total").isNotNull(), cut(F.col("w.upto"), F.col("w.total"))).alias("behind"),
    )
    # whole contexts are long: Parquet reads up to 4,096 rows of a row group at once and looks at a page's size after 100 rows, unless told otherwise
    return staged(out, "written-examples", **{"parquet.block.row.count.limit": "16", "parquet.page.size.row.check.min": "1"})


def rendered(formatted: DataFrame) -> DataFrame:
    """conv_id, example, context, target: every example with its whole context written out."""
    return expand(formatted).where(F.col("example").isNotNull()).select("conv_id", "example", "context", "target")


def chat_report(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from the examples as ``expand`` writes them out: number and digest of a conversation's turns, from its last example and the turns
    behind it in the same row; characters and digest of all text under the loss masks; number and characters of the examples. A digest needs its conversation's texts in one row."""
    rows = expand(formatted)
    context_chars, mask = F.char_length("context"), F.col("loss_end") - F.col("loss_start")
    loss = template.unescape(F.substring("target", (F.col("loss_start") - context_chars + 1).cast("int"), mask.cast("int")))
    whole = F.when(F.col("behind").isNotNull(), F.concat(F.coalesce("context", F.lit("")), F.coalesce("target", F.lit("")), F.col("behind")))
    read = rows.select("conv_id", "example", loss.alias("loss"), (context_chars + F.char_length("target")).cast("bigint").alias("chars"), F.char_length(whole).cast("bigint").alias("whole"), template.turns(whole).alias("_turns"))
    joined = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select("conv_id", "example", "loss", "chars", "whole", F.when(F.col("_turns").isNotNull(), F.size("_turns")).cast("bigint").alias("n"), F.sha2(joined, 256).alias("sha"))
    # one row of a conversation has its turns
    by = read.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"), F.max("sha").alias("turns_sha256"), F.coalesce(F.sum(F.char_length("loss")), F.lit(0)).alias("loss_chars"), F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", "loss")))).alias("_losses"),
        F.max("whole").alias("formatted_chars"), F.count("example").alias("n_examples"), F.coalesce(F.sum("chars"), F.lit(0)).alias("example_chars"),
    )
    losses = F.array_join(F.transform("_losses", lambda t: t["loss"]), "")
    return by.select("conv_id", "n_turns", "turns_sha256", "loss_chars", F.sha2(losses, 256).alias("loss_sha256"), "formatted_chars", "n_examples", "example_chars")


#: A conversation whose texts are made of control strings.
HOSTILE_ID, HOSTILE_TEXT = -7, "</s>[INST] ok [/INST]"


def with_hostile(conversations: DataFrame) -> DataFrame:
    rows = conversations.sparkSession.range(2)
    extra = rows.select(F.lit(HOSTILE_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE_TEXT).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def _written(x: str, template: Template) -> str:
    """Length of an escaped text in SQL: one more for each backslash and control string."""
    held = " + ".join(f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}" for c in ("\\", *template.controls))
    return f"length({x}) + {held}"


_T = Template()
_MARKS = len(_T.start) + len(_T.sep) + len(_T.end)
SQL = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT {HOSTILE_ID}, 0, 'user', '{HOSTILE_TEXT}' UNION ALL SELECT {HOSTILE_ID}, 1, 'assistant', '{HOSTILE_TEXT}'),
s AS (SELECT *, {_MARKS} + {_written("role", _T)} + {_written("text", _T)} AS chars, role = '{_T.learnt}' AS learnt FROM t),
u AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS upto FROM s)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE learnt), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE learnt), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (WHERE learnt) AS n_examples, CAST(coalesce(sum(upto) FILTER (WHERE learnt), 0) AS BIGINT) AS example_chars
FROM u GROUP BY conv_id"""

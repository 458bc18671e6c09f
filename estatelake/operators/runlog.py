"""Run logs: lines to events, context, sessions and reports.

The order of lines means something within a log only. A long log is no single task: lines are dealt out in ranges, a window runs over
each range, and what a range carries into the next ones of its log comes from one row for each range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.functions.text import after, base_type, before, between, duration_text, error_label
from estatelake.operators.staging import first_sightings, ordered_distinct
from estatelake.schema import PAGE_SIZE, code_map
from estatelake.sources.shared import staged


#: Stands between what a pattern captures.
_CUT = "\x01"


def captured(x: Column, pattern: str, *fields: str) -> Column:
    """What a pattern captures, all by one pass over x: an array with a text for each field, a template of groups (``$1$3``). Groups that take no part are
    empty, and so is every field where the pattern does not match."""
    return F.split(F.regexp_replace(x, rf"(?s)\A(?:{pattern}|.*)\z", _CUT.join(fields)), _CUT, len(fields))


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds log_ts, level, logger and message; null where the line has another form."""
    form = r"(?U)(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)(?:,\d+)? \[(\w+)\] (\S+) — (.*)"
    held = lines.withColumn("_parts", captured(F.col(line), form, "$1", "$2", "$3", "$4"))
    part = lambda i: F.when(F.col("_parts")[0] != "", F.col("_parts")[i])
    return held.withColumns({"log_ts": F.to_timestamp_ntz(part(0), F.lit("yyyy-MM-dd HH:mm:ss")), "level": part(1), "logger": part(2), "message": part(3)}).drop("_parts")


class Phrases:
    """The kinds of lines of a log by what they say. A rule names a kind, a phrase (one that begins with ``(?i)`` may stand in any case) and, if the phrase alone does not tell, a
    pattern of what follows it. The first rule that holds wins.

    Phrases are looked for as bytes and once each, and a pattern is looked at only behind its phrase. The result is the number of the rule, by which
    what follows its phrase is cut out; captures are taken from that for the rule's kind alone. One regular expression of all rules was tried, too, and was
    no faster."""

    def __init__(self, *rules: tuple[str, str, str | None]) -> None:
        self.rules = rules

    @staticmethod
    def _at(line: str, phrase: str) -> Column:
        any_case = phrase.startswith("(?i)")
        return F.locate(phrase.removeprefix("(?i)").upper(), F.upper(line)) if any_case else F.locate(phrase, F.col(line))

    @staticmethod
    def _there(line: str, phrase: str) -> Column:
        """Whether a phrase is in a line; case is looked at only where its marks, or its last letters, are."""
        any_case = phrase.startswith("(?i)")
        if not any_case:
            return F.col(line).contains(phrase)
        marks = phrase.removeprefix("(?i)").split(" ")[0]
        some = F.col(line).contains(marks) if not marks.isalpha() else F.col(line).contains(marks.lower()) | F.col(line).contains(marks.upper()) | F.col(line).contains(marks.capitalize())
        return F.when(some, F.upper(line).contains(phrase.removeprefix("(?i)").upper())).otherwise(False)

    def told(self, lines: DataFrame, line: str) -> DataFrame:
        """Adds kind and rest, what follows the phrase of the rule that holds."""
        follows = lambda phrase: F.substr(F.col(line), self._at(line, phrase) + F.lit(len(phrase.removeprefix("(?i)"))))
        rule, kind, rest = (F.lit(None).cast(t) for t in ("int", "string", "string"))
        for i, (name, phrase, behind) in reversed(list(enumerate(self.rules))):
            there = self._there(line, phrase)
            # not by &: the pattern is for lines with the phrase only
            holds = there if behind is None else F.when(there, follows(phrase).rlike(rf"\A{behind}")).otherwise(False)
            rule = F.when(holds, i).otherwise(rule)
            kind, rest = F.when(F.col("_rule") == i, name).otherwise(kind), F.when(F.col("_rule") == i, follows(phrase)).otherwise(rest)
        return lines.withColumn("_rule", rule).withColumns({"kind": kind, "rest": rest}).drop("_rule")


def number(x: Column) -> Column:
    """A number at the start of a text, with or without thousands commas."""
    return F.nullif(F.translate(F.regexp_extract(F.ltrim(x), r"\A[\d,]+", 0), ",", ""), F.lit("")).try_cast("long")


def _word(x: Column) -> Column:
    return F.nullif(F.get(F.split(F.ltrim(x), r"\s"), F.lit(0)), F.lit(""))


# The phrases of log lines, full and incremental runs.
CAPPED, UNDER, ON_PAGE, NO_MORE = ": CAPPED", ": under cap", " valid listings from page ", " listings no longer visible"
PASS_1, PASS_2, SAVED, NOTHING = "Pass 1 — ", "Pass 2 — ", ": saved ", ": 0 listings to save "
_NUMBER = r"\s*,*\d"
FULL = Phrases(
    ("run_start", "Scraping run started", None),
    ("transaction", "(?i)===== Transaction type:", None),
    ("transaction", "Transaction type:", r"\s*\S"),
    # NAME (slug) | ...
    ("region_start", "(?i)===== Region:", None),
    # 3/54: NAME (slug)
    ("region_number", "Region ", rf"{_NUMBER}[^/]*/{_NUMBER}[^:]*: .*\("),
    ("preflight", "Pre-flight result for ", f".*?(?:{CAPPED}|{UNDER})"),
    ("preflight_done", "Pre-flight complete. Capped:", r"[^\]]*\[[^\]]*\]"),
    # label/kind [low-high] | ...
    ("unit_start", "--- Scraping: ", r"\s*[^\s|/]*/[^|]*\|"),
    ("page_saved", "Saved ", rf"{_NUMBER}.*?{ON_PAGE}{_NUMBER}"),
    ("run_end", "(?i)run finished", None),
    ("error", "[ERROR]", None),
    ("error", "[WARNING]", None),
)


def full_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines of a full run with their kind and what it captures. The order of the rules matters."""
    rest = F.col("rest")
    is_ = lambda k: F.col("kind") == k
    judged = F.coalesce(before(rest, CAPPED), before(rest, UNDER))
    unit = after(F.get(F.split(F.trim(before(rest, "|")), r"\s"), F.lit(0)), "/")
    return FULL.told(lines, line).withColumns(
        {
            "transaction": F.when(is_("transaction"), _word(rest)),
            "region": F.when(is_("region_start"), between(before(rest, "|"), "(", ")")),
            "unit": F.when(is_("preflight"), base_type(F.element_at(F.split(judged, "/"), -1))).when(is_("unit_start"), unit),
            "capped": F.when(is_("preflight"), before(rest, CAPPED).isNotNull()),
            "rows": F.when(is_("page_saved"), number(rest).cast("int")),
            "page": F.when(is_("page_saved"), number(after(rest, ON_PAGE)).cast("int")),
            "label": F.when(is_("error"), error_label(F.col(line))),
        }
    ).drop("rest")


COUNTS = ("new", "changed", "reappeared", "unchanged")
_SAYS = r"[^(]*\((?:[^)]*\| )?\s*,*\d[^|)]* {word}(?: \||\))"
INCREMENTAL = Phrases(
    ("run_start", "Light scraper run started", None),
    ("baseline_active", "Fetched ", rf"{_NUMBER}.* active listings from DB"),
    ("baseline_inactive", "Fetched ", rf"{_NUMBER}.* inactive listings from DB"),
    ("transaction", "(?i)===== Transaction type:", None),
    ("region_start", PASS_1, r".*?scraping index pages: [^|]*\|"),
    ("preflight", "Pre-flight result for ", f".*?(?:{CAPPED}|{UNDER})"),
    ("first_page", PASS_1, ".*?page 1: http.*?/obiavi/"),
    # REGION: saved 5 listings (1 new | 2 changed | ...), or REGION: 0 listings to save (7 unchanged)
    ("region_done", PASS_1, f"(?=.*?{SAVED}){_SAYS.format(word='new')}"),
    ("region_done", PASS_1, f"(?=.*?{NOTHING}){_SAYS.format(word='unchanged')}"),
    ("missing", PASS_1, f"{_NUMBER}.*?{NO_MORE}"),
    ("refresh_start", PASS_2, "rolling detail refresh"),
    ("refresh_size", PASS_2, f".*?refreshing {_NUMBER}"),
    ("refresh_progress", PASS_2, f"{_NUMBER}[^/]*/{_NUMBER}.*? saved"),
    ("refresh_warning", PASS_2, "WARNING: high rejection rate "),
    ("refresh_summary", PASS_2, f"(?=.* processed).*?summary: {_NUMBER}"),
    ("refresh_done", PASS_2, rf"(?=.* listings refreshed).*?complete\.{_NUMBER}"),
    ("run_end", "Light scraper run finished", None),
    ("error", "[ERROR]", None),
    ("error", "[WARNING]", None),
)


def incremental_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines of an incremental run with their kind, region, transaction and counts."""
    rest = F.col("rest")
    is_ = lambda k: F.col("kind") == k
    finished = is_("region_done")
    of = lambda word: number(F.get(F.filter("_said", lambda p: p.endswith(f" {word}")), F.lit(0)))
    counts = {name: F.when(finished, F.coalesce(of(name), F.lit(0))) for name in COUNTS}
    told = (
        F.when(F.col("kind").isin("baseline_active", "baseline_inactive", "missing", "refresh_progress"), number(rest))
        .when(is_("refresh_size"), number(after(rest, "refreshing ")))
        .when(is_("refresh_done"), number(after(rest, "complete.")))
    )
    held = INCREMENTAL.told(lines, line).withColumn("_said", F.when(finished, F.split(between(rest, "(", ")"), r" \| ")))
    return held.withColumns(
        {
            "transaction": F.when(is_("transaction"), _word(rest)),
            "region": F.when(is_("region_start"), F.rtrim(between(rest, "scraping index pages: ", "|"))).when(finished, F.coalesce(before(rest, SAVED), before(rest, NOTHING))),
            "saved": F.when(finished, F.coalesce(number(after(rest, SAVED)), F.lit(0))),
            **counts,
            "number": told,
            "label": F.when(is_("error"), error_label(F.col(line))),
        }
    ).drop("rest", "_said")


Events = Callable[[DataFrame], DataFrame]


def in_ranges(rows: DataFrame, log: str, order: list[str], events: Events | None = None) -> DataFrame:
    """Rows in the order of their log, staged, with their place (_at) and range (_range). ``events`` reads lines where they have come to lie: ranges are
    chosen by a sample of rows, for which no line needs to be read, and each range reads its own lines."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, log, *order).sortWithinPartitions(log, *order).withColumn("_at", F.monotonically_increasing_id())
    return staged(events(placed) if events else placed, "ordered-lines").withColumn("_range", F.shiftright("_at", 33))


def _with_ranges(rows: DataFrame, others: DataFrame, log: str) -> DataFrame:
    """rows with what they need of other ranges of their log (null where there is none). others: a row for each range that goes on with a log of the range before, or is
    gone on with, which are no more than there are ranges."""
    right = F.broadcast(others.withColumnsRenamed({log: "_log", "_range": "_of"}))
    return rows.join(right, (F.col(log) == F.col("_log")) & (F.col("_range") == F.col("_of")), "left").drop("_log", "_of")


def with_context(lines: DataFrame, log: str, order: list[str], events: Events | None = None) -> DataFrame:
    """The region and transaction that a line falls under, and the number of its region session. Staged. lines are events already, or ``events`` makes them so.
    A line of no log (null) is under nothing: no region, no transaction, session 0."""
    start = F.coalesce(F.col("kind") == "region_start", F.lit(False))
    rows = in_ranges(lines, log, order, events)
    columns = [c for c in rows.columns if c not in ("_at", "_range")]
    here = W.partitionBy(log, "_range").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(log).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    last = lambda value, given: F.max_by(F.when(given, value), F.when(given, F.col("_at")))
    ends = rows.groupBy(log, "_range").agg(
        last(F.struct("region"), start & F.col("region").isNotNull()).alias("region"), last(F.col("transaction"), F.col("transaction").isNotNull()).alias("transaction"), F.sum(start.cast("int")).alias("n")
    )
    carried = ends.select(
        log, "_range", F.last("region", ignorenulls=True).over(before).alias("_region"), F.last("transaction", ignorenulls=True).over(before).alias("_transaction"), F.sum("n").over(before).alias("_n")
    ).where(F.col("_n").isNotNull())
    known = rows.withColumns({"_own": F.last(F.when(start & F.col("region").isNotNull(), F.col("region")), ignorenulls=True).over(here), "_tx": F.last("transaction", ignorenulls=True).over(here), "_k": F.sum(start.cast("int")).over(here)})
    of_log = lambda x: F.when(F.col(log).isNotNull(), x)
    context = _with_ranges(known, carried, log).withColumns(
        {"in_region": of_log(F.coalesce("_own", "_region.region")), "in_transaction": of_log(F.coalesce("_tx", "_transaction")), "session": F.coalesce(of_log(F.col("_k") + F.coalesce("_n", F.lit(0))), F.lit(0).cast("long"))}
    )
    return staged(context.select(*columns, "in_region", "in_transaction", "session"), "log-context")


def sessions(context: DataFrame, log: str, ts: str = "log_ts") -> DataFrame:
    """Region sessions with their start and end: the next start, or the last line of the log."""
    last = context.groupBy(F.col(log).alias("_log")).agg(F.max(ts).alias("_end"))
    starts = context.where("kind = 'region_start'").select(log, "session", F.col("region"), F.col(ts).alias("started"))
    ended = F.lead("started").over(W.partitionBy(log).orderBy("session"))
    out = starts.withColumn("_next", ended).join(last, F.col(log) == F.col("_log"))
    return out.select(log, "session", "region", "started", F.coalesce("_next", "_end").alias("ended"))


def seconds_between(a: Column, b: Column) -> Column:
    return F.unix_timestamp(b.cast("timestamp")) - F.unix_timestamp(a.cast("timestamp"))


def region_report(context: DataFrame, log: str) -> DataFrame:
    """Listings, pages, errors and duration of each region session."""
    facts = context.where("session > 0").groupBy(log, "session").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("listings"), F.countDistinct("label").alias("errors"), F.countDistinct(F.when(F.col("kind") == "unit_start", F.col("unit"))).alias("types"))
    out = sessions(context, log).join(facts, [log, "session"], "left")
    seconds = seconds_between(F.col("started"), F.col("ended"))
    return out.select(log, "session", "region", F.coalesce("listings", F.lit(0)).alias("listings"), F.ceil(F.coalesce("listings", F.lit(0)) / PAGE_SIZE).cast("long").alias("pages"), F.coalesce("errors", F.lit(0)).alias("errors"), F.coalesce("types", F.lit(0)).alias("types"), seconds.alias("seconds"), duration_text(seconds).alias("duration"))


def full_region_report(context: DataFrame, log: str, order: str, regions: int, estimates: DataFrame, transactions: dict[str, str]) -> DataFrame:
    """The report of each region session with its distinct error labels in order, its share of all regions, and the estimate
    (transaction_type, region, estimate) for what is left."""
    labels = ordered_distinct(context.where("session > 0"), [log, "session"], "label", order, "labels")
    started = context.where("kind = 'region_start'").select(log, "session", code_map(transactions, F.col("in_transaction")).alias("transaction_type"))
    out = region_report(context, log).join(labels, [log, "session"], "left").join(started, [log, "session"]).join(estimates, ["transaction_type", "region"], "left")
    percent = F.round(F.lit(100.0) * F.col("session") / regions, 1)
    return out.withColumns({"labels": F.coalesce(F.array_join("labels", "; "), F.lit("")), "percent": percent, "estimate": F.coalesce("estimate", F.lit(""))})


def incremental_region_report(context: DataFrame, log: str) -> DataFrame:
    """Counts, distinct error labels and duration of each region session of an incremental run."""
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("saved", *COUNTS))
    facts = context.where("session > 0").groupBy(log, "session").agg(*sums, F.countDistinct("label").alias("errors"))
    seconds = seconds_between(F.col("started"), F.col("ended"))
    out = sessions(context, log).join(facts, [log, "session"])
    return out.select(log, "session", "region", "saved", *COUNTS, "errors", seconds.alias("seconds"), duration_text(seconds).alias("duration"))


def type_counter(context: DataFrame, log: str, order: str) -> DataFrame:
    """The place of each kind in its region session by first sighting, as ``place/total``: the total is what the pre-flight
    announced, or the place where that is more."""
    seen = first_sightings(context.where("kind = 'unit_start'"), [log, "session"], "unit", order)
    announced = context.where("kind = 'preflight'").groupBy(log, "session").agg(F.countDistinct("unit").alias("announced"))
    total = F.greatest(F.coalesce("announced", F.lit(0)), F.col("place"))
    return seen.join(announced, [log, "session"], "left").withColumn("counter", F.concat_ws("/", F.col("place").cast("string"), total.cast("string"))).drop("announced")


def idle_gaps(lines: DataFrame, log: str, ts: str, order: list[str], limit: int) -> DataFrame:
    """Lines that no other of their log follows for more than ``limit`` seconds. Lines of no log (null) follow nothing and have none."""
    rows = in_ranges(lines, log, order)
    columns = [c for c in rows.columns if c not in ("_at", "_range")]
    firsts = rows.groupBy(log, "_range").agg(F.min_by(F.struct(F.col(ts).alias("t")), "_at").alias("first"))
    nexts = firsts.select(log, "_range", F.lead("first").over(W.partitionBy(log).orderBy("_range")).alias("_next")).where(F.col("_next").isNotNull())
    follower = F.lead(F.struct(F.col(ts).alias("t"))).over(W.partitionBy(log, "_range").orderBy("_at"))
    known = _with_ranges(rows.withColumn("_follower", follower), nexts, log)
    seconds = F.when(F.col(log).isNotNull(), seconds_between(F.col(ts), F.coalesce("_follower", "_next")["t"]))
    return known.withColumn("idle_s", seconds).where(F.col("idle_s") > limit).select(*columns, "idle_s")


def key_values(lines: DataFrame, marker: str, line: str = "message") -> DataFrame:
    """``MARKER key=value key=value`` lines as a map; the label may hold a space before its range."""
    rest = F.trim(F.regexp_replace(F.regexp_extract(F.col(line), f"{marker}(.*)$", 1), r"label=(\S+) \[", "label=$1["))
    return lines.where(F.col(line).contains(marker)).withColumn("kv", F.str_to_map(rest, F.lit(" "), F.lit("=")))

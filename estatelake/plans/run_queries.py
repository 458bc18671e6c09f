"""Queries on pages, fetch logs, run state, run logs, sources and sinks, and streams."""

from __future__ import annotations

import contextlib

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.operators import denorm, markup, pages, quality, reconcile, runlog, runstate, staging
from estatelake.plans.listing_queries import FIRSTS, REASON, SELECTED, _eligible, scan_rows
from estatelake.plans.registry import Tables, query
from estatelake.schema import TRANSACTIONS
from estatelake.sources import tables
from estatelake.sources.shared import stage_path
from estatelake.streaming import streams

# -- pages ----------------------------------------------------------------------------------------

CARD = "(SELECT *, c_custkey AS k FROM {customer} WHERE c_custkey % 11 <> 0)"
URL = "concat('https://www.imot.bg/obiavi/prodazhbi/p-', CAST(c_custkey AS STRING))"


def cards(t: Tables) -> DataFrame:
    return pages.card_columns(pages.cards(t.portal_pages))


query("scan_pages", "SELECT page_id, url, CAST(length(html) AS INT) AS chars FROM {pages}")(lambda t: t.pages.select("page_id", "url", F.length("html").alias("chars")))
query("extract_cards", f"""SELECT {URL} AS url, CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey AS STRING) END AS source_id, CASE WHEN c_custkey % 4 = 0 THEN 'TOP' END AS listing_tier, concat('https://www.imot.bg/obiava-', CAST(c_custkey AS STRING)) AS listing_url,
  CASE WHEN c_custkey % 10 <> 0 THEN concat(CAST(c_custkey % 4 AS STRING), '-СТАЕН') END AS property_type, CAST(c_custkey % 90 + 20 AS DOUBLE) AS area_m2, '2 от 6' AS floor, CASE WHEN c_custkey % 3 = 0 THEN 'собственик' ELSE 'агенция' END AS poster_type, CAST(c_custkey % 7 <> 0 AS INT) AS has_photos FROM {CARD} AS c""")(
    lambda t: cards(t).select("url", "source_id", "listing_tier", "listing_url", "property_type", "area_m2", "floor", "poster_type", F.col("has_photos").cast("int").alias("has_photos"))
)
query("card_id_tier", f"SELECT {URL} AS url, CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey AS STRING) END AS source_id, CASE WHEN c_custkey % 4 = 0 THEN 'TOP' END AS listing_tier FROM {CARD} AS c")(lambda t: cards(t).select("url", "source_id", "listing_tier"))
query("normalise_url", f"SELECT {URL} AS url, concat('https://www.imot.bg/obiava-', CAST(c_custkey AS STRING)) AS listing_url FROM {CARD} AS c")(lambda t: cards(t).select("url", "listing_url"))
query("title_split", """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN concat(CAST(c_custkey % 4 AS STRING), '-СТАЕН') END AS property_type, CASE c_custkey % 8 WHEN 0 THEN 'София' WHEN 1 THEN 'Банско' WHEN 2 THEN 'Марково' WHEN 3 THEN 'Марково' WHEN 4 THEN 'Слънчев бряг' WHEN 5 THEN 'бряг' WHEN 6 THEN 'Бистрица' ELSE 'Варна' END AS locality,
  CASE c_custkey % 8 WHEN 0 THEN 'Лозенец' END AS area FROM {customer} WHERE c_custkey % 11 <> 0""")(lambda t: cards(t).select(F.regexp_extract("url", r"p-(\d+)$", 1).cast("long").alias("c_custkey"), "property_type", "locality", "area"))
query("first_price_line", f"SELECT {URL} AS url, concat(CAST(c_custkey AS STRING), ' 990 €') AS price_raw FROM {CARD} AS c")(lambda t: cards(t).select("url", "price_raw"))
query("poster_type", f"SELECT {URL} AS url, CASE WHEN c_custkey % 3 = 0 THEN 'собственик' ELSE 'агенция' END AS poster_type, CASE WHEN c_custkey % 3 <> 0 THEN concat('Имоти & Ко ', CAST(c_custkey AS STRING)) END AS agency_name FROM {CARD} AS c")(lambda t: cards(t).select("url", "poster_type", "agency_name"))
query("mask_private_phone", f"SELECT {URL} AS url, CASE WHEN c_custkey % 3 <> 0 THEN concat('08', CAST(c_custkey AS STRING), '55') END AS agency_phone FROM {CARD} AS c")(lambda t: cards(t).select("url", "agency_phone"))
query("has_photos", f"SELECT {URL} AS url, CAST(c_custkey % 7 <> 0 AS INT) AS has_photos FROM {CARD} AS c")(lambda t: cards(t).select("url", F.col("has_photos").cast("int").alias("has_photos")))
query("extract_cards_rejects", f"SELECT {URL} AS url, CAST(0 AS INT) AS place FROM {CARD} AS c WHERE c_custkey % 13 = 0")(lambda t: pages.reject_cards(cards(t)).select("url", "place"))
query("page_capped", "SELECT c_custkey AS page_id, CAST(c_custkey % 6 <> 0 AND c_custkey % 5 = 0 AS INT) AS capped FROM {customer}")(lambda t: t.portal_pages.select("page_id", pages.capped().cast("int").alias("capped")))
query("content_valid", "SELECT c_custkey AS page_id, CAST(CASE WHEN c_custkey % 9 = 0 THEN FALSE WHEN c_custkey % 9 = 1 THEN TRUE ELSE c_custkey % 11 <> 0 OR c_custkey % 6 <> 0 END AS INT) AS valid FROM {customer}")(
    lambda t: t.portal_pages.select("page_id", pages.content_valid().cast("int").alias("valid"))
)
DETAIL = "(SELECT *, concat('https://www.imot.bg/obiava-', CAST(c_custkey AS STRING)) AS url FROM {customer} WHERE c_custkey % 10 <> 0)"


def _detail(t: Tables, *columns: str) -> DataFrame:
    return pages.detail_columns(t.portal_details).select("url", *columns)


query("detail_dates", f"SELECT url, CASE WHEN c_custkey % 3 = 0 THEN 'Публикувана в 10:00' END AS date_posted, CASE WHEN c_custkey % 3 = 1 THEN 'Коригирана в 11:30' END AS date_modified FROM {DETAIL} AS d")(lambda t: _detail(t, "date_posted", "date_modified"))
query("detail_params", f"SELECT url, CASE WHEN c_custkey % 4 <> 0 THEN 'ДА' END AS gas, CASE WHEN c_custkey % 5 <> 0 THEN 'НЕ' END AS tec FROM {DETAIL} AS d")(lambda t: _detail(t, "gas", "tec"))
query("detail_construction", f"SELECT url, CASE WHEN c_custkey % 6 <> 0 THEN 'Тухла' END AS construction_type, CASE WHEN c_custkey % 6 <> 0 THEN 'Въведен в експлоатация' END AS construction_status, CASE WHEN c_custkey % 6 <> 0 THEN CAST(1950 + c_custkey % 70 AS INT) END AS year_built FROM {DETAIL} AS d")(
    lambda t: _detail(t, "construction_type", "construction_status", "year_built")
)
query("detail_features", f"SELECT url, nullif(concat_ws(', ', CASE WHEN c_custkey % 2 = 0 THEN 'Асансьор' END, CASE WHEN c_custkey % 7 <> 0 THEN 'Обзаведен & готов' END), '') AS features FROM {DETAIL} AS d")(lambda t: _detail(t, "features"))
query("enrich_with_detail", f"SELECT c.k AS source_key, CAST(c.k % 10 <> 0 AS INT) AS detail_ok, CASE WHEN c.k % 10 <> 0 AND c.k % 4 <> 0 THEN 'ДА' END AS gas FROM {CARD} AS c")(
    lambda t: pages.enrich(cards(t), pages.detail_columns(t.portal_details)).select(F.regexp_extract("url", r"p-(\d+)$", 1).cast("long").alias("source_key"), F.col("detail_ok").cast("int").alias("detail_ok"), "gas")
)

def _between(start: str, end: str) -> str:
    """In SQL, what stands between two marks of a page."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    return f"split_part(split_part(html, {quote(start)}, 2), {quote(end)}, 1)"


def _nodes(x: str) -> str:
    """In SQL, the text nodes of a fragment without comments, their references decoded once and their ends stripped."""
    said = "t"
    for reference, char in (("&amp;", "chr(1)"), ("&#38;", "chr(1)"), ("&nbsp;", "chr(160)"), ("&euro;", "'€'"), ("&lt;", "'<'"), ("&gt;", "'>'")):
        said = f"replace({said}, '{reference}', {char})"
    return f"list_filter(list_transform(string_split_regex(regexp_replace({x}, '<!--.*?-->', '<!>', 'g'), '<[^>]*>'), lambda t: trim(replace({said}, chr(1), '&'), concat(' ', chr(160), chr(10)))), lambda t: t <> '')"


def _text(x: str, separator: str = "") -> str:
    return f"array_to_string({_nodes(x)}, '{separator}')"


@query("nested_cards", f"""WITH w AS (SELECT page_id, {_between('''BEST ' id="ida''', '">')} AS k, {_text(_between("&amp;b=2'>", "<location>"))} AS title, {_text(_between("<location>", "</location>"))} AS place, {_nodes(_between('<div class="price">', '<div class="info">'))}[1] AS price,
    {_text("regexp_extract(html, '<div class=.info.>(.*)<div class=.?seller.?>.*<a class=.photos', 1)", " ")} AS info, html LIKE '%<div class=name>%' AS named, html LIKE '%<div class="name"><div>%' AS unnamed, {_text(_between("<div class=name>", '<a class="photos">'))} AS agency, html LIKE '%<a class="photos"><div><strong>%' AS photos FROM {{nested_pages}})
SELECT page_id, k AS source_id, 'BEST' AS listing_tier, concat('https://www.imot.bg/obiava-', k, '?a=1&b=2') AS listing_url, replace(title, 'Продава ', '') AS property_type, replace(split_part(place, ',', 1), 'с. ', '') AS locality, split_part(place, ',', 2) AS area, price AS price_raw, CAST(regexp_extract(info, '([0-9]+) кв', 1) AS DOUBLE) AS area_m2,
  concat(regexp_extract(info, '([0-9]+)-ри ет', 1), ' от ', regexp_extract(info, 'от ([0-9]+)', 1)) AS floor, CASE WHEN named OR unnamed THEN 'агенция' ELSE 'собственик' END AS poster_type, CASE WHEN named THEN agency END AS agency_name, CASE WHEN named OR unnamed THEN replace(regexp_extract(info, 'тел.: ([0-9 ]+)', 1), ' ', '') END AS agency_phone, CAST(photos AS INT) AS has_photos FROM w""")
def nested_cards(t: Tables) -> DataFrame:
    """Cards with nested blocks, unquoted attributes, comments and scripts."""
    rows = pages.card_columns(pages.cards(t.nested_pages))
    return rows.select(F.regexp_extract("url", r"n-(\d+)$", 1).cast("long").alias("page_id"), *"source_id listing_tier listing_url property_type locality area price_raw area_m2 floor poster_type agency_name agency_phone".split(), F.col("has_photos").cast("int").alias("has_photos"))


_ITEMS = _between('<div class="items">', '<div class="items">')


@query("nested_details", f"""WITH w AS (SELECT url, {_text("regexp_extract(html, '<div class=.info.><div>(<span>.*?)</div></div><div>втори', 1)")} AS date, {_text("regexp_extract(html, '(?s)Газ:<div><div><strong>(.*?)</strong>', 1)")} AS gas, {_nodes(_between("Строителство:", '<div class="carExtri">'))} AS built, {_text("regexp_extract(html, 'Строителство:.*?<strong>(.*?)</strong>', 1)")} AS kind,
    list_transform(string_split(replace(split_part({_ITEMS}, '<div> </div>', 1), '<div><div>', '<div>'), '<div>и двор'), lambda x: x) AS items FROM {{nested_details}})
SELECT url, CASE WHEN contains(date, 'Публикувана') THEN date END AS date_posted, CASE WHEN contains(date, 'Коригирана') THEN date END AS date_modified, gas, rtrim(kind, ', ') AS construction_type, built[len(built) - 1] AS construction_status, CAST(left(built[len(built)], 4) AS INT) AS year_built,
  concat({_text("split_part(items[1], '</b></div>', 1)")}, ', ', {_text("split_part(items[1], '</b></div>', 2)")}, 'и двор') AS features FROM w""")
def nested_details(t: Tables) -> DataFrame:
    """Detail pages with nested blocks, repeated labels and blocks of the same class elsewhere."""
    return pages.detail_columns(t.nested_details).drop("tec")


def _references() -> str:
    """In SQL, a piece behind an ampersand with the reference it starts with decoded."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"MAP([{', '.join(quote(n) for n in markup.NAMES)}], [{', '.join(f'concat({", ".join(f"chr({ord(c)})" for c in v)})' for v in markup.NAMES.values())}])"
    number = lambda code, pattern: f"concat(chr(CAST({code} AS INT)), regexp_replace(q, '{pattern}', ''))"
    name, short = "regexp_extract(q, '^[A-Za-z][A-Za-z0-9]*;')", f"regexp_extract(q, '^({'|'.join(n for n in markup.OPEN_NAMES)})')"
    return f"""CASE WHEN regexp_matches(q, '^#[0-9]') THEN {number("regexp_extract(q, '^#([0-9]+)', 1)", "^#[0-9]+;?")} WHEN regexp_matches(q, '^#[xX][0-9a-fA-F]') THEN {number("concat('0x', regexp_extract(q, '^#[xX]([0-9a-fA-F]+)', 1))", "^#[xX][0-9a-fA-F]+;?")}
  WHEN {name} <> '' AND names[{name}] IS NOT NULL THEN concat(names[{name}], substr(q, length({name}) + 1)) WHEN {short} <> '' THEN concat(names[{short}], substr(q, length({short}) + 1)) ELSE concat('&', q) END""", table


_DECODED, _TABLE = _references()


@query("decoded_pages", f"WITH n AS (SELECT {_TABLE} AS names), p AS (SELECT page_id, string_split(html, '&') AS parts, names FROM {{pages}}, n) SELECT page_id, len(parts) - 1 AS ampersands, md5(concat(parts[1], array_to_string(list_transform(parts[2:], lambda q: {_DECODED}), ''))) AS decoded_md5 FROM p")
def decoded_pages(t: Tables) -> DataFrame:
    """Every page with its character references decoded, and how many ampersands it has."""
    return t.pages.select("page_id", (F.size(F.split("html", "&")) - 1).cast("long").alias("ampersands"), F.md5(F.expr(markup.decode("html"))).alias("decoded_md5"))


# -- fetch log and run state ----------------------------------------------------------------------

OUTCOME = """CASE WHEN failure = 'timeout' THEN 'retry' WHEN failure IS NOT NULL THEN 'failed' WHEN status = 403 THEN 'hard_block' WHEN status = 404 THEN CASE WHEN page_type = 'listings' THEN 'empty' ELSE 'not_found' END WHEN status <> 200 THEN 'retry'
  WHEN page_type = 'detail' AND final_url LIKE '%/obiavi/%' THEN 'unavailable' WHEN chars < 5000 THEN 'too_small' WHEN NOT content_ok AND after_partial THEN 'end_of_results' WHEN NOT content_ok THEN 'soft_block' ELSE 'ok' END"""
query("fetch_outcome", f"SELECT event_id, {OUTCOME} AS outcome FROM {{fetch_log}}")(lambda t: t.fetch_log.select("event_id", runstate.fetch_outcome().alias("outcome")))
query("fetch_final", f"""WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, {OUTCOME} AS outcome, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS attempt FROM {{fetch_log}})
SELECT user_id, day, coalesce(arg_min(CASE WHEN outcome NOT IN ('retry', 'soft_block', 'too_small') THEN outcome END, attempt) FILTER (WHERE outcome NOT IN ('retry', 'soft_block', 'too_small')), 'exhausted') AS outcome, count(*) AS attempts FROM a WHERE attempt <= 2 GROUP BY user_id, day""")(
    lambda t: runstate.final_outcomes(t.fetch_log.withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_id")
)
query("page_summary", f"SELECT region, page, count(*) AS found, count(*) FILTER (WHERE {REASON} IS NULL) AS saved, count({REASON}) AS rejected, count(*) FILTER (WHERE {REASON} IS NULL AND flag = 'R') AS detail_failed FROM {{listings}} GROUP BY region, page")(
    lambda t: quality.page_summary(t.listings, ["region", "page"], F.col("flag") == "R")
)
SUMMARY = "(SELECT unit, max(page) AS pages, sum(found)::BIGINT AS found, sum(rejected)::BIGINT AS rejected, sum(detail_failed)::BIGINT AS detail_failed, arg_max(found, page) AS last_found FROM {page_facts} GROUP BY unit)"
query("unit_summary", f"SELECT unit, pages, found, rejected, detail_failed FROM {SUMMARY} AS s")(lambda t: runstate.unit_summary(t.page_facts).select("unit", "pages", "found", "rejected", "detail_failed"))
query("unit_cap_hit", f"SELECT unit, last_found, CAST(last_found = 40 AS INT) AS capped FROM {SUMMARY} AS s")(lambda t: runstate.unit_summary(t.page_facts).select("unit", "last_found", F.col("capped").cast("int").alias("capped")))
query("unit_stop_reason", f"SELECT unit, CASE WHEN last_found = 40 THEN 'possible_cap' WHEN last_found = 0 THEN 'end_of_results' ELSE 'end_after_partial_page' END AS stop_reason FROM {SUMMARY} AS s")(lambda t: runstate.unit_summary(t.page_facts).select("unit", "stop_reason"))
query("resume_points", "SELECT unit, max(page) + 1 AS resume_page FROM {page_facts} WHERE found > rejected GROUP BY unit")(lambda t: t.page_facts.where("found > rejected").groupBy("unit").agg((F.max("page") + 1).alias("resume_page")))
query("run_counters", """SELECT transaction_type, count(*) AS events, count(*) FILTER (WHERE kind IN ('failed', 'cleared')) AS pages_attempted, count(*) FILTER (WHERE kind = 'cleared') AS pages_completed, count(*) FILTER (WHERE kind = 'failed') AS failures,
  count(DISTINCT unit) AS units, count(DISTINCT CASE WHEN kind = 'region_complete' THEN region END) AS regions_completed FROM {unit_events} GROUP BY transaction_type""")(lambda t: runstate.run_counters(t.unit_events))
FAILED = "(SELECT f.transaction_type, f.unit, f.reason FROM (SELECT transaction_type, unit, reason, max(seq) AS at FROM {unit_events} WHERE kind = 'failed' GROUP BY ALL) f LEFT JOIN (SELECT transaction_type, unit, max(seq) AS at FROM {unit_events} WHERE kind = 'cleared' GROUP BY ALL) c ON f.unit = c.unit AND f.transaction_type = c.transaction_type WHERE c.at IS NULL OR f.at > c.at)"
EXPECTED = "(SELECT tx AS transaction_type, concat('oblast-', CAST(r_regionkey * 7 + x AS STRING)) AS region FROM {region}, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS x) AS x, (SELECT unnest(['sale', 'rental']) AS tx) AS t)"


def expected(t: Tables) -> DataFrame:
    return t.region.select(F.explode(F.array(F.lit("sale"), F.lit("rental"))).alias("transaction_type"), "r_regionkey").select("transaction_type", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("x"), "r_regionkey").select("transaction_type", F.concat(F.lit("oblast-"), (F.col("r_regionkey") * 7 + F.col("x")).cast("string")).alias("region"))


DONE = "(SELECT DISTINCT transaction_type, region FROM {unit_events} WHERE kind = 'region_complete')"
GATE = f"""(SELECT b.transaction_type, bool_and(coalesce(done AND wanted, FALSE)) AS all_done, count(done) AS completed, count(wanted) AS expected, max(coalesce(n, 0)) AS failed_units FROM (SELECT coalesce(e.transaction_type, d.transaction_type) AS transaction_type, e.wanted, d.done FROM (SELECT DISTINCT transaction_type, region, TRUE AS wanted FROM {EXPECTED} AS e0) e
  FULL JOIN (SELECT *, TRUE AS done FROM {DONE} AS d0) d ON e.transaction_type = d.transaction_type AND e.region = d.region) b LEFT JOIN (SELECT transaction_type, count(DISTINCT unit) AS n FROM {FAILED} AS f0 GROUP BY transaction_type) f ON b.transaction_type = f.transaction_type GROUP BY b.transaction_type)"""
query("failed_units", f"SELECT * FROM {FAILED} AS f")(lambda t: runstate.failed_units(t.unit_events))
query("completeness_gate", f"SELECT transaction_type, CAST(all_done AS INT) AS all_done, completed, expected, failed_units, CAST(all_done AND failed_units = 0 AS INT) AS missing_allowed FROM {GATE} AS g")(
    lambda t: runstate.completeness(expected(t), t.unit_events).withColumns({c: F.col(c).cast("int") for c in ("all_done", "missing_allowed")})
)
query("run_status", f"SELECT CASE WHEN bool_or(failed_units > 0) THEN 'partial' WHEN bool_and(all_done AND failed_units = 0) THEN 'complete' ELSE 'running' END AS run_status, count(*) AS transactions FROM {GATE} AS g")(lambda t: runstate.run_status(runstate.completeness(expected(t), t.unit_events)))
RUN_GATE = GATE.replace(EXPECTED, "{expected_regions}").replace("{unit_events}", "{run_events}")
RUN_PENDING = "(SELECT e.transaction_type, count(*) AS pending FROM {expected_regions} AS e WHERE NOT EXISTS (SELECT 1 FROM {run_events} AS d WHERE d.kind = 'region_complete' AND d.transaction_type = e.transaction_type AND d.region = e.region) GROUP BY 1)"
MISSING_GATE = f"""(SELECT g.transaction_type, all_done AND failed_units = 0 AS allowed, CASE WHEN failed_units > 0 THEN concat(CAST(failed_units AS STRING), ' failed units') WHEN pending > 0 THEN concat(CAST(pending AS STRING), ' pending regions') WHEN NOT all_done THEN 'regions that were not expected' ELSE 'complete' END AS reason
  FROM {RUN_GATE} AS g LEFT JOIN {RUN_PENDING} AS p ON g.transaction_type = p.transaction_type)"""
GONE = f"(SELECT s.transaction_type, source_id, listing_id FROM {{state}} s JOIN {MISSING_GATE} AS g ON s.transaction_type = g.transaction_type AND allowed WHERE status = 'active' AND NOT EXISTS (SELECT 1 FROM {{seen}} i WHERE trim(i.source_id) = s.source_id AND i.transaction_type = s.transaction_type))"


def _gone(t: Tables) -> tuple[DataFrame, DataFrame]:
    gate = runstate.missing_gate(t.expected_regions, t.run_events)
    return reconcile.missing_gated(t.state, t.seen, gate), gate


query("missing_gated", f"SELECT transaction_type, source_id, listing_id, 'missing' AS action FROM {GONE} AS m")(lambda t: _gone(t)[0].select("transaction_type", "source_id", "listing_id", "action"))
query("missing_report", f"SELECT g.transaction_type, CAST(allowed AS INT) AS allowed, reason, coalesce(n, 0) AS missing FROM {MISSING_GATE} AS g LEFT JOIN (SELECT transaction_type, count(*) AS n FROM {GONE} AS m GROUP BY 1) AS c ON g.transaction_type = c.transaction_type")(
    lambda t: reconcile.missing_report(*_gone(t)).select("transaction_type", F.col("missing_allowed").cast("int").alias("allowed"), "reason", "missing")
)
query("pending_units", f"SELECT DISTINCT transaction_type, region FROM {EXPECTED} AS e WHERE NOT EXISTS (SELECT 1 FROM {DONE} AS d WHERE d.transaction_type = e.transaction_type AND d.region = e.region)")(lambda t: runstate.pending_regions(expected(t), t.unit_events))
query("region_failed", f"SELECT DISTINCT transaction_type, region, CAST(EXISTS (SELECT 1 FROM {FAILED} AS f WHERE f.transaction_type = e.transaction_type AND (f.unit = e.region OR starts_with(f.unit, concat(e.region, ':')) OR starts_with(f.unit, concat(e.region, '/')))) AS INT) AS failed FROM {EXPECTED} AS e")(
    lambda t: runstate.region_failed(expected(t), t.unit_events).withColumn("failed", F.col("failed").cast("int"))
)
query("run_package_zero_fill", f"SELECT e.transaction_type, e.region, coalesce(n, 0) AS n FROM (SELECT DISTINCT * FROM {EXPECTED} AS e0) e LEFT JOIN (SELECT transaction_type, region, count(*) AS n FROM {{unit_events}} GROUP BY ALL) f ON e.transaction_type = f.transaction_type AND e.region = f.region")(
    lambda t: tables.zero_fill(expected(t).distinct(), t.unit_events.groupBy("transaction_type", "region").agg(F.count(F.lit(1)).alias("n")), ["transaction_type", "region"], ["n"])
)
query("eta_lookup", f"SELECT DISTINCT e.transaction_type, e.region, CASE WHEN n_nationkey IS NULL THEN '' ELSE concat(CAST(n_nationkey AS STRING), 'h') END AS estimate FROM {EXPECTED} AS e LEFT JOIN {{nation}} ON e.region = concat('oblast-', CAST(n_nationkey AS STRING)) AND e.transaction_type = 'sale'")(
    lambda t: _estimates(t)
)


def _known_estimates(t: Tables) -> DataFrame:
    return t.nation.select(F.lit("sale").alias("transaction_type"), F.concat(F.lit("oblast-"), F.col("n_nationkey").cast("string")).alias("region"), F.concat(F.col("n_nationkey").cast("string"), F.lit("h")).alias("estimate"))


def _estimates(t: Tables) -> DataFrame:
    return expected(t).distinct().join(_known_estimates(t), ["transaction_type", "region"], "left").withColumn("estimate", F.coalesce("estimate", F.lit("")))


# -- run logs -------------------------------------------------------------------------------------

#: A log for each group of users.
LOG = "user_id % 10"
KIND = """CASE event_type WHEN 'signup' THEN 'region_start' WHEN 'view' THEN 'page_saved' WHEN 'error' THEN 'error' WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'preflight' WHEN 1 THEN 'unit_start' END ELSE 'transaction' END"""
LABEL = "CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'Connection error' WHEN 1 THEN concat('Soft-block — oblast-', CAST(user_id % 27 AS STRING), ' [1–9]') WHEN 3 THEN concat('Pre-flight failed — oblast-', CAST(user_id % 27 AS STRING)) END END"
EVENTS = f"""(SELECT event_id, {LOG} AS log, date_trunc('second', ts) AS log_ts, {KIND} AS kind, CASE WHEN event_type = 'signup' THEN concat('oblast-', CAST(user_id % 27 AS STRING)) END AS region, CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'prodazhbi' ELSE 'naemi' END END AS transaction,
  CASE WHEN event_type = 'view' THEN CAST(floor(value) AS INT) % 41 END AS n_rows, CASE WHEN event_type = 'click' AND event_id % 3 IN (0, 1) THEN concat('tip-', CAST(event_id % 5 AS STRING)) END AS unit, CASE WHEN event_type = 'click' AND event_id % 3 = 0 THEN event_id % 2 = 0 END AS capped, {LABEL} AS label FROM {{events}})"""
CONTEXT = f"(SELECT *, last_value(region IGNORE NULLS) OVER w AS in_region, last_value(transaction IGNORE NULLS) OVER w AS in_transaction, sum(CASE WHEN kind = 'region_start' THEN 1 ELSE 0 END) OVER w AS session FROM {EVENTS} AS e WINDOW w AS (PARTITION BY log ORDER BY log_ts, event_id ROWS UNBOUNDED PRECEDING))"


def run_lines(t: Tables) -> DataFrame:
    return runlog.parse_lines(t.run_log).withColumn("log", F.col("user_id") % 10)


def full_log(t: Tables) -> DataFrame:
    return runlog.full_events(run_lines(t))


def context(t: Tables) -> DataFrame:
    return runlog.with_context(run_lines(t), "log", ["log_ts", "event_id"], runlog.full_events)


query("log_lines", "SELECT event_id, date_trunc('second', ts) AS log_ts, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'main' AS logger FROM {events}")(lambda t: runlog.parse_lines(t.run_log).select("event_id", "log_ts", "level", "logger"))
query("log_events_full", f"SELECT event_id, kind, region, transaction, n_rows, unit, CAST(capped AS INT) AS capped, label FROM {EVENTS} AS e")(lambda t: full_log(t).select("event_id", "kind", "region", "transaction", F.col("rows").alias("n_rows"), "unit", F.col("capped").cast("int").alias("capped"), "label"))
query("log_context", f"SELECT event_id, kind, in_region, in_transaction, session::BIGINT AS session FROM {CONTEXT} AS c")(lambda t: context(t).select("event_id", "kind", "in_region", "in_transaction", "session"))
SESSIONS = f"(SELECT s.log, session, region, log_ts AS started, coalesce(lead(log_ts) OVER (PARTITION BY s.log ORDER BY session), last_ts) AS ended FROM {CONTEXT} AS s JOIN (SELECT log, max(log_ts) AS last_ts FROM {EVENTS} AS e GROUP BY log) m ON s.log = m.log WHERE kind = 'region_start')"
query("region_sessions", f"SELECT log, session::BIGINT AS session, region, started, ended FROM {SESSIONS} AS s")(lambda t: runlog.sessions(context(t), "log"))
FACTS = f"(SELECT log, session, coalesce(sum(n_rows), 0)::BIGINT AS listings, count(DISTINCT label) AS errors, count(DISTINCT CASE WHEN kind = 'unit_start' THEN unit END) AS types FROM {CONTEXT} AS c WHERE session > 0 GROUP BY log, session)"
SECONDS = "epoch(ended)::BIGINT - epoch(started)::BIGINT"
REPORT = f"(SELECT s.log, s.session::BIGINT AS session, s.region, coalesce(listings, 0) AS listings, CAST(ceil(coalesce(listings, 0) / 40.0) AS BIGINT) AS pages, coalesce(errors, 0) AS errors, coalesce(types, 0) AS types, {SECONDS} AS seconds FROM {SESSIONS} AS s LEFT JOIN {FACTS} AS f ON s.log = f.log AND s.session = f.session)"
query("region_report", f"SELECT log, session, region, listings, pages, errors, types, seconds FROM {REPORT} AS r")(lambda t: runlog.region_report(context(t), "log").drop("duration"))
query("region_summary", f"SELECT region, count(*) AS sessions, sum(listings)::BIGINT AS listings, sum(pages)::BIGINT AS pages, sum(seconds)::BIGINT AS seconds FROM {REPORT} AS r GROUP BY region")(
    lambda t: runlog.region_report(context(t), "log").groupBy("region").agg(F.count(F.lit(1)).alias("sessions"), F.sum("listings").alias("listings"), F.sum("pages").alias("pages"), F.sum("seconds").alias("seconds"))
)
query("run_summary", f"SELECT log, sum(listings)::BIGINT AS listings, sum(pages)::BIGINT AS pages, count(DISTINCT region) AS regions, sum(seconds)::BIGINT AS seconds FROM {REPORT} AS r GROUP BY log")(
    lambda t: runlog.region_report(context(t), "log").groupBy("log").agg(F.sum("listings").alias("listings"), F.sum("pages").alias("pages"), F.countDistinct("region").alias("regions"), F.sum("seconds").alias("seconds"))
)
query("region_progress", f"SELECT log, session::BIGINT AS session, round(100.0 * session / 54, 1)::DOUBLE AS percent FROM {SESSIONS} AS s")(lambda t: runlog.sessions(context(t), "log").select("log", "session", F.round(F.lit(100.0) * F.col("session") / 54, 1).alias("percent")))
query("region_errors", f"SELECT log, session::BIGINT AS session, string_agg(label, '; ' ORDER BY first_id) AS errors FROM (SELECT log, session, label, min(event_id) AS first_id FROM {CONTEXT} AS c WHERE label IS NOT NULL GROUP BY ALL) AS x GROUP BY log, session")(
    lambda t: staging.ordered_distinct(context(t), ["log", "session"], "label", "event_id", "errors").withColumn("errors", F.array_join("errors", "; "))
)
query("region_types_seen", f"""SELECT x.log, x.session::BIGINT AS session, unit, place, first_seq, concat(CAST(place AS STRING), '/', CAST(greatest(coalesce(announced, 0), place) AS STRING)) AS counter FROM (SELECT log, session, unit, first_seq, CAST(row_number() OVER (PARTITION BY log, session ORDER BY first_seq, unit) AS INT) AS place FROM (SELECT log, session, unit, min(event_id) AS first_seq FROM {CONTEXT} AS c WHERE kind = 'unit_start' GROUP BY ALL) AS y) AS x
  LEFT JOIN (SELECT log, session, count(DISTINCT unit) AS announced FROM {CONTEXT} AS c WHERE kind = 'preflight' GROUP BY ALL) AS p ON x.log = p.log AND x.session = p.session""")(lambda t: runlog.type_counter(context(t), "log", "event_id"))
TX = "CASE in_transaction WHEN 'prodazhbi' THEN 'sale' WHEN 'naemi' THEN 'rental' END"
query("region_report_full", f"""SELECT r.log, r.session, r.region, listings, pages, errors, seconds, coalesce(labels, '') AS labels, round(100.0 * r.session / 54, 1)::DOUBLE AS percent, CASE WHEN {TX} = 'sale' AND n_nationkey IS NOT NULL THEN concat(CAST(n_nationkey AS STRING), 'h') ELSE '' END AS estimate FROM {REPORT} AS r
  JOIN (SELECT log, session, in_transaction FROM {CONTEXT} AS c0 WHERE kind = 'region_start') AS c ON r.log = c.log AND r.session = c.session LEFT JOIN {{nation}} ON r.region = concat('oblast-', CAST(n_nationkey AS STRING))
  LEFT JOIN (SELECT log, session, string_agg(label, '; ' ORDER BY first_id) AS labels FROM (SELECT log, session, label, min(event_id) AS first_id FROM {CONTEXT} AS c WHERE label IS NOT NULL AND session > 0 GROUP BY ALL) AS x GROUP BY log, session) AS l ON r.log = l.log AND r.session = l.session""")(
    lambda t: runlog.full_region_report(context(t), "log", "event_id", 54, _known_estimates(t), TRANSACTIONS).select("log", "session", "region", "listings", "pages", "errors", "seconds", "labels", "percent", "estimate")
)
query("preflight_tally", f"SELECT log, session::BIGINT AS session, count(DISTINCT CASE WHEN capped THEN unit END) AS capped_types, count(*) FILTER (WHERE NOT capped) AS under_cap, count(*) AS total FROM {CONTEXT} AS c WHERE kind = 'preflight' GROUP BY log, session")(
    lambda t: context(t).where("kind = 'preflight'").groupBy("log", "session").agg(F.countDistinct(F.when(F.col("capped"), F.col("unit"))).alias("capped_types"), F.count_if(~F.col("capped")).alias("under_cap"), F.count(F.lit(1)).alias("total"))
)
query("idle_gaps", f"SELECT log, event_id, idle_s FROM (SELECT log, event_id, epoch(lead(log_ts) OVER (PARTITION BY log ORDER BY log_ts, event_id))::BIGINT - epoch(log_ts)::BIGINT AS idle_s FROM {EVENTS} AS e) AS x WHERE idle_s > 3600")(
    lambda t: runlog.idle_gaps(run_lines(t), "log", "log_ts", ["log_ts", "event_id"], 3600).select("log", "event_id", "idle_s")
)
query("log_kv_summary", "SELECT event_id, concat('oblast-', CAST(user_id % 27 AS STRING)) AS label, event_id % 20 AS pages, user_id AS saved FROM {events} WHERE event_type = 'click' AND event_id % 3 = 2")(
    lambda t: runlog.key_values(runlog.parse_lines(t.run_log), "SCRAPE_UNIT_SUMMARY").select("event_id", F.col("kv")["label"].alias("label"), F.col("kv")["pages"].cast("long").alias("pages"), F.col("kv")["saved"].cast("long").alias("saved"))
)
ZERO = "WHEN event_type = 'click' AND event_id % 5 = 4 THEN 0"
LIGHT = f"""(SELECT event_id, user_id, {LOG} AS log, date_trunc('second', ts) AS log_ts, CASE event_type WHEN 'signup' THEN 'region_start' WHEN 'view' THEN 'region_done' WHEN 'error' THEN 'error' WHEN 'click' THEN CASE event_id % 5 WHEN 0 THEN 'baseline_active' WHEN 1 THEN 'refresh_start' WHEN 2 THEN 'refresh_done' WHEN 3 THEN 'missing' ELSE 'region_done' END ELSE 'run_start' END AS kind,
  CASE WHEN event_type IN ('signup', 'view') OR (event_type = 'click' AND event_id % 5 = 4) THEN concat('oblast-', CAST(user_id % 27 AS STRING)) END AS region,
  CASE WHEN event_type = 'view' THEN event_id % 50 {ZERO} END AS saved, CASE WHEN event_type = 'view' THEN event_id % 7 {ZERO} END AS new, CASE WHEN event_type = 'view' THEN event_id % 5 {ZERO} END AS changed, CASE WHEN event_type = 'view' THEN event_id % 3 {ZERO} END AS reappeared,
  CASE WHEN event_type = 'view' THEN event_id % 90 WHEN event_type = 'click' AND event_id % 5 = 4 THEN user_id END AS unchanged,
  CASE WHEN event_type = 'click' THEN CASE event_id % 5 WHEN 0 THEN 1000 + event_id % 1000 WHEN 2 THEN user_id WHEN 3 THEN user_id END END AS number, CASE WHEN event_type = 'error' THEN 'Connection error' END AS label FROM {{events}})"""
LIGHT_CONTEXT = f"(SELECT *, sum(CASE WHEN kind = 'region_start' THEN 1 ELSE 0 END) OVER (PARTITION BY log ORDER BY log_ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM {LIGHT} AS l)"
MOVES = ("saved", "new", "changed", "reappeared", "unchanged")
MOVE_SUMS = ", ".join(f"coalesce(sum({c}), 0)::BIGINT AS {c}" for c in MOVES)


def light_log(t: Tables) -> DataFrame:
    return runlog.incremental_events(t.light_log)


def light_context(t: Tables) -> DataFrame:
    return runlog.with_context(runlog.parse_lines(t.light_log).withColumn("log", F.col("user_id") % 10), "log", ["log_ts", "event_id"], runlog.incremental_events)


query("log_events_incremental", f"SELECT event_id, kind, region, saved, new, changed, reappeared, unchanged, number, label FROM {LIGHT} AS l")(lambda t: light_log(t).select("event_id", "kind", "region", *MOVES, "number", "label"))
query("region_report_incremental", f"SELECT region, count(*) AS reports, {MOVE_SUMS} FROM {LIGHT} AS l WHERE kind = 'region_done' GROUP BY region")(
    lambda t: light_log(t).where("kind = 'region_done'").groupBy("region").agg(F.count(F.lit(1)).alias("reports"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in MOVES))
)
query("region_sessions_incremental", f"""SELECT s.log, s.session::BIGINT AS session, s.region, {', '.join(MOVES)}, errors, epoch(coalesce(next_ts, last_ts))::BIGINT - epoch(s.log_ts)::BIGINT AS seconds FROM (SELECT *, lead(log_ts) OVER (PARTITION BY log ORDER BY session) AS next_ts FROM {LIGHT_CONTEXT} AS c WHERE kind = 'region_start') AS s
  JOIN (SELECT log, max(log_ts) AS last_ts FROM {LIGHT} AS l GROUP BY log) AS m ON s.log = m.log JOIN (SELECT log, session, {MOVE_SUMS}, count(DISTINCT label) AS errors FROM {LIGHT_CONTEXT} AS c GROUP BY log, session) AS f ON s.log = f.log AND s.session = f.session""".replace("SELECT s.log, s.session::BIGINT AS session, s.region, saved, new, changed, reappeared, unchanged", "SELECT s.log, s.session::BIGINT AS session, s.region, " + ", ".join(f"f.{c}" for c in MOVES)))(
    lambda t: runlog.incremental_region_report(light_context(t), "log").drop("duration")
)
TOTALS = ("new", "changed", "reappeared")
query("incremental_run_summary", f"SELECT log, {', '.join(f'coalesce(sum({c}), 0)::BIGINT AS {c}' for c in TOTALS)}, coalesce(sum(number) FILTER (WHERE kind = 'missing'), 0)::BIGINT AS missing, coalesce(sum(number) FILTER (WHERE kind = 'refresh_done'), 0)::BIGINT AS refreshed FROM {LIGHT} AS l GROUP BY log")(
    lambda t: light_log(t).groupBy((F.col("user_id") % 10).alias("log")).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in TOTALS), *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("number"))), F.lit(0)).alias(n) for k, n in (("missing", "missing"), ("refresh_done", "refreshed"))))
)

# -- sources and sinks ----------------------------------------------------------------------------


def _folder(t: Tables, name: str) -> str:
    """A new folder for what a query writes."""
    return stage_path(t.spark, name)


def _stalest(t: Tables) -> DataFrame:
    return denorm.stalest(_eligible(t)).select("source_id", F.col("position").cast("long").alias("position"))


def _rows(t: Tables) -> DataFrame:
    return scan_rows(t).select("source_id", F.concat(F.lit('a "q",\n'), F.col("region")).alias("note"), "price_raw")


ROWS = "SELECT source_id, concat('a \"q\",', chr(10), region) AS note, price_raw FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq, region) AS rn FROM {sightings} WHERE trim(source_id) <> '') AS f WHERE rn = 1"


@query("source_csv_roundtrip", ROWS)
def source_csv_roundtrip(t: Tables) -> DataFrame:
    path = _folder(t, "csv")
    rows = _rows(t)
    tables.write_csv(rows, path)
    return tables.read_csv(t.spark, path, rows.schema)


@query("sink_listings_roundtrip", ROWS.replace("source_id,", "source_id, NULL::STRING AS gas, NULL::INT AS year_built, 1 AS has_photos, 61.5::DOUBLE AS area_m2, ", 1).replace("concat('a \"q\",', chr(10), region) AS note, ", "region, "))
def sink_listings_roundtrip(t: Tables) -> DataFrame:
    """Listings in their columns and types through files with a byte order mark."""
    path = _folder(t, "listings")
    rows = tables.listing_columns(scan_rows(t).withColumns({"price": F.col("price_raw"), "has_photos": F.lit(True), "area_m2": F.lit("61.5")}))
    tables.write_csv(rows, path)
    read = tables.read_csv(t.spark, path, rows.schema)
    return read.select("source_id", "gas", "year_built", F.col("has_photos").cast("int").alias("has_photos"), "area_m2", "region", F.col("price").alias("price_raw"))


@query("sink_jsonl_roundtrip", ROWS)
def sink_jsonl_roundtrip(t: Tables) -> DataFrame:
    path = _folder(t, "jsonl")
    rows = _rows(t)
    tables.write_jsonl(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query("source_jsonl_reject", "SELECT CASE event_id % 5 WHEN 1 THEN 'bad json' WHEN 2 THEN 'no id' WHEN 3 THEN 'no payload' ELSE 'ok' END AS reason, count(*) AS n FROM {events} WHERE event_id % 5 <> 4 GROUP BY 1")
def source_jsonl_reject(t: Tables) -> DataFrame:
    good, bad = tables.read_jsonl(t.events.select(json_line().alias("value")), "source_id string, listing struct<price:int>", "listing")
    return good.select(F.lit("ok").alias("reason")).unionByName(bad.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def json_line() -> Column:
    """A staging record of an event, of which four in five are no good."""
    k = F.col("event_id") % 5
    eid = F.col("event_id").cast("string")
    return F.when(k == 0, F.concat(F.lit('{"source_id":"'), eid, F.lit('","listing":{"price":1}}'))).when(k == 1, F.concat(F.lit('{"source_id":'), eid, F.lit("x"))).when(k == 2, F.lit('{"source_id":" ","listing":{"price":1}}')).when(k == 3, F.concat(F.lit('{"source_id":"'), eid, F.lit('"}'))).otherwise("  ")


@query("source_jsonl_files", "SELECT part, line, CASE event_id % 5 WHEN 1 THEN 'bad json' WHEN 2 THEN 'no id' ELSE 'no payload' END AS reason FROM (SELECT event_id, event_id % 3 AS part, row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) AS line FROM {events}) AS x WHERE event_id % 5 IN (1, 2, 3)")
def source_jsonl_files(t: Tables) -> DataFrame:
    """Rejected records of staging files with the line that they stand in."""
    path = _folder(t, "staging")
    rows = t.events.select("event_id", (F.col("event_id") % 3).alias("part"), json_line().alias("value"))
    # one file for each part, in order, as a staging file is appended to
    rows.repartition(3, "part").sortWithinPartitions("part", "event_id").select("part", "value").write.partitionBy("part").text(path)
    _, bad = tables.read_jsonl_files(t.spark, path, "source_id string, listing struct<price:int>", "listing")
    return bad.select(F.regexp_extract("file", r"/part=(\d+)/", 1).cast("long").alias("part"), "line", "reason")


@query("export_versions", f"SELECT source_id, region, price_raw, 2 AS version FROM ({ROWS.replace('concat(' + chr(39) + 'a \"q\",' + chr(39) + ', chr(10), region) AS note', 'region')}) AS r WHERE region <> 'NATION_1'")
def export_versions(t: Tables) -> DataFrame:
    """The current version of a snapshot after two exports and a failed third one."""
    root, rows = _folder(t, "snapshot"), scan_rows(t)
    columns = ["source_id", "region", "price_raw"]
    tables.publish(rows.limit(0), root, columns)
    version = tables.publish(rows.where("region <> 'NATION_1'"), root, columns)
    broken = F.when(F.col("source_id") != "", F.raise_error(F.lit("no more disk")).cast("string"))
    with contextlib.suppress(PySparkException, Py4JJavaError):
        tables.publish(rows.withColumn("region", broken), root, columns)
    return tables.current(t.spark, root).withColumn("version", F.lit(version))


@query("log_mixed_bytes", f"SELECT {LOG} AS log, count(*) AS lines, CAST({LOG} % 2 = 0 AS INT) AS is_utf8, sum(length(concat(CASE WHEN {LOG} % 2 = 0 THEN 'Област № ' ELSE 'Café à ' END, CAST(event_id AS STRING))))::BIGINT AS chars, count(*) AS right_lines FROM {{events}} GROUP BY ALL")
def log_mixed_bytes(t: Tables) -> DataFrame:
    """Lines of files of which some are no UTF-8."""
    path = _folder(t, "mixed-logs")
    log = F.col("user_id") % 10
    said = F.concat(F.when(log % 2 == 0, "Област № ").otherwise("Café à "), F.col("event_id").cast("string"))
    # a Latin-1 file's bytes, put down as they are
    as_bytes = F.when(log % 2 == 0, said).otherwise(F.encode(F.when(log % 2 == 1, said), "ISO-8859-1").cast("string"))
    t.events.select(log.alias("log"), as_bytes.alias("value")).write.partitionBy("log").text(path)
    lines = tables.read_log_bytes(t.spark, path)
    place = F.regexp_extract("path", r"/log=(\d+)/", 1).cast("long").alias("log")
    return lines.groupBy(place).agg(F.count(F.lit(1)).alias("lines"), F.max(F.col("is_utf8").cast("int")).alias("is_utf8"), F.sum(F.length("line")).cast("long").alias("chars"), F.count_if(F.col("line").rlike(r"^(Област №|Café à) \d+$")).alias("right_lines"))


@query("export_rows_sorted", "SELECT source_id, region, price_raw FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq, region) AS rn FROM {sightings} WHERE trim(source_id) <> '') AS f WHERE rn = 1")
def export_rows_sorted(t: Tables) -> DataFrame:
    path = _folder(t, "export")
    tables.export_sorted(scan_rows(t), path, ["source_id", "region", "price_raw"])
    return t.spark.read.parquet(path)


@query("sink_partitioned", "SELECT transaction_type, CAST(date_last_checked AS DATE) AS run_date, count(*) AS n FROM {state} WHERE date_last_checked IS NOT NULL GROUP BY ALL")
def sink_partitioned(t: Tables) -> DataFrame:
    """Folders by transaction and run date; the counts come from the folders alone."""
    path = _folder(t, "partitioned")
    tables.write_partitioned(t.state.where("date_last_checked IS NOT NULL"), "date_last_checked", path)
    return t.spark.read.parquet(path).groupBy("transaction_type", "run_date").agg(F.count(F.lit(1)).alias("n"))


@query("scan_pages_one_byte", "SELECT page_id, url, html FROM {portal_pages}")
def scan_pages_one_byte(t: Tables) -> DataFrame:
    """Pages stored as bytes of the Cyrillic code page, decoded."""
    path = _folder(t, "one-byte-pages")
    t.portal_pages.select("page_id", "url", tables.to_windows_1251(F.col("html")).alias("content")).write.parquet(path)
    return t.spark.read.schema("page_id long, url string, content binary").parquet(path).select("page_id", "url", tables.from_windows_1251(F.col("content")).alias("html"))


@query("log_file_lines", f"SELECT {LOG} AS log, count(*) AS lines, count(DISTINCT event_id) AS distinct_lines, count(*) FILTER (WHERE event_type = 'error') AS errors FROM {{events}} GROUP BY 1")
def log_file_lines(t: Tables) -> DataFrame:
    """Lines of log files, by the folder of the log."""
    path = _folder(t, "logs")
    t.run_log.select((F.col("user_id") % 10).alias("log"), F.concat("line", F.lit(" #"), F.col("event_id").cast("string")).alias("value")).write.partitionBy("log").text(path)
    lines = runlog.parse_lines(tables.read_log(t.spark, path))
    place = F.regexp_extract("path", r"/log=(\d+)/", 1).cast("long").alias("log")
    return lines.groupBy(place).agg(F.count(F.lit(1)).alias("lines"), F.countDistinct(F.regexp_extract("line", r"#(\d+)$", 1)).alias("distinct_lines"), F.count_if(F.col("level") == "ERROR").alias("errors"))


@query("selection_snapshot", f"SELECT source_id, position FROM {SELECTED}")
def selection_snapshot(t: Tables) -> DataFrame:
    """A refresh selection, written once and reloaded with its check."""
    path = _folder(t, "selection")
    tables.write_selection(_stalest(t), path)
    return tables.load_selection(t.spark, path)


@query("card_listing_rows", f"""SELECT CASE WHEN c.k % 13 <> 0 THEN CAST(c.k AS STRING) END AS source_id, n_name AS region, 'sale' AS transaction_type, 'active' AS status, concat(CAST(c.k AS STRING), ' 990 €') AS price, NULL::INT AS bedrooms, NULL::STRING AS gas, NULL::STRING AS tec, NULL::INT AS year_built, NULL::STRING AS features,
  NULL::STRING AS date_posted, NULL::STRING AS scraped_at, CAST(c.k % 90 + 20 AS DOUBLE) AS area_m2, 27 AS n_columns FROM {CARD} AS c JOIN {{nation}} ON c_nationkey = n_nationkey""")
def card_listing_rows(t: Tables) -> DataFrame:
    """Cards as whole listings: region from its dimension, transaction from the url, null where only later steps know more."""
    regions = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("https://www.imot.bg/obiavi/prodazhbi/p-"), F.col("c_custkey").cast("string")).alias("url"), F.col("n_name").alias("region"))
    rows = pages.listing_rows(cards(t), regions)
    return rows.select("source_id", "region", "transaction_type", "status", "price", "bedrooms", "gas", "tec", "year_built", "features", "date_posted", "scraped_at", "area_m2", F.lit(len(rows.columns)).alias("n_columns"))


# -- streams --------------------------------------------------------------------------------------


def _drain(t: Tables, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what there is into a Parquet table and read that."""
    out = _folder(t, name)
    stream.writeStream.format("parquet").outputMode(mode).option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


def _as_stream(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    path = _folder(t, name)
    rows.write.parquet(path)
    return t.spark.readStream.schema(rows.schema).parquet(path)


def _event_stream(t: Tables) -> DataFrame:
    lines = _as_stream(t, t.run_log.withColumn("log", (F.col("user_id") % 10).cast("string")), "log-stream")
    return streams.log_events(lines)


@query("stream_log_events", "SELECT kind, count(*) AS n FROM " + EVENTS + " AS e WHERE kind IS NOT NULL GROUP BY kind")
def stream_log_events(t: Tables) -> DataFrame:
    return _drain(t, _event_stream(t).where("kind IS NOT NULL").select("event_id", "kind"), "log-events").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


#: How late lines may be in the queries' streams.
LATE = "10 minutes"


def _lines_and_clock(t: Tables) -> DataFrame:
    """The stream of a run's events, and behind them one line of another log that is as much later as lines may be late: with it the clock has passed all.
    All files are one micro-batch: they lie in no order of time, and after a part of them the clock would have passed lines of the others."""
    lines = runlog.parse_lines(t.run_log.withColumn("log", (F.col("user_id") % 10).cast("string")))
    path = _folder(t, "timed-lines")
    lines.write.parquet(path)
    tick = t.run_log.agg((F.date_trunc("second", F.max("ts")).cast("timestamp_ntz") + F.expr(f"INTERVAL {LATE}") + F.expr("INTERVAL 1 second")).alias("log_ts"))
    tick.select(*(F.col("log_ts") if c == "log_ts" else F.lit("clock" if c == "log" else None).cast(lines.schema[c].dataType).alias(c) for c in lines.columns)).write.mode("append").parquet(path)
    return runlog.full_events(t.spark.readStream.schema(lines.schema).parquet(path))


@query("stream_region_report", f"SELECT CAST(log AS STRING) AS log, session::BIGINT AS session, region, listings, errors FROM {REPORT} AS r WHERE session < (SELECT max(session) FROM {CONTEXT} AS c WHERE c.log = r.log)")
def stream_region_report(t: Tables) -> DataFrame:
    """Region reports of a running log, in the order of its lines' time."""
    return _drain(t, streams.region_reports(_lines_and_clock(t), "log_ts", LATE, None), "reports").where("kind = 'report'").select("log", "session", "region", "listings", "errors")


SIGHTING = "source_id STRING, region STRING, seq STRING, observed_at TIMESTAMP"


def _first_sightings(t: Tables) -> DataFrame:
    """First sightings of a scan that comes in three parts, some years apart each, in the order of time."""
    path, out = _folder(t, "scan-stream"), _folder(t, "sightings")
    scan = t.sightings.select("source_id", "region", "seq", F.substring("seq", 1, 10).cast("timestamp").alias("observed_at"))
    table = f"sightings_{out.rpartition('-')[2]}"
    sink = streams.FirstSightings(t.spark, table, f"{out}/data", SIGHTING, ["seq", "region"], 8)
    for a, b in (("", "1994"), ("1994", "1996"), ("1996", "9")):  # the stream ends and goes on between the parts
        scan.where((F.col("seq") >= a) & (F.col("seq") < b)).write.mode("append").parquet(path)
        stream = t.spark.readStream.schema(scan.schema).parquet(path)
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.table(table)


@query("stream_seen_ids", "SELECT DISTINCT source_id FROM {sightings} WHERE trim(source_id) <> ''")
def stream_seen_ids(t: Tables) -> DataFrame:
    return _first_sightings(t).select("source_id")


@query("stream_first_sightings", f"SELECT source_id, region, seq, CAST(left(seq, 10) AS TIMESTAMP) AS observed_at FROM {FIRSTS}")
def stream_first_sightings(t: Tables) -> DataFrame:
    """The first sighting of each id over a run, however long ago."""
    return _first_sightings(t).select("source_id", "region", "seq", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"))


@query("stream_ingest", "SELECT source_id, region, seq FROM {sightings}")
def stream_ingest(t: Tables) -> DataFrame:
    scan = _as_stream(t, t.sightings.select("source_id", "region", "seq"), "ingest-stream")
    out = _folder(t, "ingest")
    scan.writeStream.foreachBatch(streams.idempotent_sink(f"{out}/data", "run")).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{out}/data").select("source_id", "region", "seq")


@query("stream_classify", "SELECT action, count(*) AS n FROM (SELECT CASE WHEN s.source_id IS NULL THEN 'new' WHEN s.status = 'inactive' THEN 'reappeared' WHEN s.price IS DISTINCT FROM TRY_CAST(replace(replace(price_raw, ' ', ''), '€', '') AS DECIMAL(20,4)) THEN 'changed' ELSE 'unchanged' END AS action FROM (SELECT * FROM {sightings} WHERE trim(source_id) <> '') f LEFT JOIN {state} s ON f.source_id = s.source_id) AS x GROUP BY action")
def stream_classify(t: Tables) -> DataFrame:
    from estatelake.functions.text import parse_price

    scan = _as_stream(t, t.sightings.select("source_id", "price_raw"), "classify-stream").withColumn("price", parse_price(F.col("price_raw")))
    return _drain(t, streams.classify_stream(scan, t.state).select("source_id", "action"), "classified").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("stream_notifications", f"SELECT kind, notice, count(*) AS n FROM (SELECT kind, CASE WHEN kind = 'region_start' THEN concat('region ', region) ELSE label END AS notice FROM {EVENTS} AS e WHERE kind = 'region_start' OR label IS NOT NULL) AS x GROUP BY kind, notice")
def stream_notifications(t: Tables) -> DataFrame:
    return _drain(t, streams.notifications(_event_stream(t)).select("kind", "notice"), "notices").groupBy("kind", "notice").agg(F.count(F.lit(1)).alias("n"))


@query("stream_idle", f"SELECT CAST(log AS BIGINT) AS log, count(*) AS gaps FROM (SELECT log, epoch(coalesce(lead(log_ts) OVER (PARTITION BY log ORDER BY log_ts, event_id), max(log_ts) OVER () + INTERVAL 1 SECOND))::BIGINT - epoch(log_ts)::BIGINT AS idle_s FROM {EVENTS} AS e) AS x WHERE idle_s > 7200 GROUP BY log")
def stream_idle(t: Tables) -> DataFrame:
    """How often each log was silent for more than two hours, by the watchdog's timer, up to the last line of all."""
    notices = _drain(t, streams.region_reports(_lines_and_clock(t), "log_ts", LATE, 7200), "idle").where("kind = 'idle'")
    return notices.groupBy(F.col("log").cast("long").alias("log")).agg(F.count(F.lit(1)).alias("gaps"))


@query("event_time_counts", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM {events} GROUP BY ALL")
def event_time_counts(t: Tables) -> DataFrame:
    return streams.event_counts(t.events).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")

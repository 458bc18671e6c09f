"""Queries on listings: functions, quality, reconciliation, merges, star join, planner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.functions import text as fx
from estatelake.operators import denorm, planner, quality, reconcile, staging
from estatelake.plans.registry import Tables, query
from estatelake.schema import LOCALITY_TYPES, PRICE_BOUNDS, code_map

# -- scalar functions -----------------------------------------------------------------------------

INFO = "l_orderkey, l_linenumber, l_partkey"


def _info(t: Tables, **columns) -> DataFrame:
    return t.info_text.select("l_orderkey", "l_linenumber", "l_partkey", *(c.alias(n) for n, c in columns.items()))


query("fn_area", f"SELECT {INFO}, TRY_CAST(nullif(regexp_extract(info, '([0-9]+(?:\\.[0-9]+)?)\\s*кв\\.м', 1), '') AS DOUBLE) AS area_m2 FROM {{info_text}}")(lambda t: _info(t, area_m2=fx.area_m2(F.col("info"))))
query("fn_floor", f"SELECT {INFO}, CASE WHEN l_linenumber % 4 <> 0 THEN concat(CAST(l_linenumber AS STRING), ' от ', CAST(l_partkey % 20 AS STRING)) END AS floor FROM {{info_text}}")(lambda t: _info(t, floor=fx.floor_text(F.col("info"))))
query("fn_phone", f"SELECT {INFO}, nullif(replace(trim(regexp_extract(info, 'тел\\.:\\s*([0-9\\s]+)', 1)), ' ', ''), '') AS phone FROM {{info_text}}")(lambda t: _info(t, phone=fx.phone(F.col("info"))))
query("fn_year", f"SELECT {INFO}, TRY_CAST(nullif(regexp_extract(info, '([0-9][0-9][0-9][0-9])\\s*г\\.', 1), '') AS INT) AS year_built FROM {{info_text}}")(lambda t: _info(t, year_built=fx.year_built(F.col("info"))))
query("fn_construction", f"""SELECT {INFO}, CASE WHEN lower(info) LIKE '%сглобяема конструкция%' THEN 'Сглобяема конструкция' WHEN lower(info) LIKE '%епк%' THEN 'Епк' WHEN lower(info) LIKE '%пк%' THEN 'Пк'
  WHEN lower(info) LIKE '%гредоред%' THEN 'Гредоред' WHEN lower(info) LIKE '%панел%' THEN 'Панел' WHEN lower(info) LIKE '%тухла%' THEN 'Тухла' END AS construction FROM {{info_text}}""")(lambda t: _info(t, construction=fx.construction(F.col("info"))))
query("info_fields", f"""SELECT {INFO}, TRY_CAST(nullif(regexp_extract(info, '([0-9]+(?:\\.[0-9]+)?)\\s*кв\\.м', 1), '') AS DOUBLE) AS area_m2,
  CASE WHEN l_linenumber % 4 <> 0 THEN concat(CAST(l_linenumber AS STRING), ' от ', CAST(l_partkey % 20 AS STRING)) END AS floor, nullif(replace(trim(regexp_extract(info, 'тел\\.:\\s*([0-9\\s]+)', 1)), ' ', ''), '') AS phone FROM {{info_text}}""")(
    lambda t: _info(t, area_m2=fx.area_m2(F.col("info")), floor=fx.floor_text(F.col("info")), phone=fx.phone(F.col("info")))
)
query("fn_price", "SELECT source_id, seq, price_raw, CAST(TRY_CAST(replace(replace(price_raw, ' ', ''), '€', '') AS DECIMAL(20,4)) AS DOUBLE) AS price FROM {sightings}")(
    lambda t: t.sightings.select("source_id", "seq", "price_raw", fx.parse_price(F.col("price_raw")).cast("double").alias("price"))
)
query("fn_prices_differ", "SELECT i.source_id, i.seq, CAST(TRY_CAST(replace(replace(price_raw, ' ', ''), '€', '') AS DECIMAL(20,4)) IS DISTINCT FROM s.price AS INT) AS differ FROM {sightings} i JOIN {state} s ON i.source_id = s.source_id")(
    lambda t: t.sightings.join(t.state.select("source_id", "price"), "source_id").select("source_id", "seq", fx.prices_differ(F.col("price"), fx.parse_price(F.col("price_raw"))).cast("int").alias("differ"))
)
query("fn_property_type", "SELECT c_custkey, nullif(trim(regexp_replace(title, '^(Продава |Дава под наем )', '')), '') AS property_type FROM {titles}")(lambda t: t.titles.select("c_custkey", fx.property_type(F.col("title")).alias("property_type")))


@query("fn_location_area", """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'град София' WHEN 1 THEN 'гр. Банско' WHEN 2 THEN 'с. Марково' WHEN 3 THEN 'с. Марково' WHEN 4 THEN 'к.к. Слънчев бряг' WHEN 5 THEN 'Слънчев бряг' WHEN 6 THEN 'село Бистрица' ELSE 'Варна' END AS locality,
  CASE c_custkey % 8 WHEN 0 THEN 'Лозенец' END AS area FROM {titles}""")
def fn_location_area(t: Tables) -> DataFrame:
    locality, area = fx.split_location(F.col("place"))
    return t.titles.select("c_custkey", locality.alias("locality"), area.alias("area"))


@query("fn_locality", """SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'град' WHEN 1 THEN 'град' WHEN 2 THEN 'село' WHEN 3 THEN 'село' WHEN 4 THEN 'к.к.' WHEN 5 THEN 'Слънчев' WHEN 6 THEN 'село' END AS locality_type,
  CASE c_custkey % 8 WHEN 0 THEN 'София' WHEN 1 THEN 'Банско' WHEN 2 THEN 'Марково' WHEN 3 THEN 'Марково' WHEN 4 THEN 'Слънчев бряг' WHEN 5 THEN 'бряг' WHEN 6 THEN 'Бистрица' ELSE 'Варна' END AS locality FROM {titles}""")
def fn_locality(t: Tables) -> DataFrame:
    kind, name = fx.split_locality(fx.split_location(F.col("place"))[0])
    return t.titles.select("c_custkey", kind.alias("locality_type"), name.alias("locality"))


MONTH_SQL = "CASE month({0}) WHEN 1 THEN 'януари' WHEN 2 THEN 'февруари' WHEN 3 THEN 'март' WHEN 4 THEN 'април' WHEN 5 THEN 'май' WHEN 6 THEN 'юни' WHEN 7 THEN 'юли' WHEN 8 THEN 'август' WHEN 9 THEN 'септември' WHEN 10 THEN 'октомври' WHEN 11 THEN 'ноември' ELSE 'декември' END"


def date_sql(column: str, label: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN concat('{label} в ', strftime({column}, '%H:%M'), ' на ', CAST(day({column}) AS STRING), ' ', {MONTH_SQL.format(column)}, ', ', CAST(year({column}) AS STRING), ' год.') END"


query("fn_date_render", f"SELECT event_id, {date_sql('ts', 'Публикувана')} AS rendered FROM {{events}}")(lambda t: t.events.select("event_id", fx.render_date(F.col("ts"), "Публикувана").alias("rendered")))
query("map_codes", "SELECT geo_id, CASE locality_type WHEN 'city' THEN 'град' WHEN 'village' THEN 'село' ELSE locality_type END AS label, level FROM {geographies}")(lambda t: t.geographies.select("geo_id", code_map(LOCALITY_TYPES, F.col("locality_type")).alias("label"), "level"))


def _urls(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.when(k % 7 == 0, "zamiana").when(k % 2 == 0, "prodazhbi").otherwise("naemi").alias("tx"), F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("oblast-"), (k % 27).cast("string"))).alias("slug"),
        F.when(k % 3 == 0, F.concat(F.lit("tip-"), (k % 20).cast("string"))).alias("kind"), (k % 5).cast("int").alias("page"), F.when(k % 4 == 0, k).alias("low"), F.when(k % 8 == 0, k + 100).when(k % 12 == 4, k - 1).alias("high"),
    )


URL_SQL = """WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'zamiana' WHEN c_custkey % 2 = 0 THEN 'prodazhbi' ELSE 'naemi' END AS tx, CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE concat('oblast-', CAST(c_custkey % 27 AS STRING)) END AS slug,
  CASE WHEN c_custkey % 3 = 0 THEN concat('tip-', CAST(c_custkey % 20 AS STRING)) END AS kind, c_custkey % 5 AS page, CASE WHEN c_custkey % 4 = 0 THEN c_custkey END AS low, CASE WHEN c_custkey % 8 = 0 THEN c_custkey + 100 WHEN c_custkey % 12 = 4 THEN c_custkey - 1 END AS high FROM {customer}),
e AS (SELECT *, CASE WHEN tx = 'zamiana' THEN 'transaction' WHEN trim(slug) = '' THEN 'slug' WHEN page < 1 THEN 'page' WHEN (low IS NULL) <> (high IS NULL) THEN 'one bound' WHEN low < 0 OR high < low THEN 'bounds' END AS error FROM u)
SELECT c_custkey, error, CASE WHEN error IS NULL THEN concat('https://www.imot.bg/obiavi/', concat_ws('/', tx, slug, kind, CASE WHEN page > 1 THEN concat('p-', CAST(page AS STRING)) END), CASE WHEN low IS NOT NULL THEN concat('?price_min=', CAST(low AS STRING), '&price_max=', CAST(high AS STRING)) ELSE '' END) END AS url FROM e"""


@query("plan_urls", URL_SQL)
def plan_urls(t: Tables) -> DataFrame:
    c = F.col
    return _urls(t).select("c_custkey", fx.url_error(c("tx"), c("slug"), c("page"), c("low"), c("high")).alias("error"), fx.page_url(c("tx"), c("slug"), c("kind"), c("page"), c("low"), c("high")).alias("url"))


query("fn_redirect", "SELECT event_id, CAST(page_type = 'detail' AND final_url LIKE '%/obiavi/%' AND url LIKE '%/obiava-%' AS INT) AS gone FROM {fetch_log}")(lambda t: t.fetch_log.select("event_id", fx.redirected_to_listings(F.col("url"), F.col("final_url")).cast("int").alias("gone")))


@query("fn_range_key", "SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey END AS low, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey * 2 END AS high FROM {customer}")
def fn_range_key(t: Tables) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    key = F.when(F.col("c_custkey") % 6 == 0, F.lit("oblast:tip")).otherwise(F.concat(F.lit("oblast-x:tip:"), k, F.lit("-"), (F.col("c_custkey") * 2).cast("string")))
    low, high = fx.range_key(key)
    return t.customer.select("c_custkey", low.alias("low"), high.alias("high"))


query("fn_duration", """SELECT event_id, CASE WHEN s >= 3600 THEN concat(CAST(s // 3600 AS STRING), 'h ', CAST(s % 3600 // 60 AS STRING), 'm ', CAST(s % 60 AS STRING), 's') WHEN s >= 60 THEN concat(CAST(s // 60 AS STRING), 'm ', CAST(s % 60 AS STRING), 's') ELSE concat(CAST(s AS STRING), 's') END AS duration
FROM (SELECT event_id, (event_id * 37) % 20000 AS s FROM {events}) AS x""")(lambda t: t.events.select("event_id", fx.duration_text(F.col("event_id") * 37 % 20000).alias("duration")))
query("fn_estimate_text", """SELECT event_id, CASE WHEN s >= 3600 THEN concat(CAST(s // 3600 AS STRING), 'h ', lpad(CAST(s % 3600 // 60 AS STRING), 2, '0'), 'm', CASE WHEN s % 60 > 0 THEN concat(' ', lpad(CAST(s % 60 AS STRING), 2, '0'), 's') ELSE '' END)
  WHEN s >= 60 THEN concat(CAST(s // 60 AS STRING), 'm', CASE WHEN s % 60 > 0 THEN concat(' ', lpad(CAST(s % 60 AS STRING), 2, '0'), 's') ELSE '' END) ELSE concat(CAST(s AS STRING), 's') END AS estimate
FROM (SELECT event_id, event_id * 60 % 40000 + event_id % 3 AS s FROM {events}) AS x""")(lambda t: t.events.select("event_id", fx.estimate_text((F.col("event_id") * 60 % 40000 + F.col("event_id") % 3) / F.lit(86400.0)).alias("estimate")))
query("fn_base_type", "SELECT event_id, concat('tip-', CAST(event_id % 5 AS STRING)) AS base FROM {events}")(lambda t: t.events.select("event_id", fx.base_type(F.concat(F.lit("tip-"), (F.col("event_id") % 5).cast("string"), F.lit(" ["), F.col("user_id").cast("string"), F.lit("-9]"))).alias("base")))
query("fn_error_label", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Connection error' WHEN 1 THEN concat('Soft-block — oblast-', CAST(user_id % 27 AS STRING), ' [1–9]') WHEN 3 THEN concat('Pre-flight failed — oblast-', CAST(user_id % 27 AS STRING)) END AS label FROM {events} WHERE event_type = 'error'""")(
    lambda t: t.run_log.where(F.col("line").contains("[ERROR]")).select("event_id", fx.error_label(F.col("line")).alias("label"))
)
query("fn_run_id", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS run_id FROM {events}")(lambda t: t.events.select("event_id", fx.run_id(F.col("ts")).alias("run_id")))

# -- quality --------------------------------------------------------------------------------------

REASON = """CASE WHEN trim(coalesce(source_id, '')) = '' THEN 'source_id' WHEN trim(coalesce(listing_url, '')) = '' THEN 'listing_url' WHEN trim(coalesce(property_type, '')) = '' THEN 'property_type'
  WHEN trim(coalesce(locality, '')) = '' THEN 'locality' WHEN area_m2 <= 0 THEN 'area_m2' WHEN year_built <= 0 THEN 'year_built' END"""

query("valid_listings", f"SELECT source_id, listing_url, property_type, locality, area_m2, year_built, seq FROM {{listings}} WHERE {REASON} IS NULL")(lambda t: quality.valid(t.listings).select("source_id", "listing_url", "property_type", "locality", "area_m2", "year_built", "seq"))
query("reject_reasons", f"SELECT region, {REASON} AS reason, count(*) AS n FROM {{listings}} WHERE {REASON} IS NOT NULL GROUP BY ALL")(lambda t: quality.with_reason(t.listings).where("reason IS NOT NULL").groupBy("region", "reason").agg(F.count(F.lit(1)).alias("n")))
query("quality_counts", f"SELECT region, count(*) AS found, count(*) FILTER (WHERE {REASON} IS NULL) AS saved, count({REASON}) AS rejected FROM {{listings}} GROUP BY region")(lambda t: quality.counts(t.listings, "region"))
query("top_rejected_field", f"""WITH b AS (SELECT CASE WHEN coalesce(source_id, '') = '' THEN 'source_id' WHEN coalesce(listing_url, '') = '' THEN 'listing_url' WHEN coalesce(property_type, '') = '' THEN 'property_type' WHEN coalesce(locality, '') = '' THEN 'locality' END AS field, seq
  FROM {{listings}} WHERE {REASON} IS NOT NULL), c AS (SELECT field, count(*) AS n, min(seq) AS first FROM b WHERE field IS NOT NULL GROUP BY field) SELECT field, n FROM c ORDER BY n DESC, first LIMIT 1""")(lambda t: quality.top_rejected_field(t.listings, "seq"))
query("early_rejection_warning", f"""SELECT region, count(*) AS n, count({REASON}) AS rejected, CAST(count(*) >= 100 AND count({REASON}) >= 20 AS INT) AS warning FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY seq, source_id, listing_url) AS r FROM {{listings}}) AS x WHERE r <= 100 GROUP BY region""")(
    lambda t: quality.early_warning(t.listings, ["region"], ["seq", "source_id", "listing_url"]).withColumn("warning", F.col("warning").cast("int"))
)
query("refresh_outcomes", f"SELECT flag AS region_flag, count(*) FILTER (WHERE flag <> 'R' AND {REASON} IS NULL) AS saved, count(*) FILTER (WHERE flag = 'R' OR {REASON} IS NOT NULL) AS rejected FROM {{listings}} GROUP BY flag")(
    lambda t: quality.with_reason(t.listings).groupBy(F.col("flag").alias("region_flag")).agg(F.count_if((F.col("flag") != "R") & F.col("reason").isNull()).alias("saved"), F.count_if((F.col("flag") == "R") | F.col("reason").isNotNull()).alias("rejected"))
)
query("invalid_actions", "SELECT source_id, action, seq FROM {actions} WHERE action NOT IN ('new', 'changed', 'unchanged', 'reappeared', 'missing', 'refreshed')")(lambda t: staging.invalid_actions(t.actions).select("source_id", "action", "seq"))
query("pass2_summary", f"SELECT count(*) AS selected, count(*) FILTER (WHERE flag <> 'R') AS completed, count(*) FILTER (WHERE flag <> 'R' AND {REASON} IS NULL) AS saved, count(*) FILTER (WHERE flag <> 'R' AND {REASON} IS NOT NULL) AS rejected FROM {{listings}}")(
    lambda t: quality.with_reason(t.listings).agg(F.count(F.lit(1)).alias("selected"), F.count_if(F.col("flag") != "R").alias("completed"), F.count_if((F.col("flag") != "R") & F.col("reason").isNull()).alias("saved"), F.count_if((F.col("flag") != "R") & F.col("reason").isNotNull()).alias("rejected"))
)

# -- merges ---------------------------------------------------------------------------------------


def scan_rows(t: Tables) -> DataFrame:
    """The scan, one row for each id: the first region that saw it."""
    s = t.sightings.withColumn("price", fx.parse_price(F.col("price_raw")))
    return staging.first_wins(staging.keyed(s), ["source_id"], F.struct("seq", "region"))


FIRSTS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq, region) AS rn FROM {sightings} WHERE trim(source_id) <> '') AS f WHERE rn = 1)"
PRICE = "TRY_CAST(replace(replace(price_raw, ' ', ''), '€', '') AS DECIMAL(20,4))"

query("seen_ids_first", f"SELECT source_id, region, seq AS first_seen FROM {FIRSTS}")(lambda t: scan_rows(t).select("source_id", "region", F.col("seq").alias("first_seen")))
query("index_rows_first", f"SELECT source_id, region, scan_unit, seq, price_raw FROM {FIRSTS}")(lambda t: scan_rows(t).select("source_id", "region", "scan_unit", "seq", "price_raw"))
query("rows_last", "SELECT source_id, region, seq, price_raw FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY seq DESC, region DESC) AS rn FROM {sightings} WHERE trim(source_id) <> '') AS f WHERE rn = 1")(
    lambda t: staging.last_wins(staging.keyed(t.sightings), ["source_id"], F.struct("seq", "region")).select("source_id", "region", "seq", "price_raw")
)
query("actions_effective", "SELECT source_id, action, seq FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY CASE WHEN action IN ('new', 'changed', 'reappeared', 'missing') THEN 1 ELSE 0 END DESC, seq DESC) AS rn FROM {actions} WHERE action <> 'moved') AS a WHERE rn = 1")(
    lambda t: staging.effective_actions(t.actions).select("source_id", "action", "seq")
)
query("selection_dedup", "SELECT source_id, min(seq) AS position FROM {sightings} WHERE trim(source_id) <> '' GROUP BY source_id")(lambda t: staging.selection_dedup(t.sightings.select("source_id", F.col("seq").alias("position")), "source_id", "position"))
query("selection_integrity", "SELECT trim(source_id) AS source_id, count(*) AS n FROM {sightings} GROUP BY trim(source_id) HAVING count(*) > 1 OR trim(source_id) = ''")(lambda t: _faults(t.sightings))


def _faults(rows: DataFrame) -> DataFrame:
    from estatelake.sources.tables import selection_faults

    return selection_faults(rows)


# -- reconciliation -------------------------------------------------------------------------------

CLASSIFIED = f"""(SELECT f.source_id, f.region, f.seq, {PRICE} AS price, CASE WHEN s.source_id IS NULL THEN 'new' WHEN s.status = 'inactive' THEN 'reappeared' WHEN s.price IS DISTINCT FROM {PRICE} THEN 'changed' ELSE 'unchanged' END AS action,
  CASE WHEN s.status = 'inactive' OR s.price IS DISTINCT FROM {PRICE} THEN s.listing_id END AS listing_id, CASE WHEN s.status = 'inactive' OR s.price IS DISTINCT FROM {PRICE} THEN s.price END AS old_price
  FROM {FIRSTS} AS f LEFT JOIN {{state}} s ON f.source_id = s.source_id)"""


def classified(t: Tables) -> DataFrame:
    return reconcile.classify(scan_rows(t).select("source_id", "region", "seq", "price"), t.state)


query("classify_listings", f"SELECT source_id, region, action, listing_id, CAST(price AS DOUBLE) AS price, CAST(old_price AS DOUBLE) AS old_price FROM {CLASSIFIED}")(
    lambda t: classified(t).select("source_id", "region", "action", "listing_id", F.col("price").cast("double").alias("price"), F.col("old_price").cast("double").alias("old_price"))
)
query("missing_listings", "SELECT source_id, listing_id FROM {state} s WHERE status = 'active' AND NOT EXISTS (SELECT 1 FROM {sightings} i WHERE i.source_id = s.source_id)")(lambda t: reconcile.missing(t.state, t.sightings).select("source_id", "listing_id"))
KNOWN = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY status, listing_id DESC NULLS LAST) AS rn FROM {state_all} WHERE status IN ('active', 'inactive')) AS k WHERE rn = 1)"
query("classify_all_states", f"""SELECT f.source_id, CASE WHEN s.source_id IS NULL THEN 'new' WHEN s.status = 'inactive' THEN 'reappeared' WHEN s.price IS DISTINCT FROM {PRICE} THEN 'changed' ELSE 'unchanged' END AS action,
  CASE WHEN s.status = 'inactive' OR s.price IS DISTINCT FROM {PRICE} THEN s.listing_id END AS listing_id, CAST(CASE WHEN s.status = 'inactive' OR s.price IS DISTINCT FROM {PRICE} THEN s.price END AS DOUBLE) AS old_price FROM {FIRSTS} AS f LEFT JOIN {KNOWN} AS s ON f.source_id = s.source_id""")(
    lambda t: reconcile.classify(scan_rows(t).select("source_id", "price"), t.state_all).select("source_id", "action", "listing_id", F.col("old_price").cast("double").alias("old_price"))
)
query("region_action_counts", f"SELECT region, count(*) FILTER (WHERE action = 'new') AS new, count(*) FILTER (WHERE action = 'changed') AS changed, count(*) FILTER (WHERE action = 'unchanged') AS unchanged, count(*) FILTER (WHERE action = 'reappeared') AS reappeared, count(*) FILTER (WHERE action <> 'unchanged') AS output_rows FROM {CLASSIFIED} GROUP BY region")(
    lambda t: classified(t).groupBy("region").agg(*(F.count_if(F.col("action") == a).alias(a) for a in ("new", "changed", "unchanged", "reappeared")), F.count_if(F.col("action") != "unchanged").alias("output_rows"))
)


def _valid_ids(t: Tables) -> DataFrame:
    return quality.valid(t.listings).select("source_id").distinct()


VALID_IDS = f"(SELECT DISTINCT source_id FROM {{listings}} WHERE {REASON} IS NULL)"
query("pass1_actions", f"SELECT source_id, listing_id, action, CAST(old_price AS DOUBLE) AS old_price, CAST(price AS DOUBLE) AS new_price FROM {CLASSIFIED} WHERE action IN ('new', 'changed', 'reappeared') AND source_id IN (SELECT source_id FROM {VALID_IDS})")(
    lambda t: reconcile.effective(classified(t), _valid_ids(t)).withColumns({c: F.col(c).cast("double") for c in ("old_price", "new_price")})
)
query("repair_action_gaps", f"SELECT source_id, listing_id, 'refreshed' AS action, CAST(price AS DOUBLE) AS old_price, CAST(price AS DOUBLE) AS new_price FROM {{state}} s WHERE status = 'active' AND source_id IN (SELECT source_id FROM {VALID_IDS}) AND NOT EXISTS (SELECT 1 FROM {{actions}} a WHERE a.source_id = s.source_id AND a.action = 'changed')")(
    lambda t: reconcile.repair_gaps(t.state.where("status = 'active'"), _valid_ids(t), t.actions.where("action = 'changed'")).withColumns({c: F.col(c).cast("double") for c in ("old_price", "new_price")})
)
query("state_after_actions", """WITH a AS (SELECT source_id, action, new_price, listing_id AS lid FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY CASE WHEN action IN ('new', 'changed', 'reappeared', 'missing') THEN 1 ELSE 0 END DESC, seq DESC) AS rn FROM {actions} WHERE action <> 'moved') AS x WHERE rn = 1)
SELECT coalesce(s.source_id, a.source_id) AS source_id, coalesce(listing_id, lid) AS listing_id, CASE WHEN action IN ('new', 'changed', 'reappeared') THEN 'active' WHEN action = 'missing' THEN 'inactive' ELSE status END AS status,
  CAST(CASE WHEN action IN ('new', 'changed', 'reappeared') THEN new_price ELSE price END AS DOUBLE) AS price FROM {state} s FULL JOIN a ON s.source_id = a.source_id WHERE CASE WHEN action IN ('new', 'changed', 'reappeared') THEN 'active' WHEN action = 'missing' THEN 'inactive' ELSE status END IS NOT NULL""")(
    lambda t: reconcile.apply_actions(t.state, staging.effective_actions(t.actions)).withColumn("price", F.col("price").cast("double"))
)
for _status in ("active", "inactive"):
    query(f"{_status}_listings", f"SELECT source_id, listing_id, CAST(price AS DOUBLE) AS price FROM {{state}} WHERE status = '{_status}' AND transaction_type = 'sale'")(
        lambda t, s=_status: t.state.where((F.col("status") == s) & (F.col("transaction_type") == "sale")).select("source_id", "listing_id", F.col("price").cast("double").alias("price"))
    )

# -- refresh and star join ------------------------------------------------------------------------

ELIGIBLE = "(SELECT * FROM {state} s WHERE status = 'active' AND transaction_type = 'sale' AND source_id IN (SELECT source_id FROM {sightings}) AND source_id NOT IN (SELECT source_id FROM {actions} WHERE action = 'changed' AND listing_id % 10 = 0))"


def _eligible(t: Tables) -> DataFrame:
    return denorm.eligible(t.state, t.sightings, t.actions.where("action = 'changed' AND listing_id % 10 = 0"), "sale")


query("refresh_eligible", f"SELECT source_id FROM {ELIGIBLE}")(lambda t: _eligible(t).select("source_id"))
query("refresh_quota", f"SELECT CAST(ceil(count(*) * 0.05) AS BIGINT) AS quota FROM {ELIGIBLE}")(lambda t: denorm.quota(_eligible(t)))
SELECTED = f"(SELECT source_id, row_number() OVER (ORDER BY date_last_checked NULLS LAST, source_id) AS position FROM {ELIGIBLE} QUALIFY position <= (SELECT (count(*) + 19) // 20 FROM {ELIGIBLE}))"
query("refresh_selection", f"SELECT source_id, CAST(position AS INT) AS position FROM {SELECTED}")(lambda t: denorm.stalest(_eligible(t)).select("source_id", "position"))
query("refresh_batches", f"SELECT CAST((position - 1) // 3 AS BIGINT) AS batch, count(*) AS n, min(source_id) AS first_id FROM {SELECTED} GROUP BY 1")(
    lambda t: denorm.stalest(_eligible(t)).groupBy(F.floor((F.col("position") - 1) / 3).alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min("source_id").alias("first_id"))
)
query("refresh_progress_marks", f"SELECT source_id, CAST(position AS INT) AS position FROM {SELECTED} WHERE position % 100 = 0")(lambda t: denorm.stalest(_eligible(t)).where("position % 100 = 0").select("source_id", "position"))

GEO = """(SELECT a.geo_id, coalesce(CASE WHEN a.level = 'region' THEN a.name_bg END, CASE WHEN p.level = 'region' THEN p.name_bg END, CASE WHEN g.level = 'region' THEN g.name_bg END) AS region,
  coalesce(CASE WHEN a.level = 'locality' THEN a.name_bg END, CASE WHEN p.level = 'locality' THEN p.name_bg END) AS locality, coalesce(CASE WHEN a.level = 'locality' THEN a.locality_type END, CASE WHEN p.level = 'locality' THEN p.locality_type END) AS locality_type,
  CASE WHEN a.level = 'area' THEN a.name_bg END AS area FROM {geographies} a LEFT JOIN {geographies} p ON a.parent_id = p.geo_id LEFT JOIN {geographies} g ON p.parent_id = g.geo_id)"""
query("geo_hierarchy", f"SELECT * FROM {GEO}")(lambda t: denorm.geo_hierarchy(t.geographies))
FEATURES = "(SELECT property_id, string_agg(DISTINCT name_bg, ', ' ORDER BY name_bg) AS features FROM {property_features} JOIN {features} USING (feature_id) GROUP BY property_id)"
query("features_agg", f"SELECT * FROM {FEATURES}")(lambda t: denorm.features_text(t.property_features, t.features))
STAR = ("properties", "property_types", "contacts", "geographies", "construction_types", "property_features", "features")
query("denormalise_listings", f"""SELECT l.source_id, l.listing_id, h.region, h.locality, CASE h.locality_type WHEN 'city' THEN 'град' WHEN 'village' THEN 'село' ELSE h.locality_type END AS locality_type, h.area, pt.name_bg AS property_type, p.bedrooms,
  CASE contact_type WHEN 'agency' THEN 'агенция' ELSE 'собственик' END AS poster_type, CASE WHEN contact_type = 'agency' THEN c.name END AS agency_name, CASE WHEN price_on_request THEN 'Цена при запитване' ELSE CAST(price AS STRING) END AS price, CAST(area_m2 AS DOUBLE) AS area_m2,
  CASE WHEN floor IS NOT NULL AND total_floors IS NOT NULL THEN concat(CAST(floor AS STRING), ' от ', CAST(total_floors AS STRING)) ELSE CAST(floor AS STRING) END AS floor, ct.name_bg AS construction_type,
  CASE construction_status WHEN 'completed' THEN 'Въведен в експлоатация' WHEN 'under_construction' THEN 'Ще бъде въведен в експлоатация' ELSE construction_status END AS construction_status, year_built, CASE WHEN gas THEN 'ДА' WHEN NOT gas THEN 'НЕ' END AS gas,
  CASE tec WHEN 'district_heating' THEN 'ДА' WHEN 'no_district_heating' THEN 'НЕ' WHEN 'local_heating' THEN 'Лок.отопл.' WHEN 'being_installed' THEN 'Прокарва се' END AS tec, f.features, {date_sql('date_posted', 'Публикувана')} AS date_posted, {date_sql('date_modified', 'Коригирана')} AS date_modified,
  CAST(has_photos AS INT) AS has_photos, CASE WHEN contact_type = 'agency' THEN phone END AS agency_phone, listing_url, listing_tier, transaction_type, status
FROM {{stored_listings}} l JOIN {{properties}} p ON l.property_id = p.property_id JOIN {{property_types}} pt ON p.property_type_id = pt.property_type_id JOIN {{contacts}} c ON l.contact_id = c.contact_id JOIN {GEO} h ON p.geo_id = h.geo_id
LEFT JOIN {{construction_types}} ct ON p.construction_type_id = ct.construction_type_id LEFT JOIN {FEATURES} f ON p.property_id = f.property_id""")(
    lambda t: denorm.denormalise(t.stored_listings, {n: getattr(t, n) for n in STAR}).withColumns({"has_photos": F.col("has_photos").cast("int"), "area_m2": F.col("area_m2").cast("double")})
)

# -- planner --------------------------------------------------------------------------------------

CAP, LOW, HIGH = 500, *PRICE_BOUNDS["sale"]
UNIT = ["unit_region", "unit_type"]
query("plan_grid", "SELECT r_name, p_type FROM (SELECT DISTINCT r_name FROM {region}) AS r, (SELECT DISTINCT p_type FROM {part}) AS p")(lambda t: planner.grid(t.region.select("r_name"), t.part.select("p_type")))
query("plan_levels", f"""WITH k AS (SELECT unit_region, unit_type, count(*) AS n FROM {{priced}} GROUP BY ALL), r AS (SELECT unit_region, sum(n)::BIGINT AS n_region FROM k GROUP BY unit_region)
SELECT k.unit_region, k.unit_type, n, n_region, CASE WHEN n_region < {CAP} THEN 1 WHEN n < {CAP} THEN 2 ELSE 3 END AS level FROM k JOIN r ON k.unit_region = r.unit_region""")(lambda t: planner.levels(t.priced, *UNIT, CAP))
BUCKETS = f"""WITH RECURSIVE h AS (SELECT unit_region, unit_type, price, count(*) AS c FROM {{priced}} GROUP BY ALL),
nodes(unit_region, unit_type, depth, lo, hi, n) AS (
  SELECT unit_region, unit_type, 0, {LOW}::BIGINT, {HIGH}::BIGINT, sum(c)::BIGINT FROM h WHERE price BETWEEN {LOW} AND {HIGH} GROUP BY ALL
  UNION ALL
  SELECT x.unit_region, x.unit_type, x.depth, x.lo, x.hi, (SELECT coalesce(sum(c), 0)::BIGINT FROM h WHERE h.unit_region = x.unit_region AND h.unit_type = x.unit_type AND price BETWEEN x.lo AND x.hi) AS n FROM (
    SELECT unit_region, unit_type, depth + 1 AS depth, CASE WHEN s = 0 THEN lo ELSE (lo + hi) // 2 + 1 END AS lo, CASE WHEN s = 0 THEN (lo + hi) // 2 ELSE hi END AS hi FROM nodes, (SELECT unnest([0, 1]) AS s) AS s
    WHERE (depth = 0 OR n >= {CAP}) AND lo < hi AND (lo + hi) // 2 <> lo AND n > 0) AS x)
SELECT unit_region, unit_type, lo, hi, n FROM nodes WHERE depth > 0 AND n > 0 AND (n < {CAP} OR lo >= hi OR (lo + hi) // 2 = lo)
UNION ALL SELECT unit_region, unit_type, NULL, NULL, c FROM h WHERE price IS NULL"""


def _buckets(t: Tables) -> DataFrame:
    return planner.price_buckets(t.priced, UNIT, LOW, HIGH, CAP)


query("plan_price_buckets", BUCKETS)(_buckets)
PRICED = "(SELECT unit_region, unit_type, price // 20000 AS bucket, count(*) AS n FROM {priced} WHERE price IS NOT NULL GROUP BY ALL)"


def _coarse(t: Tables) -> DataFrame:
    return t.priced.where("price IS NOT NULL").groupBy(*UNIT, F.floor(F.col("price") / 20000).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


query("plan_pages", f"SELECT unit_region, unit_type, bucket, n, CAST(page AS INT) AS page FROM (SELECT *, unnest(range(1, CAST(ceil(least(n, 1000) / 40.0) AS BIGINT) + 1)) AS page FROM {PRICED}) AS x")(lambda t: planner.bucket_pages(_coarse(t)))
query("plan_resume", f"SELECT unit_region, unit_type, bucket AS lo, bucket + 1 AS hi, n FROM {PRICED} WHERE bucket + 1 >= 3")(lambda t: planner.resume(_coarse(t).select(*UNIT, F.col("bucket").alias("lo"), (F.col("bucket") + 1).alias("hi"), "n"), F.lit(3)))
query("dataset_profile", f"""SELECT transaction_type, count(*) AS n_rows, count(DISTINCT h.locality) AS localities, count(DISTINCT pt.name_bg) AS property_types, count(DISTINCT CASE WHEN contact_type = 'agency' THEN c.name END) AS agencies, count(DISTINCT listing_url) AS urls,
  round(avg(CASE WHEN contact_type = 'agency' THEN 1.0 ELSE 0.0 END), 4)::DOUBLE AS agency_share FROM {{stored_listings}} l JOIN {{properties}} p ON l.property_id = p.property_id JOIN {{property_types}} pt ON p.property_type_id = pt.property_type_id
  JOIN {{contacts}} c ON l.contact_id = c.contact_id JOIN {GEO} h ON p.geo_id = h.geo_id GROUP BY transaction_type""")(lambda t: denorm.profile(denorm.denormalise(t.stored_listings, {n: getattr(t, n) for n in STAR})))
query("page_lag", "SELECT unit, page, found, CAST(coalesce(lag(found) OVER (PARTITION BY unit ORDER BY page), 40) AS INT) AS previous FROM {page_facts}")(lambda t: t.page_facts.select("unit", "page", "found", F.lag("found", 1, 40).over(W.partitionBy("unit").orderBy("page")).alias("previous")))

"""Listing-shaped views over the driver's tables, in SQL that Spark and DuckDB both read.

``{name}`` stands for a table or another proxy. No global row numbers: arrival order is a sortable
text (``seq``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SEQ = "concat_ws('|', CAST(CAST(l_shipdate AS DATE) AS STRING), CAST(l_linenumber AS STRING), lpad(CAST(l_partkey AS STRING), 9, '0'), lpad(CAST(l_suppkey AS STRING), 9, '0'), lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 12, '0'))"
_EUROS = "CAST(floor(cents / 100.0) AS BIGINT)"
_PRICE_TEXT = (
    f"CASE WHEN cents IS NULL THEN NULL ELSE concat(CASE WHEN {_EUROS} >= 1000 THEN concat(CAST(CAST(floor({_EUROS} / 1000.0) AS BIGINT) AS STRING), ' ', lpad(CAST({_EUROS} % 1000 AS STRING), 3, '0')) "
    f"ELSE CAST({_EUROS} AS STRING) END, '.', lpad(CAST(cents % 100 AS STRING), 2, '0'), ' €') END"
)

PROXIES: dict[str, str] = {
    "state": """
SELECT CAST(o_orderkey AS STRING) AS source_id, o_orderkey + 1000000 AS listing_id,
  CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'inactive' END AS status,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(round(o_totalprice, 2) AS DECIMAL(20,4)) END AS price,
  CASE WHEN o_orderkey % 2 = 0 THEN 'sale' ELSE 'rental' END AS transaction_type,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderdate END AS date_last_checked, o_custkey AS property_id
FROM {orders} WHERE o_orderstatus IN ('O', 'F')""",
    "state_all": """
SELECT source_id, listing_id, status, price, transaction_type FROM {state}
UNION ALL SELECT CAST(o_orderkey AS STRING), o_orderkey + 1000000, 'sold', CAST(round(o_totalprice, 2) AS DECIMAL(20,4)), 'sale' FROM {orders} WHERE o_orderstatus = 'P'
UNION ALL SELECT source_id, CASE WHEN listing_id % 3 = 0 THEN NULL ELSE listing_id + CASE WHEN listing_id % 2 = 0 THEN 5000000 ELSE -900000 END END, CASE WHEN listing_id % 5 = 0 THEN 'inactive' ELSE status END, price + 1, transaction_type FROM {state} WHERE listing_id % 7 = 0""",
    "seen": "SELECT source_id, CASE WHEN source_id IS NULL OR trim(source_id) = '' THEN NULL WHEN CAST(source_id AS BIGINT) % 2 = 0 THEN 'sale' ELSE 'rental' END AS transaction_type FROM {sightings} WHERE seq NOT LIKE '%7|%'",
    "expected_regions": "SELECT tx AS transaction_type, concat('oblast-', CAST(r_regionkey * 7 + n_nationkey % 6 AS STRING)) AS region FROM {region} JOIN {nation} ON n_regionkey = r_regionkey CROSS JOIN (SELECT 'sale' AS tx UNION ALL SELECT 'rental' UNION ALL SELECT 'auction') AS t GROUP BY 1, 2",
    # sale ends complete, rental with failed units, auction is only begun
    "run_events": """
SELECT transaction_type, region, unit, kind, reason, seq FROM {unit_events} WHERE transaction_type = 'rental' OR region IN (SELECT region FROM {expected_regions})
UNION ALL SELECT DISTINCT transaction_type, region, unit, 'cleared', CAST(NULL AS STRING), 1000000000000 FROM {unit_events} WHERE transaction_type = 'sale' AND kind = 'failed'
UNION ALL SELECT 'sale', region, region, 'region_complete', CAST(NULL AS STRING), 1000000000001 FROM {expected_regions} WHERE transaction_type = 'sale'
UNION ALL SELECT 'auction', min(region), min(region), 'region_complete', CAST(NULL AS STRING), 1000000000002 FROM {expected_regions} WHERE transaction_type = 'auction'""",
    "sightings": f"""
SELECT source_id, region, scan_unit, seq, {_PRICE_TEXT} AS price_raw FROM (
  SELECT CASE WHEN l_orderkey % 97 = 0 AND l_linenumber = 1 THEN '  ' ELSE CAST(l_orderkey AS STRING) END AS source_id, n_name AS region,
    concat(n_name, ':', CAST(l_linenumber AS STRING)) AS scan_unit, {_SEQ} AS seq,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN l_discount >= 0.08 THEN CAST(round(o_totalprice * 100) AS BIGINT) + 10000 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cents
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey) AS x""",
    "listings": f"""
SELECT CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN '  ' ELSE CAST(l_orderkey AS STRING) END AS source_id,
  CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE concat('https://example.com/obiava-', CAST(l_orderkey AS STRING)) END AS listing_url,
  CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN '' ELSE p_type END AS property_type,
  CASE WHEN l_suppkey % 13 = 0 THEN ' ' ELSE n_name END AS locality,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(p_size AS DOUBLE) - 2 END AS area_m2,
  CASE WHEN l_quantity < 3 THEN 0 WHEN l_quantity < 5 THEN NULL ELSE 1950 + CAST(l_quantity AS INT) END AS year_built,
  n_name AS region, s_name AS agency_name, CAST(l_linenumber AS INT) AS page, l_returnflag AS flag, {_SEQ} AS seq
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "actions": f"""
SELECT CAST(l_orderkey AS STRING) AS source_id, l_orderkey + 1000000 AS listing_id,
  CASE WHEN l_linenumber % 7 = 0 THEN 'moved' WHEN l_linenumber % 2 = 0 THEN 'refreshed' WHEN l_linenumber = 1 THEN 'changed' WHEN l_linenumber = 3 THEN 'new' ELSE 'reappeared' END AS action,
  CAST(round(l_extendedprice, 2) AS DECIMAL(20,4)) AS new_price, {_SEQ} AS seq
FROM {{lineitem}}""",
    "geographies": """
SELECT r_regionkey AS geo_id, CAST(NULL AS INT) AS parent_id, 'region' AS level, r_name AS name_bg, CAST(NULL AS STRING) AS locality_type FROM {region}
UNION ALL SELECT 100 + n_nationkey, n_regionkey, 'locality', n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'city' ELSE 'village' END FROM {nation}
UNION ALL SELECT DISTINCT 1000 + 5 * c_nationkey + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END,
  100 + c_nationkey, 'area', concat(c_mktsegment, ' ', CAST(c_nationkey AS STRING)), CAST(NULL AS STRING) FROM {customer}""",
    "properties": """
SELECT c_custkey AS property_id, c_custkey % 20 AS property_type_id,
  CASE WHEN c_custkey % 3 = 0 THEN 100 + c_nationkey WHEN c_custkey % 50 = 1 THEN c_nationkey % 5
    ELSE 1000 + 5 * c_nationkey + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END END AS geo_id,
  CAST(c_custkey % 5 AS INT) AS bedrooms, CAST(c_custkey % 90 + 20 AS DECIMAL(10,2)) AS area_m2, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 12 END AS floor,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 12 END AS total_floors, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 6 END AS construction_type_id,
  CASE c_custkey % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'under_construction' WHEN 2 THEN 'odd' ELSE NULL END AS construction_status,
  CAST(1950 + c_custkey % 70 AS INT) AS year_built, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN TRUE ELSE FALSE END AS gas,
  CASE c_custkey % 5 WHEN 0 THEN 'district_heating' WHEN 1 THEN 'no_district_heating' WHEN 2 THEN 'local_heating' WHEN 3 THEN 'being_installed' ELSE NULL END AS tec
FROM {customer}""",
    "property_types": "SELECT CAST(x AS BIGINT) AS property_type_id, concat('вид ', CAST(x AS STRING)) AS name_bg FROM (SELECT DISTINCT c_custkey % 20 AS x FROM {customer}) AS t",
    "construction_types": "SELECT CAST(x AS BIGINT) AS construction_type_id, concat('строеж ', CAST(x AS STRING)) AS name_bg FROM (SELECT DISTINCT c_custkey % 6 AS x FROM {customer}) AS t",
    "contacts": """SELECT s_suppkey AS contact_id, CASE s_suppkey % 3 WHEN 0 THEN 'owner' ELSE 'agency' END AS contact_type, s_name AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('08', CAST(s_suppkey AS STRING)) END AS phone FROM {supplier}""",
    "property_features": "SELECT DISTINCT o_custkey AS property_id, l_partkey % 40 AS feature_id FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey WHERE l_linenumber <= 2 AND o_orderkey % 3 = 0",
    "features": "SELECT DISTINCT l_partkey % 40 AS feature_id, concat('екстра ', CAST(l_partkey % 40 AS STRING)) AS name_bg FROM {lineitem}",
    "stored_listings": """
SELECT source_id, listing_id, concat('https://example.com/obiava-', source_id) AS listing_url, CASE WHEN listing_id % 3 = 0 THEN 'VIP' ELSE NULL END AS listing_tier,
  price, listing_id % 11 = 0 AS price_on_request, date_last_checked AS date_posted, CASE WHEN listing_id % 2 = 0 THEN date_last_checked END AS date_modified,
  listing_id % 2 = 1 AS has_photos, date_last_checked, status, transaction_type, property_id, (SELECT min(s_suppkey) FROM {supplier}) + listing_id % (SELECT count(*) FROM {supplier}) AS contact_id
FROM {state}""",
    "info_text": """
SELECT l_orderkey, l_linenumber, l_partkey, concat(
  CASE WHEN l_partkey % 5 = 0 THEN '1 ' ELSE '' END, CAST(p_size AS STRING), CASE WHEN l_partkey % 3 = 0 THEN '.5' ELSE '' END, ' кв.м, ',
  CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE concat(CAST(l_linenumber AS STRING), CASE WHEN l_linenumber = 2 THEN '-ри' ELSE '-ти' END, ' ет. от ', CAST(l_partkey % 20 AS STRING), ', ') END,
  CASE l_partkey % 7 WHEN 0 THEN 'Тухла, ' WHEN 1 THEN 'ПАНЕЛ, ' WHEN 2 THEN 'ЕПК, ' WHEN 3 THEN 'Сглобяема конструкция, ' WHEN 4 THEN 'Гредоред, ' ELSE '' END,
  CASE WHEN l_partkey % 4 = 0 THEN '' ELSE concat(CAST(1950 + p_size AS STRING), ' г., ') END,
  CASE WHEN l_partkey % 6 = 0 THEN 'без телефон' ELSE concat('тел.: 08', CAST(l_partkey AS STRING), ' ', CAST(l_suppkey AS STRING)) END) AS info
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "titles": """
SELECT c_custkey, concat(CASE c_custkey % 3 WHEN 0 THEN 'Продава ' WHEN 1 THEN 'Дава под наем ' ELSE '' END, CASE WHEN c_custkey % 10 = 0 THEN '' ELSE concat(CAST(c_custkey % 4 AS STRING), '-СТАЕН') END) AS title,
  CASE c_custkey % 8 WHEN 0 THEN 'град София, Лозенец' WHEN 1 THEN 'гр. Банско' WHEN 2 THEN 'гр. Пловдив, с. Марково' WHEN 3 THEN 'с. Марково, област Пловдив'
    WHEN 4 THEN 'к.к. Слънчев бряг' WHEN 5 THEN 'Слънчев бряг, ' WHEN 6 THEN 'село Бистрица, Област София' ELSE 'Варна' END AS place FROM {customer}""",
    "run_log": """
SELECT event_id, user_id, ts, concat(CAST(date_trunc('second', ts) AS STRING), CASE WHEN event_type = 'error' THEN ' [ERROR] ' ELSE ' [INFO] ' END, 'main — ',
  CASE event_type WHEN 'signup' THEN concat('===== REGION: Област ', CAST(user_id % 27 AS STRING), ' (oblast-', CAST(user_id % 27 AS STRING), ') | unit =====')
    WHEN 'view' THEN concat('Saved ', CAST(CAST(floor(value) AS INT) % 41 AS STRING), ' valid listings from page ', CAST(user_id % 9 + 1 AS STRING))
    WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN concat('Pre-flight result for oblast-', CAST(user_id % 27 AS STRING), '/tip-', CAST(event_id % 5 AS STRING), CASE WHEN event_id % 2 = 0 THEN ': CAPPED' ELSE ': under cap' END)
      WHEN 1 THEN concat('--- Scraping: oblast-', CAST(user_id % 27 AS STRING), '/tip-', CAST(event_id % 5 AS STRING), ' [', CAST(user_id AS STRING), '-', CAST(user_id + 100 AS STRING), '] | prodazhbi')
      ELSE concat('SCRAPE_UNIT_SUMMARY label=oblast-', CAST(user_id % 27 AS STRING), ' pages=', CAST(event_id % 20 AS STRING), ' saved=', CAST(user_id AS STRING)) END
    WHEN 'error' THEN CASE event_id % 4 WHEN 0 THEN 'Connection error: timed out' WHEN 1 THEN concat('All 2 attempts failed for URL: https://x.bg/obiavi/prodazhbi/oblast-', CAST(user_id % 27 AS STRING), '/p-3?price_min=1&price_max=9')
      WHEN 2 THEN 'Soft-block suspected' ELSE concat('Pre-flight fetch failed for oblast-', CAST(user_id % 27 AS STRING), ' — retry') END
    ELSE concat('Transaction type: ', CASE WHEN event_id % 2 = 0 THEN 'prodazhbi' ELSE 'naemi' END) END) AS line
FROM {events}""",
    "light_log": """
SELECT event_id, user_id, ts, concat(CAST(date_trunc('second', ts) AS STRING), CASE WHEN event_type = 'error' THEN ' [WARNING] ' ELSE ' [INFO] ' END, 'light_scraper.main — ',
  CASE event_type WHEN 'signup' THEN concat('Pass 1 — scraping index pages: oblast-', CAST(user_id % 27 AS STRING), ' | prodazhbi')
    WHEN 'view' THEN concat('Pass 1 — oblast-', CAST(user_id % 27 AS STRING), ': saved ', CAST(event_id % 50 AS STRING), ' listings (', CAST(event_id % 7 AS STRING), ' new | ', CAST(event_id % 5 AS STRING), ' changed | ', CAST(event_id % 3 AS STRING), ' reappeared | ', CAST(event_id % 90 AS STRING), ' unchanged)')
    WHEN 'click' THEN CASE event_id % 5 WHEN 0 THEN concat('Fetched 1,', lpad(CAST(event_id % 1000 AS STRING), 3, '0'), ' active listings from DB') WHEN 1 THEN 'Pass 2 — rolling detail refresh' WHEN 2 THEN concat('Pass 2 — complete.  ', CAST(user_id AS STRING), ' listings refreshed')
      WHEN 3 THEN concat('Pass 1 — ', CAST(user_id AS STRING), ' listings no longer visible (will be marked)') ELSE concat('Pass 1 — oblast-', CAST(user_id % 27 AS STRING), ': 0 listings to save (', CAST(user_id AS STRING), ' unchanged)') END
    WHEN 'error' THEN 'Connection error: reset' ELSE 'Light scraper run started' END) AS line
FROM {events}""",
    "fetch_log": """
SELECT user_id, event_id, concat('https://www.imot.bg/', CASE WHEN user_id % 2 = 0 THEN 'obiava-' ELSE 'obiavi/prodazhbi/' END, CAST(user_id AS STRING)) AS url,
  CASE WHEN user_id % 2 = 0 THEN 'detail' ELSE 'listings' END AS page_type,
  CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'timeout' WHEN event_type = 'error' AND event_id % 3 = 1 THEN 'request' END AS failure,
  CASE event_type WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN 403 WHEN 1 THEN 404 ELSE 503 END ELSE 200 END AS status,
  concat('https://www.imot.bg/', CASE WHEN event_type = 'signup' OR user_id % 2 = 1 THEN 'obiavi/prodazhbi/' ELSE 'obiava-' END, CAST(user_id AS STRING)) AS final_url,
  CAST(floor(value * 1000) AS BIGINT) AS chars, event_id % 7 <> 0 AS content_ok, event_id % 4 = 0 AS after_partial, ts
FROM {events}""",
    "unit_events": """
SELECT concat('oblast-', CAST(user_id % 30 AS STRING), CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN ':p' ELSE concat('/tip-', CAST(user_id % 3 AS STRING)) END) AS unit,
  concat('oblast-', CAST(user_id % 30 AS STRING)) AS region, CASE WHEN user_id % 2 = 0 THEN 'sale' ELSE 'rental' END AS transaction_type,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'region_complete' ELSE 'cleared' END AS kind,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'fetch_failed' ELSE 'max_pages_reached' END END AS reason, event_id AS seq
FROM {events} WHERE event_type IN ('error', 'purchase', 'view')""",
    "page_facts": """
SELECT n_name AS unit, CAST(l_shipdate AS DATE) AS day, CAST(row_number() OVER (PARTITION BY n_name ORDER BY CAST(l_shipdate AS DATE)) AS INT) AS page, CAST(least(count(*), 40) AS INT) AS found,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS rejected, CAST(sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS INT) AS detail_failed
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey GROUP BY n_name, CAST(l_shipdate AS DATE)""",
    "portal_pages": """
SELECT c_custkey AS page_id, concat('https://www.imot.bg/obiavi/prodazhbi/p-', CAST(c_custkey AS STRING)) AS url,
  CASE c_custkey % 9 WHEN 0 THEN 'detail' WHEN 1 THEN NULL ELSE 'listings' END AS page_type,
  concat('<html><body>', CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('<div class="SearchInfoLine">Обяви от общо ', CASE WHEN c_custkey % 5 = 0 THEN '1000+' ELSE '37' END, '</div>') END,
  '<p>1000+ други</p>', CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat('<div id="ida', CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(c_custkey AS STRING) END, '" class="item', CASE WHEN c_custkey % 4 = 0 THEN ' TOP' ELSE '' END,
  '"><a class="title" href="', CASE WHEN c_custkey % 2 = 0 THEN '//www.imot.bg/obiava-' ELSE 'https://www.imot.bg/obiava-' END, CAST(c_custkey AS STRING), '">', title, '<location>', place, '</location></a>',
  '<div class="price">', CAST(c_custkey AS STRING), ' 990 €<br>2 000 €/кв.м</div><div class="info">', CAST(c_custkey % 90 + 20 AS STRING), ' кв.м, 2-ри ет. от 6, тел.: 08', CAST(c_custkey AS STRING), ' 55</div>',
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('<div class="seller"><div class="name"><a href="#">Имоти &amp; Ко ', CAST(c_custkey AS STRING), '</a></div></div>') END,
  '<a class="photos">', CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '<strong>5</strong>' END, '</a></div>') END, '</body></html>') AS html
FROM {customer} JOIN (SELECT c_custkey AS k, title, place FROM {titles}) AS t ON c_custkey = k""",
    "portal_details": """
SELECT c_custkey AS page_id, concat('https://www.imot.bg/obiava-', CAST(c_custkey AS STRING)) AS url,
  concat('<div class="adPrice"><div class="info"><div>', CASE c_custkey % 3 WHEN 0 THEN 'Публикувана в 10:00' WHEN 1 THEN 'Коригирана в 11:30' ELSE 'Друго' END, '</div></div></div><div class="adParams"><div>Площ:<strong>1</strong></div>',
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '<div>Газ:<strong>ДА</strong></div>' END, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '<div>ТEЦ:<strong>НЕ</strong></div>' END,
  CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('<div>Строителство:<strong>Тухла, </strong>Въведен в експлоатация<strong>', CAST(1950 + c_custkey % 70 AS STRING), ' г.</strong></div>') END,
  '</div></div><div class="carExtri"><div class="items"><div>Тухла</div>', CASE WHEN c_custkey % 2 = 0 THEN '<div>Асансьор</div>' ELSE '' END, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '<div>Обзаведен &amp; готов</div>' END, '<div> </div></div></div>') AS html
FROM {customer} WHERE c_custkey % 10 <> 0""",
    "nested_pages": """
SELECT c_custkey AS page_id, concat('https://www.imot.bg/obiavi/prodazhbi/n-', CAST(c_custkey AS STRING)) AS url, concat('<html><body><script>var x = "<div id=ida0>";</script><div data-x=1 class=''item BEST '' id="ida', CAST(c_custkey AS STRING), '">',
  '<!-- <div id="ida1"> --><A CLASS="big title" href=''//www.imot.bg/obiava-', CAST(c_custkey AS STRING), '?a=1&amp;b=2''><b>Продава</b> ', CAST(c_custkey % 5 AS STRING), '-СТАЕН<location> с. Марково, <i>Център</i> &amp; ', c_mktsegment, ' </location></A>',
  '<div class="price"><div>&nbsp;', CAST(c_custkey % 900 AS STRING), '&nbsp;990 &euro;<br>2 000 лв.</div></div><div class="info"><div>', CAST(c_custkey % 9 AS STRING), '<br>', CAST(c_custkey % 90 + 20 AS STRING), ' кв.м<div>x</div><!-- 99 кв.м -->2-ри ет. от 6</div><div>тел.: 08', CAST(c_custkey AS STRING), ' 55</div></div>',
  CASE c_custkey % 3 WHEN 0 THEN '<div class="seller"><div class="logo"><a href="#">лого</a></div></div>' WHEN 1 THEN '<div class="seller"><div class="name"><div><a href="#"> </a></div></div></div>' ELSE concat('<div class=seller><div class=logo><div></div></div><div class=name><div><a href="#">Имоти &#38;amp; <b>', c_name, '</b></a></div></div></div>') END,
  '<a class="photos"><div>', CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '<strong>5</strong>' END, '</div></a></div><div class="price">1 €</div><div class="seller"><div class="name"><a>друг</a></div></div></body></html>') AS html
FROM {customer}""",
    "nested_details": """
SELECT c_custkey AS page_id, concat('https://www.imot.bg/obiava-', CAST(c_custkey AS STRING)) AS url, concat('<body><div class="info"><div>Публикувана никъде</div></div><div class="adPrice"><div><div class="info"><div><span>Обява: ', CASE c_custkey % 3 WHEN 0 THEN 'Публикувана' WHEN 1 THEN 'Коригирана' ELSE 'Друго' END,
  '</span> в 10:00<div>днес</div></div><div>втори</div></div></div></div><div class="adParams"><div><div>Газ:<div><strong>НЕ</strong></div></div><div>Газ:<div><div><strong>', CASE WHEN c_custkey % 4 = 0 THEN 'ДА' ELSE c_mktsegment END, '</strong></div></div></div><div>Газ:</div></div>',
  '<div>Строителство:<div></div><strong>', CASE c_custkey % 2 WHEN 0 THEN 'Тухла, ' ELSE '<i>Пан</i>ел' END, '</strong> Въведен, ', CAST(c_nationkey AS STRING), ' &lt;b&gt; <strong>', CAST(1950 + c_custkey % 70 AS STRING), ' г.</strong></div></div><div class="carExtri"><div><div class="items"><div>Асан<b>сьор</b></div><div><div>', c_mktsegment,
  '</div><div>и двор</div></div><div>ПАНЕЛ</div><div> </div></div></div></div><div class="items"><div>чужд</div></div></body>') AS html
FROM {customer}""",
    "priced": """
SELECT r_name AS unit_region, p_type AS unit_type, CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS price
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
}


def sources(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", PROXIES[name])))


#: Pages are much work made of small rows: their table's file is too small to be cut into as many tasks as the pages need.
SPREAD = ("portal_pages", "portal_details", "nested_pages", "nested_details")


def proxy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or a proxy as a DataFrame; only Parquet scans and Catalyst expressions."""
    if name not in PROXIES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables = {t: proxy(spark, sf_dir, t) for t in sources(name)}
    if name in SPREAD:  # every side, since a join may broadcast any; with a number, which adaptive execution leaves as it is
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables = {t: rows.repartition(parts) for t, rows in tables.items()}
    return spark.sql(PROXIES[name], **tables)


def with_proxies(sql: str) -> str:
    """A query over ``{name}`` as one statement with a WITH list, for another SQL engine."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in PROXIES and name not in order:
            for s in sources(name):
                add(s)
            order.append(name)

    for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)):
        add(n)
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    views = ",\n".join(f"{n} AS ({plain(PROXIES[n])})" for n in order)
    body = plain(sql).strip()
    if not views:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE') :]}"
    return f"WITH {views},\n{body[4:]}" if body.upper().startswith("WITH") else f"WITH {views}\n{body}"

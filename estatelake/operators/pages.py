"""Raw portal pages to typed rows, with JVM expressions only.

Each card or block is cut out first, with all that is nested in it, so that a pattern cannot read beyond it. A pattern that does not
match gives null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions import text as fx
from estatelake.operators import markup as mk
from estatelake.schema import CONSTRUCTIONS, DETAIL_COLUMNS, LISTING, TRANSACTIONS, code_map


def https(url: Column) -> Column:
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(url)


def _columns(rows: DataFrame, **expressions: str) -> DataFrame:
    """rows with further columns. Later steps refer to them by name, so that nothing is cut out twice."""
    return rows.withColumns({name: F.expr(e) for name, e in expressions.items()})


def cards(pages: DataFrame) -> DataFrame:
    """url, place, card: a row for each ``div`` whose id starts with ``ida``, up to its own end tag; pages without cards give none. A card holds no other one."""
    start = mk.id_tag("div", "ida")
    pieces = f"filter(split({mk.tidy('html')}, {mk.literal(f'(?i)(?={start})')}), p -> {mk.has('p', f'^{start}')})"
    found = pages.select("url", F.posexplode(F.expr(pieces)).alias("place", "_piece"))
    return found.select("url", "place", F.expr(f"concat(substring_index(_piece, '>', 1), '>', {mk.inside('_piece', 'div')})").alias("card"))


def card_columns(cards_: DataFrame) -> DataFrame:
    """Typed columns of each card, in steps: its blocks, their texts, and the fields that are read from them."""
    blocks = _columns(
        cards_, _head="concat(substring_index(card, '>', 1), '>')", _link=mk.start_tag("card", "a", "title"), _title=mk.element("card", "a", "title"), _price=mk.element("card", "div", "price"), _info=mk.element("card", "div", "info"),
        _agency=mk.element(mk.element(mk.element("card", "div", "seller"), "div", "name"), "a"), _photos=mk.element("card", "a", "photos"),
    )
    without_place = f"regexp_replace(_title, {mk.literal(r'(?is)<location\b[^>]*>.*?(?:</location\s*>|\z)')}, '<!>')"
    written = _columns(
        blocks, _place=mk.text(mk.element("_title", "location")), _name=mk.text(without_place), _first=mk.plain(f"get({mk.texts('_price')}, 0)"), _said=mk.text("_info", " "), _by=mk.text("_agency"),
        _id=mk.attribute("_head", "id"), _classes=f"split({mk.strip(mk.attribute('_head', 'class'))}, {mk.literal(r'\s+')})", _href=mk.attribute("_link", "href"),
    )
    placed = written.withColumns(dict(zip(("_locality", "_area"), fx.split_location(F.col("_place")), strict=True)))
    kind, place = fx.split_locality(F.col("_locality"))
    with_place, by_agency = F.col("_place").isNotNull(), F.col("_agency").isNotNull()
    return placed.select(
        "url", "place",
        F.nullif(F.regexp_replace("_id", "^ida", ""), F.lit("")).alias("source_id"),
        fx.blank_to_null(F.get("_classes", F.lit(1))).alias("listing_tier"),
        https(F.col("_href")).alias("listing_url"),
        # a title of nothing but the verb has no type
        F.when(with_place, fx.property_type(F.concat("_name", F.lit(" ")))).alias("property_type"),
        F.when(with_place, kind).alias("locality_type"), F.when(with_place, place).alias("locality"), F.when(with_place, F.col("_area")).alias("area"),
        fx.blank_to_null(F.split("_first", "\n")[0]).alias("price_raw"),
        fx.area_m2(F.col("_said")).alias("area_m2"), fx.floor_text(F.col("_said")).alias("floor"),
        F.when(by_agency, "агенция").otherwise("собственик").alias("poster_type"), F.nullif("_by", F.lit("")).alias("agency_name"), F.when(by_agency, fx.phone(F.col("_said"))).alias("agency_phone"),
        F.coalesce(F.expr(mk.has("_photos", r"<strong\b")), F.lit(False)).alias("has_photos"),
        F.lit("active").alias("status"),
    )


def listing_rows(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Card rows with all listing columns in their order: region by the page's url from a dimension (url, region), transaction from the
    url, the card's price text, and null where only a detail page or a later step knows more."""
    code = F.regexp_extract("url", r"/obiavi/([^/?]+)", 1)
    there = rows.join(regions.select(F.col("url").alias("_url"), F.col("region").alias("_region")), F.col("url") == F.col("_url"), "left")
    known = {"region": F.col("_region"), "transaction_type": F.when(code != "", code_map(TRANSACTIONS, code)), "price": F.col("price_raw")}
    value = lambda f: known.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None))
    return there.select(*(value(f).cast(f.dataType).alias(f.name) for f in LISTING))


def reject_cards(rows: DataFrame) -> DataFrame:
    """Cards that could not be read: no id or no link."""
    return rows.where("source_id IS NULL OR listing_url IS NULL")


def capped(html: str = "html") -> Column:
    """Whether the text of the search summary, and nothing else, says ``1000+``."""
    return F.coalesce(F.expr(mk.text(mk.element(mk.tidy(html), "div", "SearchInfoLine"))).contains("1000+"), F.lit(False))


def content_valid(page_type: str = "page_type", html: str = "html") -> Column:
    kind, holds = F.col(page_type), lambda pattern: F.expr(mk.has(html, pattern))
    listings = holds(mk.id_tag("div", "ida")) | holds(mk.open_tag("div", "SearchInfoLine"))
    return F.when(kind == "listings", listings).when(kind == "detail", holds(mk.open_tag("div", "adPrice"))).otherwise(True)


def _labelled(params: str) -> str:
    """(label, block) of each ``div``, at any depth, that begins with a text: that text, and all of the div's content."""
    label = mk.strip(mk.plain(f"regexp_extract(p, {mk.literal(r'(?i)\A<div[^>]*>([^<]*)')}, 1)"))
    block = mk.inside("array_join(slice(parts, i + 1, size(parts)), '')", "div")
    found = f"filter(transform(parts, (p, i) -> struct({label} AS label, i AS i)), x -> x.label <> '')"
    blocks = f"transform({found}, x -> struct(x.label AS label, {mk.let('i', 'x.i', block)} AS block))"
    return mk.let("parts", f"split({params}, {mk.literal(r'(?i)(?=<div(?![\w-]))')})", blocks)


def detail_columns(pages: DataFrame) -> DataFrame:
    """url and the eight detail columns of each detail page, in steps like those of a card."""
    blocks = _columns(
        pages.select("url", F.expr(mk.tidy("html")).alias("_html")),
        _date=f"get({mk.children(mk.element(mk.element('_html', 'div', 'adPrice'), 'div', 'info'), 'div')}, 0)",
        _params=_labelled(mk.element("_html", "div", "adParams")),
        _items=mk.children(mk.element(mk.element("_html", "div", "carExtri"), "div", "items"), "div"),
    )
    # the last block of a label that holds a value
    last = lambda name: f"try_element_at(filter(_params, x -> x.label = {mk.literal(name)} AND {mk.has('x.block', r'<strong\b')}), -1).block"
    values = _columns(blocks, _when=mk.text("_date"), _gas_block=last("Газ:"), _tec_block=last("ТEЦ:"), _built=last("Строителство:"), _names=f"transform(_items, item -> {mk.text('item')})")
    status = f"regexp_extract(_built, {mk.literal(r'(?is)<strong\b.*?</strong\s*>([^<]*)')}, 1)"
    strongs = _columns(values, _kind=mk.text(mk.element("_built", "strong")), _status=mk.strip(mk.plain(status)), _year=mk.text(f"get({mk.children('_built', 'strong')}, 1)"), _gas=mk.text(mk.element("_gas_block", "strong")), _tec=mk.text(mk.element("_tec_block", "strong")))
    date = F.col("_when")
    features = F.array_join(F.filter("_names", lambda x: (x != "") & ~F.lower(x).isin(*CONSTRUCTIONS)), ", ")
    columns = {
        "date_posted": F.when(date.contains("Публикувана"), date),
        "date_modified": F.when(~date.contains("Публикувана") & date.contains("Коригирана"), date),
        "gas": F.nullif("_gas", F.lit("")),
        "tec": F.nullif("_tec", F.lit("")),
        "construction_type": F.nullif(F.rtrim("_kind", F.lit(", ")), F.lit("")),
        "construction_status": F.nullif("_status", F.lit("")),
        "year_built": fx.year_built(F.col("_year")),
        "features": F.nullif(features, F.lit("")),
    }
    return strongs.select("url", *(columns[c].alias(c) for c in DETAIL_COLUMNS))


def enrich(listings: DataFrame, details: DataFrame) -> DataFrame:
    """The detail columns replace those of the listing, also by null, where a detail page was read."""
    d = details.select(F.col("url").alias("_url"), *(F.col(c).alias(f"_{c}") for c in DETAIL_COLUMNS))
    joined = listings.join(d, F.col("listing_url") == F.col("_url"), "left").withColumn("detail_ok", F.col("_url").isNotNull())
    for c in DETAIL_COLUMNS:
        own = F.col(c) if c in listings.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("detail_ok"), F.col(f"_{c}")).otherwise(own))
    return joined.drop("_url", *(f"_{c}" for c in DETAIL_COLUMNS))

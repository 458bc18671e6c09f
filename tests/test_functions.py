"""Column functions on the cases that are easy to get wrong."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from estatelake.functions import text as fx
from estatelake.operators import pages, quality
from estatelake.schema import LISTING_COLUMNS


def value(spark, column, text="x"):
    return spark.createDataFrame([(text,)], "x string").select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (fx.area_m2, "123.5 кв.м, ЕПК", 123.5), (fx.area_m2, "1 200 кв.м", 200.0), (fx.area_m2, "няма", None), (fx.floor_text, "4-ти ет. от 11", "4 от 11"),
        (fx.year_built, "2020 г.", 2020), (fx.construction, "нова епк, 2020", "Епк"), (fx.construction, "Сглобяема конструкция", "Сглобяема конструкция"),
        (fx.phone, "тел.: 0883 668 466", "0883668466"), (fx.phone, "тел.: ", None), (fx.parse_price, "44 993.69 €", Decimal("44993.6900")), (fx.parse_price, "89 990 €", Decimal("89990.0000")),
        (fx.parse_price, "Цена при запитване", None), (fx.parse_price, None, None), (fx.property_type, "Продава 2-СТАЕН", "2-СТАЕН"), (fx.property_type, "Дава под наем ", None),
        (fx.base_type, "tip-1 [0-25]", "tip-1"),
        (fx.area_m2, "кв.м 1.2.3 кв.м", 2.3), (fx.area_m2, "a.5 кв.м", 5.0), (fx.floor_text, "ет. от 3, 12-ти ет.  от 4", "12 от 4"), (fx.floor_text, "2-ри ет. без", None), (fx.year_built, "20201 г., 1999 г.", 201), (fx.phone, "тел.:x тел.: 08 9", "089"),
        (fx.error_label, "All 3 attempts failed for URL: https://a/obiavi/prodazhbi/oblast-y/tip-2?price_max=9", "Soft-block — oblast-y/tip-2"), (fx.error_label, "All 3 attempts failed for URL: http://a/x y", "Soft-block — http://a/x"),
        (fx.error_label, "x [WARNING] y — Fetch returned None on page 3", None), (fx.error_label, "Bucket 1 splitting", None), (fx.error_label, "Connection error: z", "Connection error"),
        (fx.error_label, "All 2 attempts failed for URL: https://a/obiavi/naemi/grad-x/p-2?price_min=0&price_max=25", "Soft-block — grad-x [0–25]"), (fx.error_label, "Pre-flight fetch failed for grad-x — z", "Pre-flight failed — grad-x"),
    ],
)
def test_text_functions(spark, f, text, want):
    assert value(spark, f(F.col("x")), text) == want


@pytest.mark.parametrize(("seconds", "want"), [(42, "42s"), (125, "2m 5s"), (3723, "1h 2m 3s")])
def test_duration(spark, seconds, want):
    assert value(spark, fx.duration_text(F.lit(seconds))) == want


@pytest.mark.parametrize(("a", "b", "differ"), [(None, None, False), (None, "1", True), ("44993.69", "44993.6900", False), ("1", "2", True)])
def test_prices_differ(spark, a, b, differ):
    d = lambda x: F.lit(x).cast("decimal(20,4)")
    assert value(spark, fx.prices_differ(d(a), d(b))) is differ


@pytest.mark.parametrize(
    ("place", "want"),
    [("гр. Пловдив, с. Марково", ("село", "Марково", None)), ("Слънчев бряг", ("Слънчев", "бряг", None)), ("град София, Лозенец", ("град", "София", "Лозенец")), ("с. Х, ОБЛАСТ Y", ("село", "Х", None)), (None, (None, None, None))],
)
def test_location(spark, place, want):
    locality, area = fx.split_location(F.col("x"))
    kind, name = fx.split_locality(locality)
    assert value(spark, F.struct(kind, name, area), place) == want


@pytest.mark.parametrize(("key", "want"), [("a:b:0-25", (0, 25)), ("a:b:100-9", (100, 9)), ("a:b", (None, None)), (None, (None, None))])
def test_range_key(spark, key, want):
    assert value(spark, F.struct(*fx.range_key(F.col("x"))), key) == want


def test_listing_columns():
    assert len(LISTING_COLUMNS) == 27
    assert LISTING_COLUMNS[0] == "region"
    assert LISTING_COLUMNS[-1] == "status"


@pytest.mark.parametrize("field", quality.REQUIRED)
@pytest.mark.parametrize("blank", [None, "", "  "])
def test_required_fields(spark, field, blank):
    row = {"source_id": "1", "listing_url": "u", "property_type": "t", "locality": "l", "area_m2": None, "year_built": None} | {field: blank}
    df = spark.createDataFrame([row], "source_id string, listing_url string, property_type string, locality string, area_m2 double, year_built int")
    assert df.select(quality.reject_reason()).first()[0] == field


PAGE = """<div class="SearchInfoLine">общо 37</div><span>1000+</span>
<div id="ida1a" class="item TOP"><a href="//www.x.bg/obiava-1" class="title">Продава 2-СТАЕН<location>гр. Пловдив, с. Марково</location></a>
<div class="price">89 990 €<br>1 000 €/кв.м</div><div class="info">65 кв.м, 2-ри ет. от 6, тел.: 08 83</div><a class="photos"></a></div>
<div id="ida2"><p>broken</p></div>"""


def test_cards_with_decoys(spark):
    df = spark.createDataFrame([("u", PAGE), ("v", None), ("w", "<p>none</p>")], "url string, html string")
    a, b = pages.card_columns(pages.cards(df)).orderBy("place").collect()
    assert (a.source_id, a.listing_tier, a.listing_url, a.property_type) == ("1a", "TOP", "https://www.x.bg/obiava-1", "2-СТАЕН")
    assert (a.locality_type, a.locality, a.area, a.price_raw, a.area_m2, a.floor) == ("село", "Марково", None, "89 990 €", 65.0, "2 от 6")
    assert (a.poster_type, a.agency_phone, a.has_photos) == ("собственик", None, False)
    assert (b.source_id, b.listing_url) == ("2", None)
    assert pages.reject_cards(pages.card_columns(pages.cards(df))).count() == 1
    assert df.where("url = 'u'").select(pages.capped("html")).first()[0] is False

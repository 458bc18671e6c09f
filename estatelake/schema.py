"""Fixed columns, types and code maps of listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column order of a published listing file, and each column's type.
LISTING = T.StructType(
    [
        T.StructField(name, kind())
        for name, kind in (
            ("region", T.StringType), ("locality", T.StringType), ("locality_type", T.StringType), ("area", T.StringType), ("property_type", T.StringType),
            ("bedrooms", T.IntegerType), ("poster_type", T.StringType), ("agency_name", T.StringType), ("price", T.StringType), ("area_m2", T.DoubleType),
            ("floor", T.StringType), ("construction_type", T.StringType), ("construction_status", T.StringType), ("year_built", T.IntegerType), ("gas", T.StringType),
            ("tec", T.StringType), ("features", T.StringType), ("date_posted", T.StringType), ("date_modified", T.StringType), ("has_photos", T.BooleanType),
            ("agency_phone", T.StringType), ("listing_url", T.StringType), ("source_id", T.StringType), ("listing_tier", T.StringType), ("transaction_type", T.StringType),
            ("scraped_at", T.StringType), ("status", T.StringType),
        )
    ]
)
LISTING_COLUMNS = LISTING.fieldNames()
DETAIL_COLUMNS = ["date_posted", "date_modified", "gas", "tec", "construction_type", "construction_status", "year_built", "features"]

# Actions, and those that a refresh does not override.
ACTIONS = ("new", "changed", "unchanged", "reappeared", "missing", "refreshed")
PRIMARY_ACTIONS = ("new", "changed", "reappeared", "missing")

# Codes and their labels.
TRANSACTIONS = {"prodazhbi": "sale", "naemi": "rental"}
LOCALITY_TYPES = {
    "city": "град", "village": "село", "resort_complex": "к.к.", "campground": "к-г", "area": "м-т", "highway": "магистрала",
    "reservoir": "яз.", "main_road": "главен", "mountain_hut": "хижа", "railway_station": "Гара", "villa_zone": "вилна зона",
}
CONSTRUCTION_STATUSES = {"completed": "Въведен в експлоатация", "under_construction": "Ще бъде въведен в експлоатация", "not_completed": "Не е въведен в експлоатация"}
HEATING = {"district_heating": "ДА", "no_district_heating": "НЕ", "local_heating": "Лок.отопл.", "being_installed": "Прокарва се"}
POSTERS = {"agency": "агенция", "owner": "собственик"}
MONTHS = ("януари", "февруари", "март", "април", "май", "юни", "юли", "август", "септември", "октомври", "ноември", "декември")
#: In order of precedence; the first that a text contains wins.
CONSTRUCTIONS = ("сглобяема конструкция", "епк", "пк", "гредоред", "панел", "тухла")
PRICE_ON_REQUEST = "Цена при запитване"

BASE_URL = "https://www.imot.bg/obiavi/"
#: Lower and upper bound of prices by transaction, page size, and results that one query can show.
PRICE_BOUNDS = {"sale": (0, 10_000_000), "rental": (0, 10_000)}
PAGE_SIZE, RESULT_CAP, LEAST_PAGE_CHARS, REFRESH_SHARE = 40, 1000, 5000, 20


def code_map(codes: dict[str, str], key: Column) -> Column:
    """The label of a code; unknown codes pass through, null stays null."""
    entries = F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))
    return F.coalesce(F.try_element_at(entries, key), key)

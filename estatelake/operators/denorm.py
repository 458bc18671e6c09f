"""Refresh selection and the star join that writes listings in their raw form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.functions.text import render_date
from estatelake.schema import CONSTRUCTION_STATUSES, HEATING, LOCALITY_TYPES, POSTERS, PRICE_ON_REQUEST, REFRESH_SHARE, code_map
from estatelake.sources.shared import staged


def geo_hierarchy(geographies: DataFrame) -> DataFrame:
    """Region, locality and area of each node, by up to two parents."""
    g = geographies.select("geo_id", "parent_id", "level", "name_bg", "locality_type")
    parent = g.select(*(F.col(c).alias(f"p_{c}") for c in g.columns))
    grand = g.select(*(F.col(c).alias(f"g_{c}") for c in g.columns))
    up = g.join(parent, F.col("parent_id") == F.col("p_geo_id"), "left").join(grand, F.col("p_parent_id") == F.col("g_geo_id"), "left")
    at = lambda level, column: F.coalesce(*(F.when(F.col(f"{x}level") == level, F.col(f"{x}{column}")) for x in ("", "p_", "g_")))
    return up.select("geo_id", at("region", "name_bg").alias("region"), at("locality", "name_bg").alias("locality"), at("locality", "locality_type").alias("locality_type"), at("area", "name_bg").alias("area"))


def features_text(property_features: DataFrame, features: DataFrame) -> DataFrame:
    """Distinct feature names of each property in order, as one text."""
    named = property_features.join(features, "feature_id")
    return named.groupBy("property_id").agg(F.nullif(F.array_join(F.array_sort(F.collect_set("name_bg")), ", "), F.lit("")).alias("features"))


def eligible(listings: DataFrame, eligible_ids: DataFrame, excluded_ids: DataFrame, transaction: str) -> DataFrame:
    """Active listings of a transaction whose id is eligible and not excluded. Null ids never pass."""
    active = listings.where((F.col("status") == "active") & (F.col("transaction_type") == transaction) & F.col("source_id").isNotNull())
    return active.join(eligible_ids.select("source_id"), "source_id", "left_semi").join(excluded_ids.select("source_id"), "source_id", "left_anti")


def quota(rows: DataFrame) -> DataFrame:
    """Five per cent of the rows, rounded up."""
    return rows.agg(F.floor((F.count(F.lit(1)) + REFRESH_SHARE - 1) / REFRESH_SHARE).alias("quota"))


def stalest(rows: DataFrame, share: int = REFRESH_SHARE) -> DataFrame:
    """The quota of rows checked longest ago (null last), with their position.

    Rows are sorted in ranges, which are many tasks; a position is the row's place in its range plus the rows of the ranges
    before, of which there is one count each.
    """
    order = F.col("date_last_checked").asc_nulls_last(), F.col("source_id").asc()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "by-staleness")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    ends = sizes.select("_part", F.coalesce(F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("n").over(W.partitionBy()).alias("_all"))
    ranked = placed.withColumn("_part", part).join(F.broadcast(ends), "_part").withColumn("position", (F.col("_before") + F.col("_at") - F.shiftleft("_part", 33) + 1).cast("int"))
    return ranked.where(F.col("position") <= F.floor((F.col("_all") + share - 1) / share)).drop("_part", "_at", "_before", "_all")


def profile(listings: DataFrame, file: str = "transaction_type") -> DataFrame:
    """What is published with the data: for each file its rows, distinct places, kinds, agencies and links, and the share of
    agencies among posters."""
    distinct = {"localities": "locality", "property_types": "property_type", "agencies": "agency_name", "urls": "listing_url"}
    agency = F.round(F.avg((F.col("poster_type") == POSTERS["agency"]).cast("double")), 4)
    return listings.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), *(F.countDistinct(c).alias(n) for n, c in distinct.items()), agency.alias("agency_share"))


def denormalise(listings: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    """Listings in raw form. Features are aggregated before the join, so that nothing fans out; dimensions are small
    and left to the optimiser's own size check."""
    p = star["properties"]
    joined = (
        listings.join(p, "property_id")
        .join(star["property_types"].select("property_type_id", F.col("name_bg").alias("property_type")), "property_type_id")
        .join(star["contacts"].select("contact_id", "contact_type", F.col("name").alias("contact_name"), "phone"), "contact_id")
        .join(geo_hierarchy(star["geographies"]), "geo_id")
        .join(star["construction_types"].select("construction_type_id", F.col("name_bg").alias("construction_type")), "construction_type_id", "left")
        .join(features_text(star["property_features"], star["features"]), "property_id", "left")
    )
    yes_no = F.when(F.col("gas"), "ДА").when(~F.col("gas"), "НЕ")
    storey = F.when(F.col("floor").isNotNull() & F.col("total_floors").isNotNull(), F.concat(F.col("floor").cast("string"), F.lit(" от "), F.col("total_floors").cast("string"))).otherwise(F.col("floor").cast("string"))
    agency = F.col("contact_type") == "agency"
    return joined.select(
        "source_id", "listing_id", "region", "locality", code_map(LOCALITY_TYPES, F.col("locality_type")).alias("locality_type"), "area", "property_type", "bedrooms",
        code_map(POSTERS, F.col("contact_type")).alias("poster_type"), F.when(agency, F.col("contact_name")).alias("agency_name"),
        F.when(F.col("price_on_request"), F.lit(PRICE_ON_REQUEST)).otherwise(F.col("price").cast("string")).alias("price"), "area_m2", storey.alias("floor"), "construction_type",
        code_map(CONSTRUCTION_STATUSES, F.col("construction_status")).alias("construction_status"), "year_built", yes_no.alias("gas"), code_map(HEATING, F.col("tec")).alias("tec"), "features",
        render_date(F.col("date_posted"), "Публикувана").alias("date_posted"), render_date(F.col("date_modified"), "Коригирана").alias("date_modified"), "has_photos",
        F.when(agency, F.col("phone")).alias("agency_phone"), "listing_url", "listing_tier", "transaction_type", "status",
    )

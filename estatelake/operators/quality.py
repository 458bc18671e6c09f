"""The quality gate of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

REQUIRED = ("source_id", "listing_url", "property_type", "locality")


def reject_reason() -> Column:
    """The first thing wrong with a listing: a blank required field, then a non-positive area or year; null if nothing is."""
    out = F.when((F.col("area_m2") <= 0), "area_m2").when(F.col("year_built") <= 0, "year_built")
    for field in reversed(REQUIRED):
        out = F.when(F.coalesce(F.trim(F.col(field)), F.lit("")) == "", field).otherwise(out)
    return out


def with_reason(listings: DataFrame) -> DataFrame:
    return listings.withColumn("reason", reject_reason())


def valid(listings: DataFrame) -> DataFrame:
    return listings.where(reject_reason().isNull())


def counts(listings: DataFrame, *keys: str) -> DataFrame:
    return with_reason(listings).groupBy(*keys).agg(F.count(F.lit(1)).alias("found"), F.count_if(F.col("reason").isNull()).alias("saved"), F.count("reason").alias("rejected"))


def page_summary(listings: DataFrame, keys: list[str], detail_failed: Column) -> DataFrame:
    """Listings found, saved and rejected on each page, and of the saved ones those whose detail page failed."""
    good = F.col("reason").isNull()
    return with_reason(listings).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("found"), F.count_if(good).alias("saved"), F.count_if(~good).alias("rejected"), F.count_if(good & detail_failed).alias("detail_failed")
    )


def falsy_field() -> Column:
    """The first required field that is null or empty; blanks do not count here."""
    out = F.lit(None).cast("string")
    for field in reversed(REQUIRED):
        out = F.when(F.coalesce(F.col(field), F.lit("")) == "", field).otherwise(out)
    return out


def top_rejected_field(listings: DataFrame, order: str) -> DataFrame:
    """The field that most rejected listings lack, ties by first occurrence; ``none`` if there is none."""
    bad = with_reason(listings).where("reason IS NOT NULL").withColumn("field", falsy_field()).where("field IS NOT NULL")
    per_field = bad.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    best = per_field.agg(F.min_by("field", F.struct(-F.col("n"), F.col("first"))).alias("field"), F.max("n").alias("n"))
    return best.select(F.coalesce("field", F.lit("none")).alias("field"), F.coalesce("n", F.lit(0)).alias("n"))


def early_warning(listings: DataFrame, keys: list[str], order: list[str], first: int = 100, share: float = 0.2) -> DataFrame:
    """Whether a fifth or more of a session's first hundred listings is rejected."""
    head = with_reason(listings).withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= first)
    rate = head.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("rejected"))
    return rate.withColumn("warning", (F.col("n") >= first) & (F.col("rejected") >= share * F.col("n")))

"""Fetch outcomes, page facts, completeness gates and run status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.functions.text import redirected_to_listings
from estatelake.schema import LEAST_PAGE_CHARS, PAGE_SIZE

RETRIED = ("retry", "soft_block")


def fetch_outcome() -> Column:
    """What one attempt says, by the first rule that holds."""
    listings = F.col("page_type") == "listings"
    return (
        F.when(F.col("failure").isin("timeout", "connection"), "retry")
        .when(F.col("failure").isNotNull(), "failed")
        .when(F.col("status") == 403, "hard_block")
        .when(F.col("status") == 404, F.when(listings, "empty").otherwise("not_found"))
        .when(F.col("status") != 200, "retry")
        .when((F.col("page_type") == "detail") & redirected_to_listings(F.col("url"), F.col("final_url")), "unavailable")
        .when(F.col("chars") < LEAST_PAGE_CHARS, "too_small")
        .when(~F.col("content_ok") & F.col("after_partial"), "end_of_results")
        .when(~F.col("content_ok"), "soft_block")
        .otherwise("ok")
    )


def final_outcomes(attempts: DataFrame, keys: list[str], order: str, most: int = 2) -> DataFrame:
    """The first conclusive outcome of at most two attempts, else ``exhausted``."""
    numbered = attempts.withColumn("outcome", fetch_outcome()).withColumn("attempt", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where(F.col("attempt") <= most)
    conclusive = F.when(~F.col("outcome").isin(*RETRIED, "too_small"), F.col("outcome"))
    return numbered.groupBy(*keys).agg(F.coalesce(F.min_by(conclusive, F.when(conclusive.isNotNull(), F.col("attempt"))), F.lit("exhausted")).alias("outcome"), F.count(F.lit(1)).alias("attempts"))


def unit_summary(pages: DataFrame, unit: str = "unit") -> DataFrame:
    """Pages, totals, cap verdict and stop reason of each scan unit from its page facts."""
    last = F.max_by("found", "page")
    totals = pages.groupBy(unit).agg(
        F.max("page").alias("pages"), F.sum("found").alias("found"), F.sum("rejected").alias("rejected"), F.sum("detail_failed").alias("detail_failed"), last.alias("last_found")
    )
    return totals.withColumn("capped", F.col("last_found") == PAGE_SIZE).withColumn(
        "stop_reason", F.when(F.col("last_found") == PAGE_SIZE, "possible_cap").when(F.col("last_found") == 0, "end_of_results").otherwise("end_after_partial_page")
    )


def run_counters(events: DataFrame) -> DataFrame:
    """Pages attempted, completed and failed of each transaction, its units and its completed regions."""
    page = F.col("kind").isin("cleared", "failed")
    return events.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(page).alias("pages_attempted"), F.count_if(F.col("kind") == "cleared").alias("pages_completed"), F.count_if(F.col("kind") == "failed").alias("failures"),
        F.countDistinct("unit").alias("units"), F.countDistinct(F.when(F.col("kind") == "region_complete", F.col("region"))).alias("regions_completed"),
    )


def failed_units(events: DataFrame) -> DataFrame:
    """Failures that no later success of the same unit has cleared, by distinct reason."""
    cleared = events.where("kind = 'cleared'").groupBy("transaction_type", "unit").agg(F.max("seq").alias("cleared_at"))
    failures = events.where("kind = 'failed'").groupBy("transaction_type", "unit", "reason").agg(F.max("seq").alias("failed_at"))
    return failures.join(cleared, ["transaction_type", "unit"], "left").where("cleared_at IS NULL OR failed_at > cleared_at").select("transaction_type", "unit", "reason")


def region_of(unit: Column) -> Column:
    return F.regexp_extract(unit, r"^([^:/]*)", 1)


def completeness(expected: DataFrame, events: DataFrame) -> DataFrame:
    """Whether each transaction's regions are all complete, none other is, and no unit has failed."""
    done = events.where("kind = 'region_complete'").select("transaction_type", "region").distinct().withColumn("done", F.lit(True))
    both = expected.select("transaction_type", "region").distinct().withColumn("wanted", F.lit(True)).join(done, ["transaction_type", "region"], "full_outer")
    sets = both.groupBy("transaction_type").agg(F.bool_and(F.coalesce(F.col("done") & F.col("wanted"), F.lit(False))).alias("all_done"), F.count("done").alias("completed"), F.count("wanted").alias("expected"))
    failed = failed_units(events).groupBy("transaction_type").agg(F.countDistinct("unit").alias("failed_units"))
    out = sets.join(failed, "transaction_type", "left").withColumn("failed_units", F.coalesce("failed_units", F.lit(0)))
    return out.withColumn("missing_allowed", F.col("all_done") & (F.col("failed_units") == 0))


def missing_gate(expected: DataFrame, events: DataFrame) -> DataFrame:
    """transaction_type, missing_allowed, reason: whether a transaction's scan is so complete that what it has not seen is missing, and else what holds it back."""
    gate = completeness(expected, events)
    both = F.col("all_done")
    pending = pending_regions(expected, events).groupBy("transaction_type").agg(F.count(F.lit(1)).alias("_pending"))
    reason = F.when(F.col("failed_units") > 0, F.concat("failed_units", F.lit(" failed units"))).when(F.col("_pending") > 0, F.concat("_pending", F.lit(" pending regions"))).when(~both, "regions that were not expected").otherwise("complete")
    return gate.join(pending, "transaction_type", "left").select("transaction_type", "missing_allowed", reason.alias("reason"))


def run_status(gate: DataFrame) -> DataFrame:
    """The run is partial if anything failed, complete if every transaction is, else running."""
    return gate.agg(F.when(F.bool_or(F.col("failed_units") > 0), "partial").when(F.bool_and(F.col("missing_allowed")), "complete").otherwise("running").alias("run_status"), F.count(F.lit(1)).alias("transactions"))


def pending_regions(expected: DataFrame, events: DataFrame) -> DataFrame:
    done = events.where("kind = 'region_complete'").select("transaction_type", "region")
    return expected.select("transaction_type", "region").distinct().join(done, ["transaction_type", "region"], "left_anti")


def region_failed(expected: DataFrame, events: DataFrame) -> DataFrame:
    """Regions with a failed unit: the unit's key is cut once and joined, not compared pair by pair."""
    failed = failed_units(events).select("transaction_type", region_of(F.col("unit")).alias("region")).distinct().withColumn("failed", F.lit(True))
    return expected.select("transaction_type", "region").distinct().join(failed, ["transaction_type", "region"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))

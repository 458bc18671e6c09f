"""Snapshot reconciliation: a scan against the stored state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.text import prices_differ
from estatelake.operators.staging import keyed


def classify(scan: DataFrame, state: DataFrame) -> DataFrame:
    """Adds action, listing_id and old_price to each row of scan (source_id, price).

    One left join on the id: the state is first reduced to one row for each id, so that the join neither multiplies rows nor needs a second
    one. Only active and inactive rows are known, others are as if they were not there. An active row goes before an inactive one; of two of
    one status that with the larger listing_id counts, rows without one last. listing_id is a whole number below 2^60 and unique among the rows of a status.
    """
    # one whole number orders the rows of an id, and all columns are of fixed width, so that a hash aggregation can hold them
    active, far = F.col("status") == "active", 1 << 60
    order = F.coalesce(F.col("listing_id").cast("long"), F.lit(-far)) + F.when(active, F.lit(4 * far)).otherwise(F.lit(0).cast("long"))
    held = state.where(F.col("source_id").isNotNull() & F.col("status").isin("active", "inactive"))
    known = held.groupBy("source_id").agg(F.max(order).alias("_order"), F.max_by("listing_id", order).alias("_id"), F.max_by("price", order).alias("_price"))
    joined = keyed(scan).join(known, "source_id", "left")
    action = F.when(F.col("_order").isNull(), "new").when(F.col("_order") < 2 * far, "reappeared").when(prices_differ(F.col("_price"), F.col("price")), "changed").otherwise("unchanged")
    out = joined.withColumn("action", action)
    told = F.col("action").isin("changed", "reappeared")
    return out.select(*scan.columns, "action", F.when(told, F.col("_id")).alias("listing_id"), F.when(told, F.col("_price")).alias("old_price"))


def missing(state: DataFrame, seen: DataFrame) -> DataFrame:
    """Active rows of the state whose id no region has seen. Ids belong to a transaction: where seen names it, an id is seen in its own one only."""
    keys = ["transaction_type", "source_id"] if "transaction_type" in seen.columns else ["source_id"]
    return state.where((F.col("status") == "active") & F.col("source_id").isNotNull()).join(keyed(seen).select(*keys), keys, "left_anti")


def missing_gated(state: DataFrame, seen: DataFrame, gate: DataFrame) -> DataFrame:
    """Missing rows as actions, of those transactions only whose scan is complete; from a partial scan, what was not seen may well be there.

    gate: runstate.missing_gate, a row for each transaction. It thins the state out before the anti-join, so that a transaction that is held back costs
    nothing. A transaction without a row is not in the run and has no missing rows."""
    allowed = gate.where("missing_allowed").select("transaction_type")
    open_state = state.where(F.col("status") == "active").join(F.broadcast(allowed), "transaction_type", "left_semi")  # a row for each transaction of a run
    rows = missing(open_state, seen)
    return rows.select("transaction_type", "source_id", "listing_id", F.lit("missing").alias("action"), F.lit(None).cast("decimal(20,4)").alias("old_price"), F.lit(None).cast("decimal(20,4)").alias("new_price"))


def missing_report(missing_rows: DataFrame, gate: DataFrame) -> DataFrame:
    """The gate of each transaction with the number of its missing rows."""
    counts = missing_rows.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("missing"))
    return gate.join(counts, "transaction_type", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))


def effective(classified: DataFrame, valid_ids: DataFrame) -> DataFrame:
    """Actions to store: new, changed and reappeared rows that passed the quality gate."""
    acted = classified.where(F.col("action").isin("new", "changed", "reappeared"))
    return acted.join(valid_ids.select("source_id"), "source_id", "left_semi").select("source_id", "listing_id", "action", "old_price", F.col("price").alias("new_price"))


def repair_gaps(selection: DataFrame, rows: DataFrame, actions: DataFrame) -> DataFrame:
    """Selected listings with a stored row but without an action get a ``refreshed`` one, price unchanged."""
    gap = selection.join(rows.select("source_id"), "source_id", "left_semi").join(actions.select("source_id"), "source_id", "left_anti")
    return gap.select("source_id", "listing_id", F.lit("refreshed").alias("action"), F.col("price").alias("old_price"), F.col("price").alias("new_price"))


def apply_actions(state: DataFrame, actions: DataFrame) -> DataFrame:
    """The state after the effective actions: new rows come in, changed and reappeared ones take the new price and are
    active, missing ones become inactive. One full outer join on the id."""
    a = actions.select("source_id", "action", "new_price", F.col("listing_id").alias("_lid"))
    both = state.select("source_id", "listing_id", "status", "price").join(a, "source_id", "full_outer")
    act = F.coalesce("action", F.lit(""))
    return both.select(
        "source_id",
        F.coalesce("listing_id", "_lid").alias("listing_id"),
        F.when(act.isin("new", "changed", "reappeared"), "active").when(act == "missing", "inactive").otherwise(F.col("status")).alias("status"),
        F.when(act.isin("new", "changed", "reappeared"), F.col("new_price")).otherwise(F.col("price")).alias("price"),
    ).where("status IS NOT NULL")

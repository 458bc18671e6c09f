"""Merges of staged rows by key. Arrival order is an explicit sortable column, so that every merge is one
associative aggregation with partial aggregation before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.functions.text import key
from estatelake.schema import ACTIONS, PRIMARY_ACTIONS


def keyed(rows: DataFrame, key_col: str = "source_id") -> DataFrame:
    """Keys trimmed, rows without one dropped."""
    return rows.withColumn(key_col, key(F.col(key_col))).where(F.col(key_col) != "")


def _pick(rows: DataFrame, keys: list[str], order: Column, first: bool) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    chosen = (F.min_by if first else F.max_by)(F.struct(*rest), order)
    return rows.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, "_row.*")


def first_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    return _pick(rows, keys, order, first=True)


def last_wins(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    return _pick(rows, keys, order, first=False)


def effective_actions(actions: DataFrame, seq: str = "seq") -> DataFrame:
    """One action for each id: new, changed, reappeared or missing beat refreshed, else the later one wins."""
    primary = F.col("action").isin(*PRIMARY_ACTIONS)
    valid = keyed(actions).where(F.col("action").isin(*ACTIONS))
    return last_wins(valid, ["source_id"], F.struct(primary, F.col(seq)))


def invalid_actions(actions: DataFrame) -> DataFrame:
    return actions.where(~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False)))


def selection_dedup(selection: DataFrame, id_col: str, position: str) -> DataFrame:
    """The first of each id, blank ids dropped."""
    return first_wins(keyed(selection, id_col), [id_col], F.col(position))


def ordered_distinct(rows: DataFrame, keys: list[str], label: str, order: str, out: str) -> DataFrame:
    """Distinct labels of each key in the order of their first sighting."""
    firsts = rows.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.min(order).alias("_at"))
    return firsts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", label))), lambda x: x[label]).alias(out))


def first_sightings(rows: DataFrame, keys: list[str], label: str, order: str) -> DataFrame:
    """The place of each distinct label by first sighting."""
    firsts = rows.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.min(order).alias("first_seq"))
    return firsts.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy("first_seq", label)))

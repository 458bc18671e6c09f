"""Cutting a table into ranges under a size cap: a count-driven planner with a fixed number of shuffles."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake.schema import PAGE_SIZE, RESULT_CAP
from estatelake.sources.shared import staged

if TYPE_CHECKING:
    import pandas as pd


def grid(regions: DataFrame, kinds: DataFrame) -> DataFrame:
    """Every region with every kind. Both are dimensions of a few dozen rows."""
    return regions.distinct().crossJoin(F.broadcast(kinds.distinct()))


def levels(priced: DataFrame, region: str, kind: str, cap: int) -> DataFrame:
    """1 if the whole region is under the cap, 2 if the kind is, else 3 (ranges)."""
    per_kind = priced.groupBy(region, kind).agg(F.count(F.lit(1)).alias("n"))
    per_region = per_kind.groupBy(F.col(region).alias("_region")).agg(F.sum("n").alias("n_region"))
    both = per_kind.join(per_region, F.col(region) == F.col("_region")).drop("_region")
    return both.withColumn("level", F.when(F.col("n_region") < cap, 1).when(F.col("n") < cap, 2).otherwise(3))


def price_buckets(priced: DataFrame, units: list[str], low: int, high: int, cap: int) -> DataFrame:
    """units, lo, hi, n: ranges under the cap, or as far as halving goes; rows without a price are bucket null..null.

    A histogram by price comes first, with partial sums before the shuffle: nothing after it depends on rows. A unit's histogram has
    at most as many rows as there are prices between the bounds; its ranges are cut top down on cumulative counts, and
    only those still at the cap are cut again.
    """
    schema = T.StructType([*(priced.schema[u] for u in units), *(T.StructField(c, T.LongType()) for c in ("lo", "hi", "n"))])
    names = [*units, "lo", "hi", "n"]

    def cut(key: tuple, prices: pd.DataFrame) -> pd.DataFrame:
        import numpy
        import pandas

        prices = prices[prices["price"].notna()].sort_values("price")
        at, upto = prices["price"].to_numpy(numpy.int64), numpy.concatenate([[0], numpy.cumsum(prices["c"].to_numpy(numpy.int64))])
        out, open_ = [], [(low, high, True)]
        while open_:
            lo, hi, is_root = open_.pop()
            n = int(upto[numpy.searchsorted(at, hi, "right")] - upto[numpy.searchsorted(at, lo, "left")])
            mid = (lo + hi) // 2
            if not n:
                continue
            if lo < hi and mid != lo and (is_root or n >= cap):
                open_ += [(lo, mid, False), (mid + 1, hi, False)]
            else:
                out.append((*key, lo, hi, n))
        return pandas.DataFrame(out, columns=names)

    hist = priced.groupBy(*units, "price").agg(F.count(F.lit(1)).alias("c"))
    hist = staged(hist.where((F.col("price").isNull()) | F.col("price").between(low, high)), "price-histogram")
    without = hist.where("price IS NULL").select(*units, F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), F.col("c").alias("n"))
    return without.unionByName(hist.where("price IS NOT NULL").groupBy(*units).applyInPandas(cut, schema))


def bucket_pages(buckets: DataFrame, n: str = "n") -> DataFrame:
    """A row for each page of a bucket; results beyond the cap cannot be shown."""
    shown = F.least(F.col(n), F.lit(RESULT_CAP))
    return buckets.where(F.col(n) > 0).withColumn("page", F.explode(F.sequence(F.lit(1), F.ceil(shown / PAGE_SIZE).cast("int"))))


def resume(buckets: DataFrame, resume_low: Column) -> DataFrame:
    """Buckets from a resume point on, compared as numbers."""
    return buckets.where(F.col("hi") >= resume_low)

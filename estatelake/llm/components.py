"""Connected components by alternating large-star and small-star steps, all in joins and aggregations.

No neighbour lists are built: a step needs only the least neighbour of each node, which is
pre-aggregated, and one join of the edges with it. Rounds are written to the shared folder. They grow with the
logarithm of the longest chain; if ``MAX_ROUNDS`` do not settle the labels the job fails and says so.

Defined cases: an edge of a node with itself and a null end name no node; repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import drop_staged, staged

MAX_ROUNDS = 60


#: Up to so many edges their least neighbours (16 bytes each) are sent to all tasks.
BROADCAST_EDGES = 500_000


def _star(edges: DataFrame, large: bool, few: bool) -> DataFrame:
    """edges (u, v) with v < u -> edges to the least neighbour of u (or u)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("m", "u").alias("m"))
    # a large one is written first, so that the join below reads two plain shuffles, of which Spark can split a hot node's
    least = F.broadcast(least) if few else staged(least, "least")
    moved = both.join(least, F.col("u") == F.col("_u"))
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """node, root: the least node of its component, for each node that has an edge."""
    spark = edges.sparkSession
    now = staged(edges.where(F.col(left) != F.col(right)).select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "edges")
    seen = None
    few = now.count() <= BROADCAST_EDGES
    for _ in range(MAX_ROUNDS):
        large = staged(_star(now, True, few), "large-star")
        after = staged(_star(large, False, few), "small-star")
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        drop_staged(now, large)
        now = after
        if state == seen:
            break
        seen, few = state, state[0] <= BROADCAST_EDGES
    else:
        raise RuntimeError(f"connected components have not settled after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

"""Connected components of an edge table by alternating large-star and small-star steps.

Each step keeps, for a node, only links to the smallest node it knows.  Links
are narrow rows; the smallest neighbour is a partially combined minimum, and
the join that hands it back is an ordinary sort-merge join whose hot keys
Spark can split.  The number of rounds grows with the logarithm of the longest
path.  Every round is written to the shared folder, so a lost executor costs
its own tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.session import materialize


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b), a > b.  Links each node's neighbours to the smallest of them and itself."""
    if large:
        out = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        out = edges
    low = out.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    both = out.join(low, "a")
    if large:                       # larger neighbours move to the smallest one
        moved = both.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:                           # smaller neighbours and the node itself do
        moved = both.select(F.col("b").alias("a"), F.col("low").alias("b")) \
            .unionByName(low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node reachable.

    Links may come in any direction, repeated, or from a node to itself; null ends are left out."""
    x, y = F.col(a), F.col(b)
    now = edges.where(x.isNotNull() & y.isNotNull() & (x != y)) \
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    now = materialize(now, "links")
    seen = None
    for _ in range(rounds):
        now = materialize(_step(_step(now, True), False), "links")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

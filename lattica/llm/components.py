"""Connected components of an edge table, by alternating stars: no link list ever reaches the driver.

Large-star hooks every larger neighbour of a node to the smallest node around it; small-star does so for the smaller
neighbours. Both keep the components, and alternating them ends, after few rounds, in one star per component. The smallest
neighbour comes from a partial aggregation and is joined back, so that a node with very many neighbours is not gathered in
one task (its join partition can be split by AQE). Every round is a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import checkpoint


def _star(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest node around u, u included."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = both.join(_star(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = _star(down)
    hooked = down.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge to another node. Nulls and loops
    are left out; an empty edge table gives an empty result."""
    now = checkpoint(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and u <> v").distinct()
    )
    seen = None
    while True:
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign[0] == 0 or sign == seen:
            break
        seen = sign
        now = checkpoint(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""Connected components of a graph of any size, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, least): each pair with the least of u and all its partners.

    The minimum is summed up per key before the shuffle and joined back by sort-merge, where a hub is split.
    """
    lows = pairs.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("_u"), "low")
    joined = pairs.join(lows.hint("merge"), F.col("u") == F.col("_u"))
    return joined.select("u", "v", F.least("u", "low").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    stars = _least(down)
    return (
        stars.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .union(stars.select("u", F.col("least").alias("v")))
        .filter("u <> v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the least node it is connected with.

    Nodes may be of any ordered type but not NULL; edges may repeat and u may equal v, which adds nothing but the
    node. Every round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    kept = cut_lineage(edges.select("u", "v").distinct())
    alone = kept.filter("u = v").select("u").distinct()
    stars, before = kept.filter("u <> v"), None
    while True:
        stars = cut_lineage(_small_star(_large_star(stars)))
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    inner = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    linked = inner.unionByName(roots)
    single = alone.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return linked.unionByName(single.join(linked.select("node"), "node", "left_anti"))

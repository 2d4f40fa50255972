"""Connected components of links by alternating stars, as Spark joins.

Every round points each node at the smallest node it knows of, first over all
its neighbours, then over the smaller ones. A component of any size and shape
ends as one star; the rounds grow with the logarithm of the longest path. Only
a count of changed rows comes to the driver. A node with very many neighbours
is one row with a minimum on one side of a join, which splits by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").union(turned)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to the smallest of it and its neighbours."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    down = down.where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m")
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node it reaches) for every node of ``a``, ``b``."""
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    while True:
        after = written(_small_star(_large_star(now)), "links", release=False)
        mark = F.sum(F.col("side")).alias("side")
        changed = (
            now.select("a", "b", F.lit(1).alias("side"))
            .union(after.select("a", "b", F.lit(-1).alias("side")))
            .groupBy("a", "b")
            .agg(mark)
            .where("side <> 0")
        )
        settled = changed.isEmpty()
        now = after
        if settled:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(tops)

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.storage import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and every neighbour below it are tied to the smallest of these neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns u, v); root is the least of its component.

    Large-star and small-star steps in turn, until all links lead to a root. Each is a grouping
    with a partial minimum and a join of tables with exchanges of their own, so a node
    with very many links is split. Rows stay as many as links at most. A root itself is
    not listed unless it links to itself; links of a node to itself are ignored.
    """
    edges = stored(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u > v")
        .distinct(),
        "links",
    )
    while True:
        high = stored(_large_star(edges).filter("u > v").distinct(), "links")
        after = stored(_small_star(high).filter("u > v").distinct(), "links")
        discard(edges, high)
        edges = after
        if _is_forest_of_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, which is no u itself. Steps keep what is connected."""
    roles = edges.select("u", F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("low"), F.lit(1).alias("high"))
    )
    roles = roles.groupBy("u").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return roles.agg(F.count_if(F.expr("low > 1 or low = 1 and high = 1"))).first()[0] == 0

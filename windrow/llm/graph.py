"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) with a > b, moved to the least neighbour of their common end.

    The least neighbour is a partial aggregate; the join back has narrow rows, so adaptive
    execution can split the links of a node that very many others hang on.
    """
    if large:
        ends = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        ends = edges.toDF("u", "v")
    least = ends.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    moved = ends.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b); the root is the least node.

    Every round is a written table, and no more than whether it is the last comes to the
    driver. The number of rounds grows with the logarithm of the longest chain.
    """
    tidy = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialise(tidy, "links")
    while not _done(edges):
        edges = materialise(_stars(_stars(edges, True), False), "stars")
    return edges.toDF("node", "root").union(edges.select("b", "b").distinct())


def _done(edges: DataFrame) -> bool:
    """Has every node one root, and no root a root of its own?"""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)).distinct()
    )
    both = ends.groupBy("a").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return both.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()

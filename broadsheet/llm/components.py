"""Connected components of an undirected graph, as DataFrame rounds.

Alternating large-star and small-star steps: edges always point from a larger
node to a smaller one, each step hooks whole neighbourhoods onto their least
member, and the graph ends as one star per component around its least node.
The number of rounds grows with the logarithm of the component size, not its
diameter, so there is no cap.  Every round is a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import materialise


def _large_star(e: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is hooked onto the least of the node's neighbourhood."""
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    return both.where(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all hooked onto the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    spokes = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return spokes.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(e: DataFrame) -> bool:
    """Each node points to at most one node, and that one points nowhere."""
    inner = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
    forked = e.groupBy("u").count().where("count > 1")
    return inner.limit(1).count() == 0 and forked.limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node of its component.

    Edges with a null end are ignored; a loop ``(a, a)`` makes ``a`` a node.
    """
    pairs = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    e = materialise(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while not _is_forest_of_stars(e):
        e = materialise(_small_star(materialise(_large_star(e))))
    return nodes.join(e.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("root")
    )

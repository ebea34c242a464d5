"""Connected components of a link table, as alternating star contractions."""

from pyspark.sql import functions as F

from ..storage import durable


def _large_star(links):
    """Point every larger neighbour of a node at the smallest node around it."""
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    smallest = both.groupBy("src").agg(
        F.least("src", F.min("dst")).alias("root")
    )
    return (
        both.filter(F.col("dst") > F.col("src")).join(smallest, "src")
        .select(F.col("dst").alias("src"), F.col("root").alias("dst"))
        .distinct()
    )


def _small_star(links):
    """Point a node and its smaller neighbours at the smallest of them."""
    smallest = links.groupBy("src").agg(F.min("dst").alias("root"))
    moved = (
        links.join(smallest, "src")
        .filter(F.col("dst") != F.col("root"))
        .select(F.col("dst").alias("src"), F.col("root").alias("dst"))
    )
    kept = smallest.select("src", F.col("root").alias("dst"))
    return moved.unionByName(kept).distinct()


def _all_stars(links):
    """True when every node has one target and no target has a target of its own."""
    sides = links.select(F.col("src").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    sides = sides.unionByName(
        links.select(F.col("dst").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    open_nodes = sides.groupBy("node").agg(
        F.sum("out").alias("out"), F.max("into").alias("into")
    ).filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1)))
    return open_nodes.isEmpty()


def connected_components(links, left, right):
    """(node, component) for every linked node except the smallest of its component.

    Rounds grow with the logarithm of the number of nodes; the driver sees only whether
    the links have become stars.
    """
    links = links.filter(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("src"), F.least(left, right).alias("dst")
    ).distinct()
    links = durable(links)
    while not _all_stars(links):
        links = durable(_small_star(_large_star(links)))
    return links.select(F.col("src").alias("node"), F.col("dst").alias("component"))

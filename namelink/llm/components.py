"""Connected components of a link table by label propagation with pointer jumping."""

from pyspark.sql import functions as F

from .shared import staged


def components(links):
    """(node, component) for every node of ``links`` (a, b); the smallest node names it.

    A round gives each node the least label around it and then the label of that label, so
    rounds grow with the logarithm of the longest path. Every round is a table in the
    shared folder; the driver sees only how many labels changed.
    """
    edges = staged(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-links",
    )
    labels = staged(
        edges.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("label")
        ), "component-labels",
    )
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        jumped = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = labels.join(jumped, "label").join(around, "node").select(
            "node", F.least("label", "far", "near").alias("new"), "label"
        )
        stepped = staged(step, "component-labels")
        labels = stepped.select("node", F.col("new").alias("label"))
        if stepped.filter("new != label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))

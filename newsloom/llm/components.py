"""Connected components of a table of links, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for all nodes of ``links``; the component is its smallest node.

    Each round, every node points to its smallest neighbour if that is smaller. Pointers are followed
    to their end by doubling, and the links are rewritten between the nodes they end at, so at least
    every second node disappears. All steps are joins and minima by key, which are combined before
    they are shuffled, so no hub is ever gathered. Links with a null end are ignored; repeated links
    and links of a node to itself do no harm. Without links, the result is empty.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a != b")
    links = stored(links, "links")
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = stored(ends.withColumn("component", F.col("node")), "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        pointers = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("node"), "to")
        pointers = stored(pointers, "pointers")
        while True:
            further = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = stored(pointers.join(further, "to").select("node", F.col("next").alias("to"), (F.col("next") < F.col("to")).alias("moved")), "pointers")
            pointers = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        roots = pointers.select(F.col("node").alias("component"), "to")
        labels = stored(
            labels.join(roots, "component", "left").select("node", F.coalesce("to", "component").alias("component")),
            "labels",
        )
        left = pointers.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = pointers.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links = stored(
            links.join(left, "a").join(right, "b").where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
    return labels

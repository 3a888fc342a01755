"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.session import drop_table, write_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (src, dst); the label is the
    component's smallest node.

    Each round takes the smallest label around a node and then the label of
    that label, so distances halve. Labels are written as a table each round;
    minima combine on the map side and joins are on one row per node, so a node
    with any number of edges costs no task more than its share.
    """
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = write_table(both.where("src != dst").distinct(), "cc-edges")
    labels = write_table(both.groupBy("src").agg(F.min("dst").alias("m"))
                         .select(F.col("src").alias("node"), F.least("src", "m").alias("label")), "cc-labels")
    while True:
        ends = labels.select(F.col("node").alias("dst"), F.col("label").alias("l"))
        around = both.join(ends, "dst").groupBy("src").agg(F.min("l").alias("m"))
        near = write_table(labels.join(around.withColumnRenamed("src", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "cc-near")
        jump = near.select(F.col("node").alias("via"), F.col("label").alias("further"))
        new = write_table(near.join(jump, near["label"] == jump["via"]).select(
            "node", "old", F.least("label", "further").alias("label")), "cc-labels")
        drop_table(labels)
        drop_table(near)
        labels = new.select("node", "label")
        if new.where("label != old").isEmpty():
            drop_table(both)
            return labels
        labels = new.drop("old")

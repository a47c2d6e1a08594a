"""Connected components of an edge table, by joins and minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodmill.storage import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``(a, b)`` edges; the label is its component's least node.

    Each round takes the least label of the neighbours and then the label of the label, and
    stores the result; it ends when no label changes. Labels only fall, so it always ends.
    Edges given as stars need two or three rounds. A node with many neighbours is a skewed join
    key, which adaptive execution splits, and its labels are merged before they travel.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = materialise(both.filter("a <> b").distinct(), "links")
    labels = materialise(
        links.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            links.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = materialise(
            labels.join(near, "node").select(
                "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
            ),
            "labels",
        )
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = materialise(
            hooked.join(above, "label").select("node", "old", F.col("up").alias("label")), "labels"
        )
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")

"""Connected components of a link table, with stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): label is the smallest node it is connected to.

    Each round takes the smallest label among a node and its neighbours, then the label's own label, which
    halves the way to go. Rounds are written tables; they end when no label changes.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a != b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
        "node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        lower = stored(labels.join(further, "label").join(near, "node").select(
            "node", F.least("label", "near", "further").alias("label"), F.col("label").alias("old")), "labels")
        changed = lower.filter("label != old").limit(1).count()
        labels = lower.select("node", "label")
        if not changed:
            return labels

"""Connected components of an edge table, by label propagation and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every endpoint of ``edges`` (a, b): the smallest node
    reachable, itself included. Every round's labels are written, so a lost
    executor repeats one round at most; rounds grow with the logarithm of the
    longest path. Written tables on both sides let skewed joins be split."""
    both = keep(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        hooked = keep(labels.join(around, F.col("node") == F.col("a")).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "labels")
        to = hooked.select(F.col("node").alias("to"), F.col("label").alias("next"))
        labels = keep(hooked.join(to, F.col("label") == F.col("to")).select("node", "was", F.col("next").alias("label")), "labels")
        moved = labels.where("label <> was").take(1)
        labels = labels.select("node", "label")
        if not moved:
            return labels

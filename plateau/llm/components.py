"""Connected components by minimum labels with pointer jumping; one row per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import cut_swept


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): label is the smallest node it is
    linked with. A round gives each node the least label around it and then that label's
    own label, so a chain of d links takes about log2(d) rounds; every round is cut."""
    both = cut_swept(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_swept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("label")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m")))
        step = (labels.join(near, "node")
                .select("node", "label", F.least("label", "m").alias("m")))
        up = labels.select(F.col("node").alias("m"), F.col("label").alias("up"))
        new = cut_swept(step.join(up, "m").select("node", F.col("label").alias("old"), F.least("m", "up").alias("label")))
        labels = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            return labels

"""Connected components of a table of links, in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): the least node that it reaches.

    Each round takes the least label of all neighbours, then the label of that label, so rounds grow with the logarithm
    of the longest path. Every round is written to the shared folder.
    """
    both = written(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label"))
        step = written(step)
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = written(step.join(jump, "label", "left").select("node", "was", F.coalesce("next", "label").alias("label")))
        if not labels.where("label <> was").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")

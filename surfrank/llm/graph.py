"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfrank.llm.tables import settled


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node of ``links`` (a, b): component is the smallest node reachable.

    Each round takes the least label among a node and its neighbours and then
    the label of that label, so long chains shorten by half.  Labels are
    checkpointed in every round; only the number of changes reaches the driver.
    """
    both = settled(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = settled(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        step = settled(step)
        up = step.select(F.col("node").alias("now"), F.col("now").alias("above"))
        labels = settled(step.join(up, "now", "left").select("node", "was", F.least("now", F.coalesce("above", "now")).alias("component")))
        if labels.where("component <> was").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")

"""Connected components of a link table, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours, then follows the label
    to its own label, so long chains shorten fast; rounds are written, so none is redone.
    """
    links = written(links.select("a", "b").where("a <> b"), "links")
    both = links.union(links.select("b", "a")).toDF("node", "other").distinct()
    labels = written(both.groupBy("node").agg(F.min("other").alias("least"))
                     .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        around = (both.join(labels.withColumnRenamed("node", "other"), "other")
                  .groupBy("node").agg(F.min("component").alias("around")))
        nearer = labels.join(around, "node").select("node", "component", F.least("component", "around").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("next"))
        moved = written(nearer.join(jump, "to").select("node", F.col("component").alias("old"), F.col("next").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.where("old <> component").isEmpty():
            return labels

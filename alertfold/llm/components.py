"""Connected components of a link table, by the smallest node of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; the component is named by its
    smallest node.  Rounds of hooking to the smallest neighbour's label and jumping to the
    label's own label; a round costs two joins and the number of rounds grows with the
    logarithm of the longest chain.  Only a count comes to the driver."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("least"))
                 .select(F.col("a").alias("node"), F.least("a", "least").alias("component")))
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
                .withColumnRenamed("a", "node"))
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("hook"))
        to = labels.select(F.col("node").alias("hook"), F.col("component").alias("jump"))
        new = written(hooked.join(to, "hook").select("node", "old", F.least("hook", "jump").alias("component")))
        labels = new.select("node", "component")
        if new.filter("old <> component").isEmpty():
            return labels

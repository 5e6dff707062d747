"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicframe.llm.common import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``links`` (a, b), in either direction.

    A round gives each node the least label among its neighbours and itself,
    then the label of its label; it ends when no label changes. Labels are
    written to the shared folder each round, so a lost executor costs one
    round. Null ends link nothing; without links there are no rows.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = checkpointed(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("node"), F.least("a", "near").alias("component")), "labels")
    while True:
        around = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("least"))
        )
        hooked = labels.join(around, "node").select("node", F.least("component", "least").alias("to"), F.col("component").alias("old"))
        # the label's own label, one jump
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("further"))
        new = hooked.join(jump, "to", "left").select("node", F.least("to", F.coalesce("further", "to")).alias("component"), "old")
        new = checkpointed(new, "labels")
        changed = new.where("component <> old").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels

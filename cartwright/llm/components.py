"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.session import materialise


def components(links: DataFrame) -> DataFrame:
    """node and label for every node of the links (a, b); two nodes have one label if links connect them.

    Each round points every node to its smallest neighbour and keeps the links between the nodes pointed
    to. With hashes as nodes a round removes a constant share of them, so there are few rounds; every round
    is written to the shared folder. The label is one of the nodes.
    """
    links = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    labels = None
    while labels is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        parents = materialise(parents.select("node", F.least("node", "low").alias("label")), "parents")
        if labels is None:
            labels = parents
        else:
            step = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        left = parents.select(F.col("node").alias("a"), F.col("label").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("label").alias("pb"))
        moved = links.join(left, "a").join(right, "b").where("pa <> pb")
        links = materialise(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links"
        )
    return materialise(labels, "labels")

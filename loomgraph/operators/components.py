"""Connected components by passing on the least label, with a written table between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import materialise

MOST_ROUNDS = 100


def connected_ids(pairs: DataFrame) -> DataFrame:
    """id, component (its least id) of every end of a pair (a, b).

    Each round, nodes take the least label around them, and then the label of that label, so distances halve.
    Raises where the labels haven't settled after MOST_ROUNDS, rather than cut a component.
    """
    both = materialise(pairs.select(F.col("a").alias("id"), F.col("b").alias("to")).union(pairs.select("b", "a")).distinct(), "pairs")
    labels = materialise(both.select("id", F.col("id").alias("component")).distinct(), "labels")
    for _ in range(MOST_ROUNDS):
        around = both.join(labels.withColumnsRenamed({"id": "to", "component": "_c"}), "to").groupBy("id").agg(F.min("_c").alias("_c"))
        least = labels.join(around, "id").select("id", F.least("component", "_c").alias("component"), F.col("component").alias("_was"))
        jump = least.select(F.col("id").alias("component"), F.col("component").alias("_next"))
        after = least.join(jump, "component").select("id", F.least("component", "_next").alias("component"), "_was")
        after = materialise(after, "labels")
        labels = after.drop("_was")
        if after.filter("component <> _was").isEmpty():
            return labels
    raise RuntimeError("components did not settle")

"""Connected components of an edge table: rounds of minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` for every end of ``edges(a, b)``; the label is the smallest
    node reachable.  A round takes the smallest label of all neighbours (pre-aggregated
    before its shuffle) and then the label of that label, so the number of rounds grows
    with the logarithm of a component's diameter.  Labels are written each round."""
    both = scratch.write(edges.union(edges.select("b", "a")).toDF("a", "b").distinct())
    now = scratch.write(both.df.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.df.join(now.df, F.col("b") == F.col("node")).groupBy("a")
                .agg(F.min("label").alias("near")))
        lower = now.df.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = now.df.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = lower.join(jump, "label", "left").select(
            "node", "was", F.least("label", F.coalesce("next", "label")).alias("label"))
        new = scratch.write(step)
        moved = new.df.where("label != was").limit(1).count()
        now.drop()
        if not moved:
            both.drop()
            return new.df.select("node", "label")
        now = new

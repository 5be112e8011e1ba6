"""Connected components of a table of edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (a, b): the smallest node reachable.

    Each round takes the smallest label among the neighbours' and then jumps to
    the label's own label, so paths shorten by halves; each round's table is
    written, so no lineage builds up.  Aggregation is partial: a hub is no hot task.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        # A label is a node of the same component, so it has a label too; the smaller one is a valid label for the old label's node as well.
        step = cut(step, "cc-step")
        hook = step.groupBy(F.col("old").alias("at")).agg(F.min("label").alias("h"))
        jump = step.select(F.col("node").alias("at2"), F.col("label").alias("j"))
        new = step.join(hook, step["old"] == hook["at"]).select("node", "old", F.least("label", "h").alias("label"))
        new = new.join(jump, new["label"] == jump["at2"]).select("node", "old", F.least("label", "j").alias("label"))
        new = cut(new, "cc-labels")
        labels = new.select("node", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

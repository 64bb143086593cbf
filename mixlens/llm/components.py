"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its smallest node.

    Each round points every node to the smallest of itself and its neighbours, follows these pointers to their ends
    by doubling (pointers lead to ever smaller nodes, so they form trees), and keeps the links between the ends, until none is
    left. An end takes at least one other node with it, so a round at least halves the nodes: no order of names, a long
    path included, takes more than about log2(nodes) rounds of log2(nodes) steps. A node's links are only aggregated
    (min), so a node with very many links is no hot task. Each round is written to the shared folder, which cuts the lineage.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    labels, k = None, 0
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("to"))
        step = _ends(stored(step.select("node", "to"), f"links-step{k}"), k)
        if labels is None:
            labels = step.select("node", F.col("to").alias("component"))
        else:
            nxt = step.select(F.col("node").alias("component"), F.col("to"))
            labels = labels.join(nxt, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = stored(labels, f"links-labels{k}")
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a") \
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        edges = stored(ends.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                       .distinct(), f"links-round{k}")
        k += 1
    return labels


def _ends(step: DataFrame, k: int) -> DataFrame:
    """Pointers (node, to) followed to their ends, twice as far each time."""
    while True:
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("end"))
        further = stored(step.join(onward, "to").select("node", F.col("end").alias("to"), (F.col("end") < F.col("to")).alias("moved")),
                         f"links-jump{k}")
        step = further.select("node", "to")
        if further.where("moved").isEmpty():
            return step

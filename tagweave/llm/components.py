"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: smallest node id.

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their roots by pointer jumping, and contracts the graph to the roots. Nodes
    only ever hook to smaller ones, so the hooks are a forest; rounds go on
    until no edge joins two roots. Minima are aggregated before the shuffle, so
    a node with very many neighbours is no hot key. Self loops and repeated
    edges are allowed; an empty table gives an empty result.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "cc-edges",
    )
    found = None  # (node, component) over the nodes of the first graph
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).select(F.col("a").alias("node"), "up"),
            "cc-hooks",
        )
        while True:  # pointer jumping: up := up(up)
            far = hooks.select(F.col("node").alias("up"), F.col("up").alias("far"))
            jumped = written(hooks.join(far, "up").select("node", F.col("up").alias("was"), F.col("far").alias("up")), "cc-jump")
            hooks = jumped.select("node", "up")
            if jumped.where("was <> up").isEmpty():
                break
        if found is None:
            found = hooks.withColumnRenamed("up", "component")
        else:
            found = written(
                found.join(hooks.withColumnRenamed("node", "component"), "component", "left").select(
                    "node", F.coalesce("up", "component").alias("component")
                ),
                "cc-found",
            )
        a = hooks.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        b = hooks.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = written(
            edges.join(a, "a").join(b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "cc-edges",
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found

"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; a component is named by its least node.

    Every round gives each node the least name among its neighbours', then the name of the node that
    it is named after, until no name changes; the latter halves the distances, so long chains take
    few rounds. Names and edges stay in tables, each round's names are staged."""
    links = edges.filter("a <> b").select("a", "b")
    rows = 2 * links.count()
    links = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", rows)
    first = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    names = stage(first.select("node", F.least("node", "least").alias("component")), "names", rows)
    while True:
        near = links.join(names, links.a == names.node).groupBy(F.col("b").alias("node")).agg(F.min("component").alias("seen"))
        lower = names.join(near, "node").select("node", "component", F.least("component", "seen").alias("next"))
        after = names.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        step = stage(lower.join(after, "next").select("node", F.col("jump").alias("component"), F.col("component").alias("was")), "names", rows)
        if step.filter("component <> was").isEmpty():
            return step.select("node", "component")
        names = step.select("node", "component")

"""Connected components of an edge table, without bringing links or components to one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root of each node of edges (a, b): root is the smallest node of its component.

    Each round a node takes the smallest root among its neighbours, then the root of its root; rounds double the reach along
    chains of roots and end when no root changes. Every round is a table in the shared folder; joins are shuffled with partial
    minima, so that a node with very many neighbours is reduced before it is dealt. Null nodes are left out.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    ways = F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = materialize(edges.select(ways).distinct(), "links")
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        hop = roots.select(F.col("node").alias("low"), F.col("root").alias("far"))
        new = step.join(hop, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("new"), "root")
        new = materialize(new, "roots")
        changed = new.filter(F.col("new") < F.col("root")).limit(1).count()
        roots = new.select("node", F.col("new").alias("root"))
        if not changed:
            return roots

"""Connected components of a pair graph, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartoria.functions.lineage import cut


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: for every node of the graph the smallest node of its connected component.

    Each round takes the smallest root among neighbours and then the root of that root, so long chains
    halve. A root only ever falls, so the rounds end when none does. Nodes, edges and roots stay distributed; a round's result is
    written to the checkpoint folder and the driver only learns whether anything changed. Edges of a node with itself and null ends are left out.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).filter(F.col("node") != F.col("other"))
    turned = F.explode(F.array(F.struct("node", "other"), F.struct(F.col("other").alias("node"), F.col("node").alias("other"))))  # a union would compute the edges twice
    both = cut(pairs.select(turned.alias("e")).select("e.*").distinct())
    roots = cut(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        seen = both.join(roots.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("m"))
        lower = roots.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        jumped = lower.join(roots.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left").select(
            "node", "was", F.least("root", F.coalesce("further", "root")).alias("root")
        )
        following = cut(jumped)
        roots = following.select("node", "root")
        if following.filter(F.col("was") != F.col("root")).limit(1).count() == 0:
            return roots

"""Connected components of a link table, by repeated random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from musterline.session import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node and the smallest node it can reach.

    In each round every node points to the smallest of itself and its neighbours (in a random order
    that changes by round; in the first by number), and links move to the nodes pointed to. A round
    removes an expected constant share of the nodes, whatever the graph: a chain needs logarithmic,
    a star few rounds. Links of a hot node are pre-aggregated; the joins leave hot keys to adaptive
    skew handling. Each round is written to the shared work folder, so a lost executor costs one round.
    Rows with a null end and links of a node to itself are ignored.
    """
    edges = written(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b").distinct()
    )
    nodes = None
    for turn in range(200):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = (lambda c: F.struct(c.alias("o"), c.alias("n"))) if turn == 0 else (
            lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("o"), c.alias("n"))
        )
        least = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
        points = written(least.select("a", F.least(order(F.col("a")), F.col("m"))["n"].alias("to")))
        if nodes is None:
            nodes = points.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = points.select(F.col("a").alias("root"), F.col("to"))
            nodes = nodes.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        nodes = written(nodes)
        moved = edges.join(points, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        moved = moved.join(points, "a").select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
        edges = written(moved.where("a <> b").distinct())
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = nodes.groupBy("root").agg(F.min("node").alias("component"))
    return nodes.join(smallest, "root").select("node", "component")

"""Connected components over edge tables, by alternating large-star and small-star steps.

Every node ends up linked to the smallest node of its component. A step is a grouped minimum (partially aggregated before
the shuffle) and an equi-join, which Spark splits where a hub has very many edges; the edge count never grows by more than
the nodes. Each step is written to the shared folder, so lineage stays short and a lost executor costs one reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.common import cut


def components(edges: DataFrame, most_steps: int = 60) -> DataFrame:
    """node, component of every node that edges (a, b) name; component is the smallest node reachable.

    Edges with a null end are left out; loops and repeated edges are harmless; no edges give no rows.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    nodes = now.select(F.col("a").alias("node")).union(now.select(F.col("b").alias("node"))).union(loops).distinct()
    last = None
    for _ in range(most_steps):
        # large star: larger neighbours of a node get linked to the smallest of it and its neighbours
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        large = now.join(least, F.col("b") == F.col("c")).select("a", F.col("m").alias("b"))
        # small star: a node and its smaller neighbours get linked to the smallest of these
        large = cut(large.where("a != b").distinct(), "star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least.select("a", F.col("m").alias("b")))
        now = cut(small.distinct(), "star")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError(f"components did not settle in {most_steps} steps")
    return nodes.join(now.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))

"""Connected components of a link table, by rounds of joins.

Each round lets every node point at the smallest label among its neighbours (large
star) and then at its parent's label (small star), so that paths shrink by half or
better.  Rounds are written to the shared scratch folder; no link leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; component is the smallest node.

    The edge set is replaced in each round: large star joins each node's greater
    neighbours to its smallest neighbour, small star its smaller ones.  Both only use
    ``min`` per node and a join back, so a node with very many links is pre-aggregated
    before the shuffle and its rows can be split in the join.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        small = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        new = cut_lineage(small, "links")
        # stars only: no node is both a child and a parent, and each child has one parent
        facts = new.agg(F.count("*").alias("n"), F.count_distinct("u").alias("c")).first()
        settled = facts.n == facts.c and not new.join(
            new.select(F.col("v").alias("u")).distinct(), "u", "left_semi"
        ).limit(1).count()
        edges = new
        if settled:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )

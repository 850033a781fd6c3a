"""Parent, root and ancestors of parent-pointer hierarchies of any depth."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.operators.joins import enrich
from grainframe.session import cut_lineage


def with_parent(
    df: DataFrame, key: str, parent: str, columns: Sequence[str], prefix: str = "parent_"
) -> DataFrame:
    """Attributes of the direct parent; rows without one keep nulls."""
    return enrich(df, df, {parent: key}, columns, prefix, keep="fact")


def root_of(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Root and depth of every row: ``(key, root, depth, in_cycle)``.

    A row without a parent, whose parent is missing from ``df``, or that names
    itself is a root (depth 0).  Rows on or below a cycle get a null root.

    Pointer jumping: each round replaces a pointer by its target's pointer, so
    depth d takes about log2(d) rounds.  Only rows that are somebody's parent
    take part; leaves, usually most rows, are resolved by one last join.  Rows
    that reached a root leave the rounds, so joins do not pile up on roots.
    Each round writes the rows that moved to shared storage, no others.
    """
    edges = df.select(F.col(key).alias("id"), F.col(parent).alias("up"))
    named = edges.filter("up is not null and up != id").select(F.col("up").alias("node")).distinct()
    inner = edges.join(named, F.col("id") == F.col("node"), "left_semi")
    known = enrich(
        inner.withColumn("target", F.when(F.col("up") != F.col("id"), F.col("up"))),
        inner.select(F.col("id").alias("node"), F.lit(True).alias("exists")),
        {"target": "node"},
        ["exists"],
        keep="fact",
    )
    step = known.select(
        "id",
        F.when(F.col("exists"), F.col("target")).otherwise(F.col("id")).alias("ptr"),
        F.when(F.col("exists"), 1).otherwise(0).cast("long").alias("depth"),
        F.coalesce(~F.col("exists"), F.lit(True)).alias("done"),
    )
    written = cut_lineage(step, "roots")
    at_root, moving = [written.filter("done")], written.filter("not done")
    left = moving.count()
    while left:
        target = reduce(DataFrame.unionByName, [*at_root, moving]).select(
            F.col("id").alias("node"),
            F.col("ptr").alias("far"),
            F.col("depth").alias("more"),
            F.col("done").alias("at_root"),
        )
        moved = moving.join(target, F.col("ptr") == F.col("node")).select(
            "id",
            F.col("far").alias("ptr"),
            (F.col("depth") + F.col("more")).alias("depth"),
            F.col("at_root").alias("done"),
        )
        written = cut_lineage(moved, "roots")
        at_root.append(written.filter("done"))
        moving = written.filter("not done")
        remaining = moving.count()
        if remaining == left:
            break  # whatever is still moving runs in circles
        left = remaining
    found = reduce(DataFrame.unionByName, [*at_root, moving]).select(
        F.col("id").alias("node"),
        F.when(F.col("done"), F.col("ptr")).alias("root"),
        F.when(F.col("done"), F.col("depth")).alias("depth"),
        (~F.col("done")).alias("looped"),
    )
    is_inner = edges.join(found, F.col("id") == F.col("node"))
    leaves = edges.join(named, F.col("id") == F.col("node"), "left_anti")
    target = F.when(F.col("up") != F.col("id"), F.col("up"))
    below = leaves.withColumn("target", target).join(found, F.col("target") == F.col("node"), "left")
    hit = F.col("node").isNotNull()
    return is_inner.select(
        F.col("id").alias(key), "root", "depth", F.col("looped").alias("in_cycle")
    ).unionByName(
        below.select(
            F.col("id").alias(key),
            F.when(hit, F.col("root")).otherwise(F.col("id")).alias("root"),
            F.when(hit, F.col("depth") + 1).otherwise(F.lit(0)).alias("depth"),
            F.coalesce(F.col("looped"), F.lit(False)).alias("in_cycle"),
        )
    )


def ancestors(df: DataFrame, key: str, parent: str, max_depth: int) -> DataFrame:
    """Every ancestor up to ``max_depth`` steps above: ``(key, ancestor, distance, repeats)``.

    Parents that are null, missing from ``df`` or the row itself are none.  A key may
    have several rows with different parents; an ancestor met on several ways has its
    shortest distance.  ``repeats`` tells that it was met more than once, which in a tree
    of single parents happens on and below a cycle only; there a row can be its own
    ancestor.

    The reach doubles: pairs whose distance is the reach so far meet all pairs above
    them, so every new pair arises once and only new pairs are written.  At most rows x
    ``max_depth`` pairs leave for single parents.
    """
    if max_depth < 1:
        raise ValueError("max_depth must be at least 1")
    edges = df.select(F.col(key).alias("id"), F.col(parent).alias("up")).filter("up <> id").distinct()
    known = df.select(F.col(key).alias("up")).distinct()
    pairs = [cut_lineage(edges.join(known, "up", "left_semi").select("id", "up", F.lit(1).alias("far")), "ancestors")]
    reach = 1
    while reach < max_depth:
        above = reduce(DataFrame.unionByName, pairs).select(
            F.col("id").alias("up"), F.col("up").alias("top"), F.col("far").alias("more")
        )
        edge = pairs[-1].filter(F.col("far") == reach)
        new = edge.join(above.filter(F.col("more") <= max_depth - reach), "up").select(
            "id", F.col("top").alias("up"), (F.col("far") + F.col("more")).alias("far")
        )
        written = cut_lineage(new.distinct(), "ancestors")
        if written.isEmpty():
            break
        pairs.append(written)
        reach *= 2
    found = reduce(DataFrame.unionByName, pairs).groupBy("id", "up")
    return found.agg(F.min("far").alias("distance"), F.count(F.lit(1)).alias("met")).select(
        F.col("id").alias(key), F.col("up").alias("ancestor"), "distance", (F.col("met") > 1).alias("repeats")
    )

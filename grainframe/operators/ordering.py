"""Global order without a single-task window.

A window without partition columns moves every row to one task.  Here the rows
are range-partitioned by the order, numbered inside their partition and
written once; positions of earlier partitions are then added as offsets.  The
only thing brought together is one summary row per partition.

Orders are ``(column, "asc" | "desc")`` pairs and put nulls last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from grainframe.session import cut_lineage

Order = Sequence[tuple[str, str]]

# monotonically_increasing_id keeps the partition in the upper bits, the row below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def sort_columns(order: Order) -> list[Column]:
    """Sort expressions for an order, nulls last in both directions."""
    for _, way in order:
        if way not in ("asc", "desc"):
            raise ValueError(f"direction must be asc or desc, not {way!r}")
    return [
        F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in order
    ]


def _spread(df: DataFrame, order: Order) -> DataFrame:
    """Rows in range partitions with ``__part`` and ``__pos`` (0-based), written once.

    Writing fixes the partition bounds: they come from a sample, so a second
    evaluation could cut elsewhere.
    """
    columns = sort_columns(order)
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = ranged.withColumn("__id", F.monotonically_increasing_id()).withColumns(
        {
            "__part": F.shiftright("__id", _ROW_BITS).cast("int"),
            "__pos": F.col("__id").bitwiseAND(F.lit(_ROW_MASK)),
        }
    )
    return cut_lineage(placed.drop("__id"), "ordered")


def _before(parts: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over earlier partitions; ``parts`` has one row per partition."""
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(out, F.coalesce(F.sum(value).over(earlier), F.lit(0)))


def row_id(
    df: DataFrame, order: Order, out: str = "row_id", tie_break: Sequence[str] = ()
) -> DataFrame:
    """1-based row number along ``order``.

    ``tie_break`` (a unique key) makes the order total: numbers are then the same
    on every run, and rows with one order value may lie in several partitions.
    """
    spread = _spread(df, [*order, *[(c, "asc") for c in tie_break]])
    sizes = spread.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = _before(sizes, "__rows", "__offset").select("__part", "__offset")
    joined = spread.join(F.broadcast(offsets), "__part")
    return joined.withColumn(out, F.col("__offset") + F.col("__pos") + 1).drop(
        "__part", "__pos", "__offset"
    )


def global_rank(
    df: DataFrame, order: Order, out: str = "rank", tie_break: Sequence[str] = ()
) -> DataFrame:
    """SQL ``RANK`` over all rows.

    ``tie_break`` (a unique key) lets rows with equal order values lie in
    several partitions.  A tie group that crosses a border takes the rank of
    its first row, which the partition summaries hold.  Order columns that are
    sums of doubles should come from a written frame (``cut_lineage``).
    """
    spread = _spread(df, [*order, *[(c, "asc") for c in tie_break]])
    local = Window.partitionBy("__part").orderBy(*sort_columns(order))
    ranked = spread.withColumn("__local", F.rank().over(local))
    key = F.struct(*[c for c, _ in order])
    parts = ranked.groupBy("__part").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.max_by(key, "__pos").alias("__last_key"),
        F.max_by("__local", "__pos").alias("__last_local"),
    )
    parts = _before(parts, "__rows", "__offset")
    offsets = parts.select("__part", "__offset")
    carried = parts.groupBy("__last_key").agg(
        F.min(F.col("__offset") + F.col("__last_local")).alias("__carried")
    )
    joined = ranked.join(F.broadcast(offsets), "__part")
    joined = joined.join(F.broadcast(carried), key == F.col("__last_key"), "left")
    rank = F.least(F.col("__offset") + F.col("__local"), F.col("__carried"))
    return joined.withColumn(out, rank).drop(
        "__part", "__pos", "__local", "__offset", "__last_key", "__carried"
    )


def running_total(df: DataFrame, by: str, name: str, measure: Column, out: str) -> DataFrame:
    """A measure per value of ``by`` and its running sum along ``by``.

    Aggregating first makes the order unique, so the running sum has no peers
    and equals SQL's default frame: null measures add nothing, and the total is
    null until the first value that is not.
    """
    groups = df.groupBy(by).agg(measure.alias(name))
    spread = _spread(groups, [(by, "asc")])
    upto = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    local = spread.withColumns(
        {"__local": F.sum(name).over(upto), "__values": F.count(name).over(upto)}
    )
    parts = spread.groupBy("__part").agg(F.sum(name).alias("__sum"), F.count(name).alias("__n"))
    offsets = _before(_before(parts, "__sum", "__offset"), "__n", "__seen")
    joined = local.join(F.broadcast(offsets.select("__part", "__offset", "__seen")), "__part")
    total = F.col("__offset") + F.coalesce("__local", F.lit(0))
    return joined.withColumn(out, F.when(F.col("__values") + F.col("__seen") > 0, total)).drop(
        "__part", "__pos", "__local", "__values", "__offset", "__seen"
    )

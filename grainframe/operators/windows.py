"""Entity ranks and windows along an order; both see aggregated rows, never facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from grainframe.functions.conditions import ratio
from grainframe.operators.ordering import Order, global_rank, row_id, sort_columns
from grainframe.session import cut_lineage


def rank_entities(
    df: DataFrame,
    entity: Sequence[str],
    measures: Mapping[str, Column],
    ranks: Mapping[str, Order],
    having: Column | None = None,
) -> DataFrame:
    """One row per entity with measures and one ``RANK`` column per order in ``ranks``.

    The number of entities may grow with the data, so each rank is taken over
    range partitions (see ``ordering``).  Entity totals are written once before:
    they decide the partition, so they must not be summed again in another order.
    """
    out = df.groupBy(*entity).agg(*[m.alias(n) for n, m in measures.items()])
    if having is not None:
        out = out.filter(having)
    out = cut_lineage(out, "entities")
    for name, order in ranks.items():
        out = global_rank(out, order, name, tie_break=entity)
    return out


def top_entities(
    df: DataFrame, entity: str, measure: Column, n: int, order: str = "desc", rows: DataFrame | None = None
) -> DataFrame:
    """All rows of the entities whose ``RANK`` by ``measure`` is at most ``n``.

    The entity totals are written once.  The n-th best value is the cut-off (a
    top-k, no full sort) and every entity at or above it stays, ties included.
    """
    groups = df.groupBy(entity).agg(measure.alias("__m"))
    totals = cut_lineage(groups.filter("__m is not null"), "entities")
    best = totals.orderBy(*sort_columns([("__m", order)])).limit(n)
    if order == "desc":
        chosen = totals.filter(F.col("__m") >= best.agg(F.min("__m")).scalar())
    else:
        chosen = totals.filter(F.col("__m") <= best.agg(F.max("__m")).scalar())
    side = chosen.select(F.col(entity).alias("__entity"))
    rows = df if rows is None else rows
    return rows.join(side, F.col(entity) == F.col("__entity"), "left_semi")


#: Rows per block of a window along an order.
BLOCK_ROWS = 100_000


def _blocks(
    groups: DataFrame, order: str, within: Sequence[str], reach: int, block_rows: int
) -> DataFrame:
    """Rows in blocks along the order, each block with the ``reach`` rows before it.

    A negative ``reach`` takes the rows after it.  Adds ``__at``, ``__block`` and
    ``__own``, which is false for the borrowed rows.
    """
    size = max(block_rows, abs(reach))
    placed = row_id(groups, [(c, "asc") for c in (*within, order)], "__at")
    home, place = F.floor(F.col("__at") / size), F.pmod("__at", F.lit(size))
    if reach >= 0:
        lent, other = place >= size - reach, home + 1
    else:
        lent, other = place < -reach, home - 1
    blocks = F.when(lent, F.array(home, other)).otherwise(F.array(home))
    return placed.withColumn("__block", F.explode(blocks)).withColumn("__own", F.col("__block") == home)


def lagged(
    groups: DataFrame,
    measure: str,
    order: str,
    n: int = 1,
    within: Sequence[str] = (),
    out: str = "previous",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Value ``n`` rows back (ahead if negative) and growth in percent.

    ``groups`` has one row per ``within`` group and value of ``order``, of which there
    may be any number: windows see blocks of ``block_rows`` rows and ``n`` border rows.
    A period without a row is not counted: :func:`fill_periods` first where the growth
    must be per period.
    """
    along = Window.partitionBy("__block", *within).orderBy("__at")
    change = ratio((F.col(measure) - F.col(out)) * 100, F.col(out))
    shifted = _blocks(groups, order, within, n, block_rows).withColumn(out, F.lag(measure, n).over(along))
    own = shifted.filter("__own").drop("__at", "__block", "__own")
    return own.withColumn(f"{measure}_growth_pct", change)


def moving_avg(
    groups: DataFrame,
    measure: str,
    order: str,
    n: int,
    within: Sequence[str] = (),
    out: str = "moving_avg",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean over the current and the ``n - 1`` preceding rows (see ``lagged``)."""
    frame = Window.partitionBy("__block", *within).orderBy("__at").rowsBetween(-(n - 1), 0)
    means = _blocks(groups, order, within, n - 1, block_rows).withColumn(out, F.avg(measure).over(frame))
    return means.filter("__own").drop("__at", "__block", "__own")



PERIODS = ("hour", "day", "week", "month", "quarter", "year")


def fill_periods(
    groups: DataFrame, order: str, unit: str, within: Sequence[str] = (), fill: Mapping[str, object] | None = None
) -> DataFrame:
    """``groups`` with a row for every ``unit`` between the first and last period of each ``within`` group.

    ``order`` is a date or timestamp cut to the unit; ``groups`` has one row per group and
    period.  Added rows hold ``fill`` (null where it names no value).  Rows without a
    period stay as they are, a group without any period gets none, and groups of null
    are groups.  Only each group's ends are brought together; the periods between them
    arise per group and those that exist are taken out by an anti join.
    """
    if unit not in PERIODS:
        raise ValueError(f"unit must be one of {', '.join(PERIODS)}, not {unit!r}")
    step = F.expr("interval 3 month" if unit == "quarter" else f"interval 1 {unit}")
    ends = groups.groupBy(*within).agg(F.min(order).alias("__first"), F.max(order).alias("__last"))
    names = {c: f"__g{i}" for i, c in enumerate(within)}
    spine = ends.where("__first is not null").select(
        *[F.col(c).alias(n) for c, n in names.items()],
        F.explode(F.sequence("__first", "__last", step)).alias("__at"),
    )
    same = F.col("__at") == F.col(order)
    for c, n in names.items():
        same = same & F.col(n).eqNullSafe(F.col(c))
    missing = spine.join(groups.select(order, *within), same, "left_anti")
    kinds, given = dict(groups.dtypes), fill or {}
    added = missing.select(
        *[
            F.col("__at").alias(c) if c == order
            else F.col(names[c]).alias(c) if c in names
            else F.lit(given.get(c)).cast(kinds[c]).alias(c)
            for c in groups.columns
        ]
    )
    return groups.unionByName(added)

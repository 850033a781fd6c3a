"""Point-in-polygon joins through grid cells of several sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from grainframe.functions.geometry import edges_around, ring_bounds, ring_edges, rings_bounds, rings_edges

# Levels below the one whose cells are as wide as the polygon's box.
_FINER = 2


def _cell(value: Column, level: Column, cell: float) -> Column:
    return F.floor(value / (F.lit(cell) * F.pow(F.lit(2.0), level))).cast("long")


# Part of a cell by which it is taken larger, so that rounding cannot put a point outside it.
_SLACK = 1e-6


def _facing(edges: Column, cx: Column, cy: Column, width: Column) -> Column:
    """Edges that a ray to the right from a point of the cell can meet."""
    low, high, left = (cy - _SLACK) * width, (cy + 1 + _SLACK) * width, (cx - _SLACK) * width
    return F.filter(
        edges,
        lambda e: (F.greatest(e.a.y, e.b.y) >= low) & (F.least(e.a.y, e.b.y) <= high) & (F.greatest(e.a.x, e.b.x) >= left),
    )


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    cell: float,
    point_key: str | None = None,
    x: str = "x",
    y: str = "y",
    ring: str = "ring",
    how: str = "inner",
) -> DataFrame:
    """Points with the columns of every polygon that contains them (planar).

    A polygon is filed at the level where its box is at most four cells wide
    and high, so it touches at most 25 cells however large it is, and the join
    is an equi join on cells with a box and a ring test.  Points look only at
    levels that hold polygons.  ``cell`` is the width of the finest cells; a
    size near the smallest polygon works best.  ``ring`` is one ring or an array of
    rings, with parts and holes.  A cell keeps the edges that a ray from it to the right
    can meet; cells that no edge touches are known to lie inside, and then need no
    ring test, or outside, and are left out.  The two sides share no column names.  ``how="left"`` keeps points without a polygon and needs a unique
    ``point_key``.
    """
    several = isinstance(polygons.schema[ring].dataType.elementType, ArrayType)
    box, edges = (rings_bounds, rings_edges) if several else (ring_bounds, ring_edges)
    bounds = polygons.withColumn("__box", box(F.col(ring)))
    span = F.greatest(
        F.col("__box.x1") - F.col("__box.x0"), F.col("__box.y1") - F.col("__box.y0"), F.lit(cell)
    )
    wanted = F.ceil(F.log2(span / F.lit(cell))) - _FINER
    level = F.greatest(wanted, F.lit(0)).cast("int")
    filed = bounds.withColumn("__level", level)

    def touched(low: str, high: str) -> Column:
        return F.sequence(
            _cell(F.col(low), F.col("__level"), cell), _cell(F.col(high), F.col("__level"), cell)
        )

    cells = filed.withColumn("__cx", F.explode(touched("__box.x0", "__box.x1"))).withColumn(
        "__cy", F.explode(touched("__box.y0", "__box.y1"))
    )
    cells = cells.withColumnRenamed("__level", "__poly_level")
    width = F.lit(cell) * F.pow(F.lit(2.0), F.col("__poly_level"))
    cells = cells.withColumns({"__edges": edges(F.col(ring)), "__width": width})
    cells = cells.withColumn("__edges", _facing(F.col("__edges"), F.col("__cx"), F.col("__cy"), F.col("__width"))).drop(ring)
    middle = [(F.col(c) + 0.5) * F.col("__width") for c in ("__cx", "__cy")]
    touched_by = F.exists("__edges", lambda e: F.least(e.a.x, e.b.x) <= (F.col("__cx") + 1 + _SLACK) * F.col("__width"))
    cells = cells.withColumns({"__whole": ~touched_by, "__middle": edges_around(F.col("__edges"), *middle)})
    cells = cells.where("not __whole or __middle").withColumn(
        "__edges", F.when(~F.col("__whole"), F.col("__edges"))
    ).drop("__middle", "__width")

    levels = filed.agg(F.array_sort(F.collect_set("__level"))).scalar()
    spots = points.withColumn("__level", F.explode(levels))
    inside = spots.join(
        cells,
        (F.col("__level") == F.col("__poly_level"))
        & (_cell(F.col(x), F.col("__level"), cell) == F.col("__cx"))
        & (_cell(F.col(y), F.col("__level"), cell) == F.col("__cy"))
        & F.col(x).between(F.col("__box.x0"), F.col("__box.x1"))
        & F.col(y).between(F.col("__box.y0"), F.col("__box.y1"))
        & (F.col("__whole") | edges_around(F.col("__edges"), F.col(x), F.col(y))),
    )
    found = [c for c in polygons.columns if c != ring]
    if how == "inner":
        return inside.select(*points.columns, *found)
    hits = inside.select(F.col(point_key).alias("__point"), *found)
    return points.join(hits, F.col(point_key) == F.col("__point"), "left").drop("__point")

"""Planar polygon measures over rings, ``array<struct<x,y>>`` without a closing point.

A polygon of several rings, ``array`` of rings, may have parts and holes, and parts within
holes.  A point is inside by the even-odd rule over all rings, whatever their order and
direction.  Rings of one polygon do not cross.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_edges(ring: Column) -> Column:
    """The ring paired with itself moved by one point: ``struct<a, b>`` per edge."""
    turned = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(items: Column, term) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + term(e))


def _cross(edge: Column) -> Column:
    a, b = edge.getField("a"), edge.getField("b")
    return a.getField("x") * b.getField("y") - b.getField("x") * a.getField("y")


def ring_area(ring: Column) -> Column:
    """Planar area (shoelace), always positive."""
    return F.abs(_sum(ring_edges(ring), _cross)) / 2


def ring_centroid(ring: Column) -> Column:
    """Planar centroid ``struct<x,y>``; null for rings without area."""
    edges = ring_edges(ring)
    twice = _sum(edges, _cross)

    def axis(name: str) -> Column:
        moment = _sum(
            edges,
            lambda e: (e.getField("a").getField(name) + e.getField("b").getField(name)) * _cross(e),
        )
        return F.try_divide(moment, twice * 3)

    return F.struct(axis("x").alias("x"), axis("y").alias("y"))


def ring_bounds(ring: Column) -> Column:
    """Bounding box ``struct<x0,y0,x1,y1>``."""
    xs = F.transform(ring, lambda p: p.getField("x"))
    ys = F.transform(ring, lambda p: p.getField("y"))
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def edges_around(edges: Column, x: Column, y: Column) -> Column:
    """True if the point lies inside the edges of a ring (even-odd rule).

    Edges are half open, so a point on a border shared by two polygons belongs
    to exactly one of them.
    """

    def crosses(edge: Column) -> Column:
        a, b = edge.getField("a"), edge.getField("b")
        spans = (a.getField("y") > y) != (b.getField("y") > y)
        at = a.getField("x") + F.try_divide(
            (y - a.getField("y")) * (b.getField("x") - a.getField("x")),
            b.getField("y") - a.getField("y"),
        )
        return spans & (x < at)

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """``edges_around`` for a ring; prepare the edges once where many points are tested."""
    return edges_around(ring_edges(ring), x, y)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Ring of an axis-parallel box."""

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def rings_edges(rings: Column) -> Column:
    """Edges of all rings; with :func:`edges_around` the even-odd test of the polygon."""
    return F.flatten(F.transform(rings, ring_edges))


def in_rings(rings: Column, x: Column, y: Column) -> Column:
    """True if the point lies inside a polygon of several rings."""
    return edges_around(rings_edges(rings), x, y)


def rings_bounds(rings: Column) -> Column:
    """Bounding box of all rings."""
    return ring_bounds(F.flatten(rings))


def _ring_signs(rings: Column) -> Column:
    """1 for a ring that bounds a part, -1 for a hole: by how many other rings hold its first point."""

    def sign(ring: Column, i: Column) -> Column:
        start = F.get(ring, F.lit(0))
        holders = F.transform(
            rings, lambda other, j: (i != j) & in_ring(other, start.getField("x"), start.getField("y"))
        )
        return F.when(F.aggregate(holders, F.lit(False), lambda odd, h: odd != h), -1.0).otherwise(1.0)

    return F.transform(rings, sign)


def rings_area(rings: Column) -> Column:
    """Planar area of a polygon of several rings, holes taken off."""
    areas = F.zip_with(rings, _ring_signs(rings), lambda ring, sign: ring_area(ring) * sign)
    return F.aggregate(areas, F.lit(0.0), lambda total, a: total + a)


def rings_centroid(rings: Column) -> Column:
    """Planar centroid ``struct<x,y>`` of a polygon of several rings; null without area."""
    weighed = F.zip_with(
        rings,
        _ring_signs(rings),
        lambda ring, sign: F.struct((ring_area(ring) * sign).alias("a"), ring_centroid(ring).alias("c")),
    )
    total = F.aggregate(weighed, F.lit(0.0), lambda sum_, w: sum_ + w.getField("a"))

    def axis(name: str) -> Column:
        moment = F.aggregate(
            weighed,
            F.lit(0.0),
            lambda sum_, w: sum_ + F.coalesce(w.getField("a") * w.getField("c").getField(name), F.lit(0.0)),
        )
        return F.try_divide(moment, total)

    return F.struct(axis("x").alias("x"), axis("y").alias("y"))

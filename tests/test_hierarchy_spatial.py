"""Hierarchies and polygons against brute force."""

import math
import random

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from grainframe.functions import box_ring, in_ring, in_rings, ring_area, ring_centroid, rings_area, rings_centroid
from grainframe.operators import ancestors, points_in_polygons, root_of


def _roots(parents):
    """Root and depth by walking; None where the walk runs in a circle."""
    out = {}
    for key in parents:
        seen, at = [], key
        while True:
            up = parents[at]
            if up is None or up == at or up not in parents:
                out[key] = (at, len(seen), False)
                break
            if at in seen:
                out[key] = (None, None, True)
                break
            seen.append(at)
            at = up
    return out


def _check(spark, parents):
    df = spark.createDataFrame(list(parents.items()), "id long, up long")
    got = {r["id"]: (r["root"], r["depth"], r["in_cycle"]) for r in root_of(df, "id", "up").collect()}
    assert got == _roots(parents)


def test_deep_chain_two_roots_and_a_cycle(spark):
    parents = {1: None, **{i: i - 1 for i in range(2, 151)}}
    parents.update({1000: None, 1001: 1000, 1002: 1000})
    parents.update({2000: 2001, 2001: 2002, 2002: 2000, 2003: 2000, 2004: 2003})
    parents.update({3000: 3000, 3001: 3000, 4000: 9999})
    _check(spark, parents)


def test_random_forest(spark):
    rng = random.Random(3)
    _check(spark, {i: rng.choice([None, rng.randrange(i)]) if i else None for i in range(400)})


def test_star_and_flat(spark):
    _check(spark, {0: None, **{i: 0 for i in range(1, 300)}})
    _check(spark, {i: None for i in range(10)})


RING = "array<struct<x:double,y:double>>"


def test_ring_measures(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    triangle = [(0.0, 0.0), (0.0, 3.0), (3.0, 0.0)]
    line = [(0.0, 0.0), (1.0, 1.0)]
    df = spark.createDataFrame([(1, square), (2, triangle), (3, line)], f"i int, ring {RING}")
    got = df.select("i", ring_area(F.col("ring")).alias("a"), ring_centroid(F.col("ring")).alias("c"))
    found = {r["i"]: (r["a"], r["c"]["x"], r["c"]["y"]) for r in got.collect()}
    assert found == {1: (16.0, 2.0, 2.0), 2: (4.5, 1.0, 1.0), 3: (0.0, None, None)}


def test_shared_border_belongs_to_one_box(spark):
    boxes = spark.createDataFrame([("left", 0), ("right", 2)], "name string, x0 int").select(
        "name", box_ring(F.col("x0"), F.lit(0), F.col("x0") + 2, F.lit(2)).alias("ring")
    )
    spots = [(x / 2, y / 2) for x in range(9) for y in range(5)]
    points = spark.createDataFrame(spots, "x double, y double")
    got = rows(points_in_polygons(points, boxes, cell=0.5), "x", "y", "name")
    expected = [(x, y, "left" if x < 2 else "right") for x, y in spots if x < 4 and y < 2]
    assert got == sorted(expected)


def _inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
            hit = not hit
    return hit


def test_polygons_of_all_sizes_equal_brute_force(spark):
    """Polygons from tiny to huge, some concave, one far larger than the cells."""
    rng = random.Random(11)
    polygons = []
    for i in range(40):
        size = rng.choice([0.3, 2, 15, 90])
        cx, cy = rng.uniform(-60, 60), rng.uniform(-60, 60)
        ring = [(cx + rng.uniform(-size, size), cy + rng.uniform(-size, size)) for _ in range(6)]
        polygons.append((i, ring))
    spots = [(k, rng.uniform(-80, 80), rng.uniform(-80, 80)) for k in range(500)]
    points = spark.createDataFrame(spots, "k int, x double, y double")
    polys = spark.createDataFrame(polygons, f"poly int, ring {RING}")
    expected = [(k, i) for k, x, y in spots for i, ring in polygons if _inside(ring, x, y)]
    inner = points_in_polygons(points, polys, cell=0.5)
    assert rows(inner, "k", "poly") == sorted(expected)
    left = rows(points_in_polygons(points, polys, 0.5, "k", how="left"), "k", "poly")
    lonely = [(k, None) for k, _, _ in spots if k not in {e[0] for e in expected}]
    assert sorted(left, key=str) == sorted(expected + lonely, key=str)
    assert "CartesianProduct" not in plan_of(inner) and "NestedLoop" not in plan_of(inner)


def _box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def test_rings_with_holes_and_parts(spark):
    """Two parts, one with a hole that holds an island; rings in any order and direction."""
    hole = _box(2.0, 2.0, 8.0, 8.0)[::-1]
    rings = [hole, _box(0.0, 0.0, 10.0, 10.0), _box(20.0, 0.0, 24.0, 2.0)[::-1], _box(4.0, 4.0, 6.0, 6.0)]
    flat = [[(0.0, 0.0), (1.0, 1.0)]]
    df = spark.createDataFrame([(1, rings), (2, flat), (3, [_box(0.0, 0.0, 2.0, 2.0)])], f"i int, rings array<{RING}>")
    got = df.select("i", rings_area(F.col("rings")).alias("a"), rings_centroid(F.col("rings")).alias("c"))
    found = {r["i"]: (r["a"], r["c"]["x"], r["c"]["y"]) for r in got.collect()}
    area = 100 - 36 + 8 + 4
    assert found[1][0] == area and found[2] == (0.0, None, None) and found[3] == (4.0, 1.0, 1.0)
    assert found[1][1:] == pytest.approx(((500 - 180 + 22 * 8 + 20) / area, (500 - 180 + 8 + 20) / area))
    spots = [(x / 2, y / 2) for x in range(-2, 52) for y in range(-2, 24)]

    def held(x, y):
        within = [x0 <= x < x1 and y0 <= y < y1 for x0, y0, x1, y1 in ((2, 2, 8, 8), (0, 0, 10, 10), (20, 0, 24, 2), (4, 4, 6, 6))]
        return sum(within) % 2 == 1

    points = spark.createDataFrame(spots, "x double, y double")
    one = df.where("i = 1")
    expected = sorted(p for p in spots if held(*p))
    for cell in (0.3, 1.0, 7.0, 100.0):
        assert rows(points_in_polygons(points, one, cell, ring="rings"), "x", "y") == expected
    tested = points.crossJoin(one).where(in_rings(F.col("rings"), F.col("x"), F.col("y")))
    assert rows(tested, "x", "y") == expected


def test_random_ring_sets_equal_brute_force(spark):
    rng = random.Random(7)
    polygons = []
    for i in range(25):
        size, rings = rng.choice([0.5, 5, 60]), []
        cx, cy = rng.uniform(-50, 50), rng.uniform(-50, 50)
        for k in range(rng.choice([1, 2, 3])):  # each ring inside the one before
            shrink = size / (k + 1)
            angles = sorted(rng.uniform(0, 6.283) for _ in range(7))
            rings.append([(cx + shrink * math.cos(a), cy + shrink * math.sin(a)) for a in angles])
        polygons.append((i, rings))
    spots = [(k, rng.uniform(-70, 70), rng.uniform(-70, 70)) for k in range(600)]
    points = spark.createDataFrame(spots, "k int, x double, y double")
    polys = spark.createDataFrame(polygons, f"poly int, ring array<{RING}>")
    expected = [(k, i) for k, x, y in spots for i, rings in polygons if sum(_inside(r, x, y) for r in rings) % 2]
    assert rows(points_in_polygons(points, polys, cell=0.5), "k", "poly") == sorted(expected)


def test_in_ring_is_false_outside(spark):
    df = spark.createDataFrame([(5.0, 5.0), (1.0, 1.0)], "x double, y double")
    ring = box_ring(F.lit(0), F.lit(0), F.lit(2), F.lit(2))
    assert rows(df.select("x", in_ring(ring, F.col("x"), F.col("y")).alias("hit"))) == [(1.0, True), (5.0, False)]


def _ancestors(edges, known, most):
    """Shortest distance and whether met again, following every way."""
    out = {}
    for key in known:
        here = {key}
        for distance in range(1, most + 1):
            here = {u for k in here for u in edges.get(k, ()) if u is not None and u != k and u in known}
            for up in here:
                first, met = out.get((key, up), (distance, 0))
                out[key, up] = (first, met + 1)
    return {(k, a, d, n > 1) for (k, a), (d, n) in out.items()}


@pytest.mark.parametrize("most", [1, 2, 5, 8, 200])
def test_ancestors(spark, most):
    rng = random.Random(most)
    pairs = [(1, None), *[(i, i - 1) for i in range(2, 40)]]  # a chain
    pairs += [(100 + i, 100 + i // 3 if i else None) for i in range(60)]  # a tree, its root naming itself too
    pairs += [(200, 201), (201, 202), (202, 200), (203, 200), (204, 203)]  # below a cycle
    pairs += [(300, 999), (301, 300), (302, None), (302, None), (303, 302), (303, 302)]  # missing parent, repeated rows
    pairs += [(400 + i, 400 + rng.randrange(i)) for i in range(1, 12) for _ in range(2)] + [(400, None)]  # several parents
    edges = {}
    for k, u in pairs:
        edges.setdefault(k, set()).add(u)
    df = spark.createDataFrame([(k, u, "x") for k, u in pairs], "id long, up long, ancestor string")
    found = {tuple(r) for r in ancestors(df, "id", "up", most).collect()}
    assert found == _ancestors(edges, set(edges), most)
    assert ancestors(df.limit(0), "id", "up", most).count() == 0


def test_ancestors_need_a_depth(spark):
    with pytest.raises(ValueError):
        ancestors(spark.createDataFrame([(1, None)], "id long, up long"), "id", "up", 0)

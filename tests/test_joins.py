"""Which side survives, for matched, null, orphaned and unused keys."""

import pytest
from helpers import rows

from grainframe.operators import (
    align,
    bridge,
    combine_facts,
    count_rows,
    decode,
    drill_across,
    enrich,
    enrich_from_dim,
    has_match,
    keep_in,
    keep_not_in,
    link_all,
    with_parent,
)
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 10)], "id long, dim_id long")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(10, "used"), (20, "unused")], "dim_id long, name string")


MATCH = [(1, 10, "used"), (4, 10, "used")]
LOOSE = [(2, None, None), (3, 99, None)]
UNUSED = [(None, 20, "unused")]


@pytest.mark.parametrize(
    "keep, expected",
    [
        ("match", MATCH),
        ("fact", MATCH + LOOSE),
        ("dim", MATCH + UNUSED),
        ("all", MATCH + LOOSE + UNUSED),
    ],
)
def test_enrich_keeps(fact, dim, keep, expected):
    got = enrich(fact, dim, "dim_id", keep=keep)
    assert got.columns == ["id", "dim_id", "name"]
    assert set(rows(got)) == set(expected) and got.count() == len(expected)


def test_roles_do_not_clash(spark):
    flights = spark.createDataFrame([(1, "A", "B")], "id long, origin string, destination string")
    airports = spark.createDataFrame([("A", "Apt"), ("B", "Bpt")], "code string, city string")
    once = enrich(flights, airports, {"origin": "code"}, prefix="origin_")
    both = enrich(once, airports, {"destination": "code"}, prefix="destination_")
    assert rows(both, "origin_city", "destination_city") == [("Apt", "Bpt")]


def test_composite_key(spark):
    left = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, v string")
    right = spark.createDataFrame([(1, 2, "hit")], "a int, b int, w string")
    assert rows(enrich(left, right, ["a", "b"], keep="fact"), "v", "w") == [("x", None), ("y", "hit")]


def test_dim_rows_equal_dimension_count(fact, dim):
    got = enrich_from_dim(dim, fact, {"dim_id": "dim_id"}, {"n": count_rows(), "s": F.sum("id")}, ["n"])
    assert rows(got) == [(10, "used", 2, 5), (20, "unused", 0, None)]


def test_membership_ignores_nulls(fact, dim):
    assert rows(keep_in(fact, "dim_id", dim), "id") == [(1,), (4,)]
    assert rows(keep_not_in(fact, "dim_id", dim), "id") == [(3,)]
    with_null = dim.unionByName(dim.limit(1).withColumn("dim_id", F.lit(None).cast("long")))
    assert rows(keep_not_in(fact, "dim_id", with_null), "id") == [(3,)]


def test_has_match_never_multiplies(fact, spark):
    other = spark.createDataFrame([(10,), (10,), (None,)], "k long")
    got = has_match(fact, other, {"dim_id": "k"}, "hit")
    assert rows(got, "id", "hit") == [(1, True), (2, False), (3, False), (4, True)]


def test_decode_default(fact, dim):
    got = decode(fact, "dim_id", dim, "dim_id", "name", "label", "other")
    assert rows(got, "id", "label") == [(1, "used"), (2, "other"), (3, "other"), (4, "used")]


def test_link_all_keeps_left_columns(spark):
    left = spark.createDataFrame([(1, "left", 5)], "k int, name string, a int")
    right = spark.createDataFrame([(1, "right", 7)], "k int, name string, b int")
    got = link_all(left, right, ["k"])
    assert got.columns == ["k", "name", "a", "b"] and rows(got) == [(1, "left", 5, 7)]


def test_bridge_counts_pairs_once(spark):
    posts = spark.createDataFrame([(1, 10)], "post int, score int")
    tags = spark.createDataFrame([("a",), ("b",)], "tag string")
    links = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "p int, t string")
    assert rows(bridge(posts, links, tags.withColumn("x", F.lit(1)), {"p": "post"}, {"t": "tag"}), "t", "score") == [
        ("a", 10),
        ("b", 10),
    ]


def test_align_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert rows(align([a, b], ["k"])) == [("x", 2, None), ("y", None, 4), (None, 1, 3)]


def test_drill_across_totals_equal_separate_totals(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    got = drill_across(
        [
            (orders, F.year("o_orderdate"), {"orders": count_rows()}),
            (lines, F.year("l_shipdate"), {"lines": count_rows()}),
        ],
        "y",
    )
    totals = got.agg(F.sum("orders"), F.sum("lines")).first()
    assert tuple(totals) == (orders.count(), lines.count())


def test_combine_facts_keeps_one_sided_keys(spark):
    sales = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "k int, v int")
    returns = spark.createDataFrame([(2, 1), (3, 2)], "k int, v int")
    got = combine_facts([(sales, {"sold": F.sum("v")}), (returns, {"back": F.sum("v")})], ["k"])
    assert rows(got) == [(1, 11, None), (2, 7, 1), (3, None, 2)]


def test_direct_parent(spark):
    tree = spark.createDataFrame([(1, None, "root"), (2, 1, "leaf"), (3, 9, "lost")], "id int, up int, n string")
    assert rows(with_parent(tree, "id", "up", ["n"]), "id", "parent_n") == [
        (1, None),
        (2, "root"),
        (3, None),
    ]

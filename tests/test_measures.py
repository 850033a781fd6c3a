"""Grain rules, percentages, labels and nested results."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from grainframe.functions import calc_percent, only_if, ratio
from grainframe.operators import (
    agg_by,
    agg_native,
    agg_of_agg,
    collect_label,
    count_keys,
    count_owners,
    count_rows,
    headline,
    latest,
    nest,
    nest_flat,
    pct_of_parent,
    pct_of_total,
    regrain,
    symmetric_measures,
    with_total,
)


@pytest.fixture(scope="module")
def flights(spark):
    data = [(1, "N", 7, 100), (2, "N", 7, 100), (3, "S", 8, 50), (4, "S", None, None)]
    return spark.createDataFrame(data, "id int, dest string, plane int, seats int")


@pytest.fixture(scope="module")
def planes(spark):
    return spark.createDataFrame([(7, 100), (8, 50)], "plane int, seats int")


def test_dimension_attribute_counts_once_per_key(flights, planes):
    got = agg_native(flights.drop("seats"), ["dest"], planes, ("plane", "plane"), {"s": F.sum("seats")})
    assert rows(got) == [("N", 100), ("S", 50)]


def test_regrain_counts_once_per_fact(flights):
    got = regrain(flights, ["dest"], ["id"], {"x": F.max("seats")}, {"s": F.sum("x")})
    assert rows(got) == [("N", 200), ("S", 50)]


def test_facts_are_not_deduplicated(spark):
    twice = spark.createDataFrame([(1, 1, 5), (1, 1, 5)], "k int, line int, v int")
    assert headline(twice, {"s": F.sum("v"), "n": count_rows()}).first()["s"] == 10


def test_key_and_owner_counts(flights):
    got = flights.agg(
        count_keys("plane").alias("planes"),
        count_owners("seats", "id").alias("owners"),
        count_rows().alias("n"),
    ).first()
    assert tuple(got) == (2, 3, 4)


def test_agg_by_repeats_and_matches_nulls(flights):
    got = agg_by(flights, {"n": count_rows()}, ["plane"])
    assert rows(got, "id", "n") == [(1, 2), (2, 2), (3, 1), (4, 1)]


def test_with_total_over_unfiltered_source(flights):
    south = flights.filter("dest = 'S'")
    got = with_total(south, {"top": F.max("seats"), "n": count_rows()}, source=flights)
    assert rows(got, "id", "top", "n") == [(3, 100, 4), (4, 100, 4)]


def test_latest(flights):
    assert rows(latest(flights, "seats"), "id") == [(1,), (2,)]


def test_percentages_add_up(flights):
    total = pct_of_total(flights, ["dest"], "n", count_rows(), "share")
    assert rows(total) == [("N", 2, 0.5), ("S", 2, 0.5)]
    parent = pct_of_parent(flights, ["plane"], ["dest"], {"n": (count_rows(), "share")})
    assert rows(parent, "dest", "plane", "share") == [("N", 7, 1.0), ("S", 8, 0.5), ("S", None, 0.5)]


def test_agg_of_agg(flights):
    got = agg_of_agg(flights, ["plane"], {"n": count_rows()}, [], {"m": F.max("n")})
    assert rows(got) == [(2,)]


def test_ratio_has_no_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a int, b int")
    got = df.select(ratio(F.col("a"), F.col("b")).alias("r"), calc_percent(F.col("a"), F.col("b"), 1).alias("p"))
    assert rows(got) == [(0.25, 0.3), (None, None), (None, None)]


def test_only_if_feeds_aggregates(flights):
    got = flights.agg(count_keys(only_if(F.col("id"), F.col("seats") > 60)).alias("n"))
    assert rows(got) == [(2,)]


@pytest.fixture(scope="module")
def owners(spark):
    data = [("g", v) for v in "abcdef" for _ in range(3)] + [("h", "z"), ("h", "y"), (None, "q"), ("i", None)]
    return spark.createDataFrame(data, "grp string, v string")


def test_label_limit(owners):
    got = collect_label(owners, ["grp"], "v", "label", limit=4)
    assert rows(got) == [("g", "Many (6)"), ("h", "y, z"), (None, "q")]
    assert rows(collect_label(owners, ["grp"], "v", "label", limit=6))[0] == ("g", "a, b, c, d, e, f")


def test_label_without_limit(owners):
    assert rows(collect_label(owners, ["grp"], "v", "label"))[0] == ("g", "a, b, c, d, e, f")


def test_nest_sorts_filters_and_takes_groups_of_any_size(spark, owners):
    got = nest(owners, ["grp"], ["v"], {"n": count_rows()}, "items", ["n"], having=F.col("n") > 1)
    items = got.filter("grp = 'g'").first()["items"]
    assert [tuple(i) for i in items] == [(3, v) for v in "fedcba"]
    many = spark.range(100_002).selectExpr("'g' AS grp", "id AS v")
    whole = nest(many, ["grp"], ["v"], {"n": count_rows()}, "items", ["n"])
    assert whole.select(F.size("items")).first()[0] == 100_002
    assert nest_flat(many, ["grp"], ["v"], {"n": count_rows()}).count() == 100_002


def test_symmetric_measures(spark):
    games = spark.createDataFrame([(1, 2), (3, None)], "home_pts int, away_pts int")
    measures = symmetric_measures(["pts"], ["home", "away"])
    assert rows(games.agg(*[m.alias(n) for n, m in measures.items()])) == [(4, 2, 6)]


def test_groups_add_up_to_headline(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    total = headline(lines, {"q": F.sum("l_quantity")}).first()["q"]
    parts = lines.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q")).agg(F.sum("q")).first()[0]
    assert total == parts

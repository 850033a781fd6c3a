"""Global ranks, row numbers and running totals against plain windows."""

import random

import pytest
from helpers import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from grainframe.operators import (
    global_rank,
    lagged,
    moving_avg,
    rank_entities,
    row_id,
    running_total,
    top_entities,
    topk,
    union_sides,
)


@pytest.fixture(scope="module")
def scores(spark):
    """A third of the entities share one score, so its tie group crosses partitions."""
    rng = random.Random(7)
    data = [(i, 50 if i % 3 == 0 else rng.randint(0, 99), rng.choice([None, 1, 2])) for i in range(3000)]
    return spark.createDataFrame(data, "id int, score int, grp int").repartition(8)


@pytest.mark.parametrize("way", ["asc", "desc"])
def test_rank_with_hot_ties(scores, way):
    key = F.col("score").desc() if way == "desc" else F.col("score")
    expected = scores.withColumn("rank", F.rank().over(Window.orderBy(key)).cast("long"))
    got = global_rank(scores, [("score", way)], tie_break=["id"])
    assert rows(got, "id", "score", "rank") == rows(expected, "id", "score", "rank")


def test_tie_group_really_crosses_partitions(spark, scores):
    from grainframe.operators.ordering import _spread

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = _spread(scores, [("score", "asc"), ("id", "asc")])
        assert spread.filter("score = 50").select("__part").distinct().count() > 1
        expected = scores.withColumn("rank", F.rank().over(Window.orderBy("score")).cast("long"))
        got = global_rank(scores, [("score", "asc")], tie_break=["id"])
        assert rows(got, "id", "rank") == rows(expected, "id", "rank")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rank_by_two_keys_with_nulls(scores):
    order = [F.col("grp").asc_nulls_last(), F.col("score").desc_nulls_last()]
    expected = scores.withColumn("rank", F.rank().over(Window.orderBy(*order)).cast("long"))
    got = global_rank(scores, [("grp", "asc"), ("score", "desc")], tie_break=["id"])
    assert rows(got, "id", "rank") == rows(expected, "id", "rank")


def test_row_id(scores):
    got = row_id(scores, [("score", "desc"), ("id", "asc")])
    order = [F.col("score").desc(), F.col("id")]
    expected = scores.withColumn("row_id", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert rows(got, "id", "row_id") == rows(expected, "id", "row_id")


def test_row_id_with_ties(scores):
    got = row_id(scores, [("score", "asc")], tie_break=["id"])
    expected = scores.withColumn("row_id", F.row_number().over(Window.orderBy("score", "id")).cast("long"))
    assert rows(got, "id", "row_id") == rows(expected, "id", "row_id")


@pytest.mark.parametrize("n", [1, 3, 40, -2])
def test_lag_and_average_over_many_blocks(scores, n):
    """A per-second order: thousands of rows a group, borrowed rows at every border."""
    for within in ([], ["grp"]):
        window = Window.partitionBy(*within).orderBy("id")
        got = lagged(scores, "score", "id", n, within, block_rows=17)
        expected = scores.withColumn("previous", F.lag("score", n).over(window))
        assert rows(got, "id", "previous") == rows(expected, "id", "previous")
        if n > 0:
            got = moving_avg(scores, "score", "id", n, within, block_rows=17)
            expected = scores.withColumn("moving_avg", F.avg("score").over(window.rowsBetween(1 - n, 0)))
            assert rows(got, "id", "moving_avg") == rows(expected, "id", "moving_avg")


def test_running_total(scores):
    got = running_total(scores, "id", "points", F.sum("score"), "upto")
    expected = scores.withColumn("upto", F.sum("score").over(Window.orderBy("id")))
    assert rows(got, "id", "upto") == rows(expected, "id", "upto")


def test_no_order_is_taken_in_one_task(scores):
    for df in (
        global_rank(scores, [("score", "asc")]),
        row_id(scores, [("id", "asc")]),
        running_total(scores, "id", "points", F.sum("score"), "upto"),
        lagged(scores, "score", "id"),
        moving_avg(scores, "score", "id", 5),
    ):
        windows = [line for line in plan_of(df).splitlines() if "Window [" in line]
        single = [w for w in windows if "__part" not in w and "__block" not in w]
        assert not single


def test_rank_entities_and_having(spark):
    games = spark.createDataFrame([("a", 5), ("a", 7), ("b", 12), ("c", 1)], "p string, pts int")
    got = rank_entities(
        games, ["p"], {"total": F.sum("pts")}, {"r": [("total", "desc")]}, having=F.col("total") > 1
    )
    assert rows(got) == [("a", 12, 1), ("b", 12, 1)]


def test_top_entities_keeps_ties_and_all_rows(spark):
    games = spark.createDataFrame(
        [("a", 5), ("a", 7), ("b", 12), ("c", 1), ("d", 20), ("e", None)], "p string, pts int"
    )
    assert rows(top_entities(games, "p", F.sum("pts"), 2)) == [("a", 5), ("a", 7), ("b", 12), ("d", 20)]
    assert rows(top_entities(games, "p", F.sum("pts"), 1, order="asc")) == [("c", 1)]


def test_lag_and_moving_average(spark):
    years = spark.createDataFrame([(2000, 10), (2001, 0), (2002, 5)], "y int, n int")
    got = lagged(years, "n", "y")
    assert rows(got) == [(2000, 10, None, None), (2001, 0, 10, -100.0), (2002, 5, 0, None)]
    assert rows(moving_avg(years, "n", "y", 2), "y", "moving_avg") == [(2000, 10.0), (2001, 5.0), (2002, 2.5)]


def test_topk_breaks_ties_and_hides(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None), (4, 9)], "id int, m int")
    got = topk(df, [("m", "desc")], 2, ["id"], hidden=["m"])
    assert [tuple(r) for r in got.collect()] == [(4,), (1,)]
    assert "TakeOrderedAndProject" in plan_of(got)


def test_union_sides_reads_once(spark):
    wide = spark.createDataFrame([(1, "x", 3, "y", 4)], "g int, h string, hp int, a string, ap int")
    got = union_sides(
        wide,
        {
            "home": {"team": F.col("h"), "pts": F.col("hp")},
            "away": {"team": F.col("a"), "pts": F.col("ap")},
        },
        ["g"],
    )
    assert rows(got) == [(1, "away", "y", 4), (1, "home", "x", 3)]
    assert "Union" not in plan_of(got)


def test_running_total_over_null_measures(spark):
    df = spark.range(64).selectExpr("id", "CASE WHEN id % 4 = 3 AND id > 8 THEN id END AS m")
    got = rows(running_total(df, "id", "s", F.sum("m"), "total"), "id", "total")
    total, want = None, []
    for i in range(64):
        if i % 4 == 3 and i > 8:
            total = (total or 0) + i
        want.append((i, total))
    assert got == want

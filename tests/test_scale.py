"""Plan shapes that matter on large, skewed data."""

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from grainframe.operators import (
    agg_by,
    collect_label,
    count_rows,
    enrich,
    has_match,
    keep_in,
    keep_not_in,
    nest,
    pct_of_parent,
    pct_of_total,
    with_total,
)
from grainframe.plans import QUERIES
from grainframe.plans.tables import Tables
from grainframe.sources import materialize_table
from grainframe.session import scratch_path

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def skewed(spark):
    """Facts of which a third share one key, with no side small enough to broadcast."""
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    fact = spark.range(0, 60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k")
    )
    dim = spark.range(6000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    yield fact, dim
    for key in SKEW:
        spark.conf.unset(key)


def _split(df):
    df.collect()
    plan = plan_of(df).split("== Initial Plan ==")[0]
    return "skew=true" in plan


@pytest.mark.parametrize("keep", ["match", "fact", "dim", "all"])
def test_hot_fact_key_is_split_whichever_side_survives(skewed, keep):
    fact, dim = skewed
    joined = enrich(fact, dim, "k", keep=keep)
    assert _split(joined)
    assert joined.count() == 60000 + (1000 if keep in ("dim", "all") else 0)


def test_hot_key_is_split_in_membership_and_grain_joins(skewed):
    fact, dim = skewed
    assert _split(keep_in(fact, "k", dim))
    assert _split(keep_not_in(fact, "k", dim.filter("k % 2 = 0")))
    assert _split(has_match(fact, dim, "k", "hit"))
    assert _split(agg_by(fact, {"n": count_rows()}, ["k"]))


def test_shares_do_not_gather_a_parent_in_one_task(skewed):
    fact, _ = skewed
    shares = pct_of_parent(fact, ["id"], ["k"], {"n": (count_rows(), "share")})
    assert _split(shares) and "Window" not in plan_of(shares)
    assert shares.filter("k = 7").agg(F.round(F.sum("share"), 6)).first()[0] == 1.0


def test_totals_are_scalar_subqueries(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    for out in (with_total(df, {"n": count_rows()}), pct_of_total(df, ["g"], "n", count_rows(), "s")):
        plan = plan_of(out)
        assert "Subquery" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_labels_limit_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    label = collect_label(df, ["g"], "v", "names", limit=3)
    plan = plan_of(label)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert rows(label) == [(0, "Many (500)"), (1, "Many (500)")]


def test_nested_lists_need_no_window(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    assert "Window" not in plan_of(nest(df, ["g"], ["v"], {"n": count_rows()}, "items", ["n"]))


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
        right = spark.range(0, 1000, 3).select("id", F.lit("x").alias("w"))
        a = materialize_table(left, "bucketed_a", scratch_path(spark, "a"), "id", 4)
        b = materialize_table(right, "bucketed_b", scratch_path(spark, "b"), "id", 4)
        joined = enrich(a, b, "id", ["w"])
        assert joined.count() == 334 and "Exchange" not in plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_a")
        spark.sql("DROP TABLE IF EXISTS bucketed_b")


JOINING = ["region_chain", "role_playing", "fanout_safe", "bridge", "both_preserving", "drill_across",
           "sales_vs_returns", "pct_of_total", "point_in_polygon", "dash_customer_regions", "agg_by",
           "collect_label", "suggest_binding", "ex_cumulative_fleet"]


@pytest.mark.parametrize("name", JOINING)
def test_no_cross_joins_and_no_python(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoop", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in plan


def test_scans_read_needed_columns_and_push_filters(spark, folder):
    plan = plan_of(QUERIES["pricing_summary"](spark, folder))
    assert "LessThanOrEqual(l_shipdate" in plan and "l_suppkey" not in plan
    t = Tables(spark, folder)
    narrow = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_type"]).groupBy("p_type").count()
    assert "l_extendedprice" not in plan_of(narrow) and "p_name" not in plan_of(narrow)

"""Catalog paths, sources, sinks, rollups and plan shapes."""

import datetime as dt

import pytest
from helpers import plan_of, rows
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Dataset, Edge, Measure, star_select
from grainframe.functions import combined_unit, traits
from grainframe.operators import apply_filter, count_rows, enrich, replace_columns, select_hidden
from grainframe.plans.tables import Tables, star
from grainframe.quality import check_edges
from grainframe.session import cut_lineage, scratch_path
from grainframe.sources import (
    RollupMeasure,
    append_new,
    bind,
    bind_nested,
    freshness,
    load,
    lookup_from_json,
    materialize,
    pick_source,
    refresh,
    rollup_read,
    rollup_write,
    scan_csv,
    scan_parquet,
    scan_tsv,
    view,
    write_bucketed,
)
from grainframe.sources.write import _held_keys


@pytest.fixture(scope="module")
def small_star(spark):
    catalog = Catalog()
    sales = spark.createDataFrame(
        [(1, 10, 1, 5), (2, 10, 2, 7), (3, 11, None, 1), (4, 11, 1, 2)], "id int, o int, shop int, qty int"
    )
    orders = spark.createDataFrame([(10, 1, 100), (11, 2, 50), (12, 2, 70)], "o int, c int, total int")
    customers = spark.createDataFrame([(1, "A", 1), (2, "B", 2), (3, "C", 1)], "c int, name string, place int")
    shops = spark.createDataFrame([(1, 1), (2, 2)], "shop int, place int")
    places = spark.createDataFrame([(1, "north"), (2, "south")], "place int, region string")
    for name, df, grain in (
        ("sales", sales, ("id",)),
        ("orders", orders, ("o",)),
        ("customers", customers, ("c",)),
        ("shops", shops, ("shop",)),
        ("places", places, ("place",)),
    ):
        catalog.register(Dataset(name, df, grain))
    catalog.link(Edge("sales", "orders", {"o": "o"}, "order", partial=True))
    catalog.link(Edge("sales", "shops", {"shop": "shop"}, "shop", nullable=True))
    catalog.link(Edge("orders", "customers", {"c": "c"}, "customer"))
    catalog.link(Edge("customers", "places", {"place": "place"}, "place"))
    catalog.link(Edge("shops", "places", {"place": "place"}, "place", nullable=True))
    return catalog


def test_measures_at_native_grain_and_members_without_facts(small_star):
    got = star_select(
        small_star,
        "sales",
        {"o": "order.o"},
        {
            "qty": Measure.sum("qty"),
            "n": Measure.count_keys("id"),
            "total": Measure.sum("order.total"),
        },
    )
    assert rows(got) == [(10, 12, 2, 100), (11, 3, 2, 50), (12, None, 0, None)]


def test_filter_on_facts_drops_members_without_facts(small_star):
    got = star_select(
        small_star, "sales", {"o": "order.o"}, {"qty": Measure.sum("qty")}, where=[("qty", lambda q: q > 2)]
    )
    assert rows(got) == [(10, 12)]


def test_nullable_edge_keeps_facts(small_star):
    got = star_select(small_star, "sales", {"region": "shop.place.region"}, {"qty": Measure.sum("qty")})
    assert rows(got) == [("north", 7), ("south", 7), (None, 1)]


def test_short_paths_and_ambiguity(small_star):
    assert small_star.resolve("sales", "customer.name") == (("order", "customer"), "name")
    with pytest.raises(ValueError, match="ambiguous"):
        small_star.resolve("sales", "place.region")
    with pytest.raises(KeyError):
        small_star.resolve("sales", "order.nothing")
    with pytest.raises(ValueError, match="mixes"):
        star_select(small_star, "sales", {}, {"m": Measure(("qty", "order.total"), lambda a, b: F.sum(a * b))})


def test_no_dimensions_and_two_grains(small_star):
    got = star_select(small_star, "sales", {}, {"qty": Measure.sum("qty"), "total": Measure.sum("order.total")})
    assert rows(got) == [(15, 150)]


def test_only_used_tables_are_joined(spark, folder):
    got = star_select(star(Tables(spark, folder)), "lineitem", {"flag": "l_returnflag"}, {"q": Measure.sum("l_quantity")})
    assert "Join" not in plan_of(got) and plan_of(got).count("FileScan") == 1


def test_filters_and_columns_reach_the_scan(spark, folder):
    got = star_select(
        star(Tables(spark, folder)),
        "lineitem",
        {"type": "part.p_type"},
        {"q": Measure.sum("l_quantity")},
        where=[("l_returnflag", lambda c: c == "R")],
    )
    plan = plan_of(got)
    assert "EqualTo(l_returnflag,R)" in plan and "l_extendedprice" not in plan
    assert "BroadcastHashJoin" in plan


def test_edges_report(small_star):
    found = {r["edge"]: (r["declared"], r["needed"], r["sufficient"]) for r in check_edges(small_star).collect()}
    assert found["sales.order"] == ("~", "~", True)
    assert found["sales.shop"] == ("?", "?", True)
    assert found["orders.customer"] == ("", "~", False)


def test_large_dimension_is_not_broadcast(spark, folder):
    t = Tables(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        plan = plan_of(enrich(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"]))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delimited_files(spark, tmp_path):
    csv, tsv = tmp_path / "a.csv", tmp_path / "a.tsv"
    csv.write_text('id,name,when\n1,"x, ""y""",2024-01-02\n2,,2024-01-03\n')
    tsv.write_text("id\tname\n1\tx\n")
    got = scan_csv(spark, str(csv))
    assert dict(got.dtypes) == {"id": "int", "name": "string", "when": "date"}
    assert rows(got) == [(1, 'x, "y"', dt.date(2024, 1, 2)), (2, None, dt.date(2024, 1, 3))]
    assert rows(scan_csv(spark, str(csv), "id long, name string, when string"), "when") == [
        ("2024-01-02",),
        ("2024-01-03",),
    ]
    assert rows(scan_tsv(spark, str(tsv))) == [(1, "x")]


def test_parquet_columns(spark, folder):
    df = scan_parquet(spark, f"{folder}/part.parquet", ["p_partkey"])
    assert df.columns == ["p_partkey"] and "p_name" not in plan_of(df)


def test_bindings(spark):
    df = spark.createDataFrame([(1, None, "b")], "k int, a string, b string")
    got = bind(df, {"k": ["id", "ticket"], "a": "v", "b": "v"}, {"up": "upper(b)"}, allow_repeat=True)
    assert rows(got) == [(1, 1, "b", "B")]
    with pytest.raises(ValueError, match="more than once"):
        bind(df, {"a": "v", "b": "v"})
    nested = spark.sql("SELECT 1 AS id, named_struct('x', 2, 'y', 3) AS s")
    assert bind_nested(nested, "s", ["y"], "s_").columns == ["id", "s_y"]
    view(df, F.col("k") == 1, {"k": "key"}, "one_row")
    assert rows(spark.sql("SELECT key FROM one_row")) == [(1,)]


def test_loads_and_increments(spark):
    path = scratch_path(spark, "load")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    load(first, path)
    assert load(first, path, "append").count() == 4
    assert load(first, path, "truncate").count() == 2
    with pytest.raises(ValueError):
        load(first, path, "merge")
    more = spark.createDataFrame([(2, "old"), (3, "c"), (3, "c")], "k int, v string")
    assert rows(append_new(path, more, "k")) == [(1, "a"), (2, "b"), (3, "c")]
    assert append_new(path, more, "k").count() == 3


def test_bucketed_write_prunes(spark):
    stored = write_bucketed(spark.range(100).toDF("id"), scratch_path(spark, "mod"), "id", 4)
    assert rows(stored.groupBy("mod_division").count()) == [(i, 25) for i in range(4)]
    assert "PartitionFilters: [isnotnull(mod_division" in plan_of(stored.filter("mod_division = 1"))


def test_rollup_equals_direct_aggregate(spark, folder):
    orders = Tables(spark, folder).orders
    daily = rollup_write(
        orders,
        {"day": F.to_date("o_orderdate")},
        {"n": RollupMeasure("count", F.col("o_orderkey")), "top": RollupMeasure("max", F.col("o_totalprice"))},
        scratch_path(spark, "rollup"),
    )
    got = rollup_read(daily, {"y": F.year("day")}, {"n": "count", "top": "max"})
    direct = orders.groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("top")
    )
    assert rows(got) == rows(direct)
    for kind in ("avg", "count_distinct"):
        with pytest.raises(ValueError, match="re-aggregated"):
            rollup_read(daily, {}, {"n": kind})


def test_source_choice(spark):
    full = spark.createDataFrame([(1, "R"), (2, "A")], "k int, f string")
    part = full.filter("f = 'R'").withColumn("k", F.col("k") * 10)
    choices = [(part, "f = 'R'"), (full, None)]
    assert rows(pick_source(["f = 'R'"], choices), "k") == [(10,)]
    assert rows(pick_source(["k > 1"], choices), "k") == [(2,)]
    with pytest.raises(ValueError):
        pick_source(["k > 1"], choices[:1])


def test_refresh(spark):
    old = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k int, d date")
    new = spark.createDataFrame([(2, dt.date(2024, 2, 1))], "k int, d date")
    path, target = scratch_path(spark, "old"), scratch_path(spark, "new")
    materialize(old, path)
    assert rows(freshness(old, "d", "2024-01-11"), "lag_days") == [(10,)]
    assert rows(refresh(spark, path, target, "d", lambda: new, 30, "2024-01-11"), "k") == [(1,)]
    assert rows(refresh(spark, path, target, "d", lambda: new, 5, "2024-01-11"), "k") == [(2,)]


def test_lookup_from_json(spark):
    df = spark.createDataFrame([('{"1": "Archer", "2": "Scout"}',), ('{"1": "Archer"}',), (None,)], "j string")
    assert rows(lookup_from_json(df, F.col("j"))) == [("1", "Archer"), ("2", "Scout")]


def test_cut_lineage_reads_written_files(spark):
    df = cut_lineage(spark.range(10).withColumn("x", F.rand()), "cut")
    assert rows(df) == rows(df) and "FileScan" in plan_of(df)


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 3, "b"), (3, 9, "c")], "k int, m int, v string")
    got = select_hidden(df, ["m"], F.col("m") > 3, [F.desc("m")], 1)
    assert got.columns == ["k", "v"] and rows(got) == [(3, "c")]
    assert replace_columns(df, {"v": F.upper("v")}, ["m"]).columns == ["k", "v"]
    pack = {"n": lambda d: d.agg(count_rows().alias("n"))}
    assert rows(apply_filter(pack, df, F.col("m") > 3)["n"]) == [(2,)]


def test_joins_start_at_the_fact_whatever_the_sizes(spark, folder):
    catalog = star(Tables(spark, folder))
    nation = (("order", "customer", "nation"), "n_name")

    def keys():
        plan = plan_of(catalog.wide("lineitem", [nation, ((), "l_quantity")]))
        joins = [x for x in plan.splitlines() if "Join" in x]
        return [next(k for k in ("n_nationkey", "c_custkey", "o_orderkey") if k in x) for x in joins]

    small = keys()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert keys() == small == ["n_nationkey", "c_custkey", "o_orderkey"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_new_takes_a_null_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    rows_.write.parquet(path)
    assert append_new(path, rows_, "k").count() == 2


def test_append_new_keeps_the_newest_of_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, at int, v string"
    spark.createDataFrame([(1, 9, "old"), (500, 1, "far")], schema).write.parquet(path)
    batch = [(1, 10, "known"), (2, 1, "a"), (2, 3, "b"), (2, None, "c"), (3, None, "d"), (None, 1, "e"), (None, 2, "f"),
             (4, 7, "x"), (4, 7, "y"), (4, 7, "y")]
    found = append_new(path, spark.createDataFrame(batch, schema), "k", "at")
    expected = [(1, 9, "old"), (2, 3, "b"), (3, None, "d"), (4, 7, "y"), (500, 1, "far"), (None, 2, "f")]
    assert rows(found) == expected
    assert rows(append_new(path, spark.createDataFrame(batch, schema), "k", "at")) == expected
    assert rows(append_new(path, spark.createDataFrame(batch, schema).limit(0), "k")) == expected


def test_new_key_load_reads_keys_in_range_only(spark, tmp_path):
    """The target is reduced to the batch's range and keys before its keys are made distinct."""
    path = str(tmp_path / "t")
    spark.range(10_000).selectExpr("id AS k", "id AS v").write.parquet(path)
    batch = spark.range(9_990, 10_010).selectExpr("id AS k", "id AS v")
    held = _held_keys(spark.read.parquet(path), batch, "k")
    plan = held._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "GreaterThanOrEqual(k,9990)" in plan and "ReadSchema: struct<k:bigint>" in plan
    assert plan.index("HashAggregate") < plan.index("LeftSemi") and rows(held) == [(k,) for k in range(9_990, 10_000)]
    assert append_new(path, batch, "k", "v").count() == 10_010


def test_refresh_builds_from_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    built = refresh(spark, path, path, "d", lambda: spark.sql("SELECT date'2024-01-01' AS d"), 1, "2024-01-02")
    assert built.count() == 1 and spark.read.parquet(path).count() == 1


def test_quoted_line_breaks_survive_csv(spark, tmp_path):
    path = tmp_path / "breaks.csv"
    path.write_text('id,text\n1,"two\nlines, ""quoted"""\n2,plain\n')
    got = scan_csv(spark, str(path), "id long, text string")
    assert sorted(map(tuple, got.collect())) == [(1, 'two\nlines, "quoted"'), (2, "plain")]


def test_members_behind_a_nullable_edge_of_a_partial_chain(spark):
    catalog = Catalog()
    catalog.register(Dataset("sale", spark.sql("SELECT 1 AS sale_id, 1 AS shop_id"), ("sale_id",)))
    shops = spark.sql("SELECT * FROM VALUES (1, 1), (2, NULL) AS s(shop_key, town_ref)")
    catalog.register(Dataset("shop", shops, ("shop_key",)))
    towns = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS s(town_key, town)")
    catalog.register(Dataset("town", towns, ("town_key",)))
    catalog.link(Edge("sale", "shop", {"shop_id": "shop_key"}, "shop", partial=True))
    catalog.link(Edge("shop", "town", {"town_ref": "town_key"}, "town", partial=True, nullable=True))
    sales = Measure(("sale_id",), F.count, empty=0)
    out = star_select(catalog, "sale", {"town": "shop.town.town"}, {"sales": sales})
    assert {tuple(r) for r in out.collect()} == {("a", 1), ("b", 0), (None, 0)}


def test_units_of_aggregates(spark, folder):
    model = star(Tables(spark, folder))
    kept = star_select(model, "lineitem", {"l_tax": "l_tax"}, {"least": Measure.min("l_extendedprice"), "most": Measure.max("l_extendedprice")})
    assert traits(kept) == {"l_tax": "percent", "least": "usd", "most": "usd"}
    added = Measure(("l_extendedprice", "l_tax"), lambda a, b: F.sum(a + b), unit="sum")
    with pytest.raises(ValueError, match="different units"):
        star_select(model, "lineitem", {}, {"mixed": added})
    plain = star_select(model, "lineitem", {}, {"n": Measure(("l_tax",), F.count)})
    assert traits(plain) == {}


def test_unit_rules():
    assert combined_unit("ratio", "usd", "usd") is None and combined_unit("ratio", None, "kg") == "1/kg"
    assert combined_unit("product", "usd", "percent") == "usd" and combined_unit("product", "percent", None) == "percent"
    assert combined_unit("product", "m", "kg") == "kg*m" and combined_unit("sum") is None
    with pytest.raises(ValueError):
        combined_unit("mean", "usd")

"""Dashboard questions on the order star, asked through ``star_select``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.catalog import Measure, star_select
from grainframe.functions import month_start
from grainframe.operators import count_keys, enrich, pct_of_parent, topk
from grainframe.plans.joins import revenue
from grainframe.plans.projection import charged, discounted
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables, star


@query(
    "dash_entity_counts",
    """SELECT count(DISTINCT o_orderkey) AS orders, count(DISTINCT c_nationkey) AS customer_nations,
              count(DISTINCT s_suppkey) AS suppliers, count(DISTINCT s_nationkey) AS supplier_nations
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey""",
)
def entity_counts(t: Tables) -> DataFrame:
    """How many orders, suppliers and nations the sold items reach; no output dimension."""
    return star_select(
        star(t),
        "lineitem",
        {},
        {
            "orders": Measure(("order.o_orderkey",), F.count),
            "customer_nations": Measure.count_keys("order.customer.c_nationkey"),
            "suppliers": Measure(("supplier.s_suppkey",), F.count),
            "supplier_nations": Measure.count_keys("supplier.s_nationkey"),
        },
    )


@query(
    "dash_part_types",
    """SELECT p_type, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
              round(avg(l_discount), 6) AS avg_discount
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
       HAVING sum(l_extendedprice * (1 - l_discount)) > 0 ORDER BY revenue DESC, p_type LIMIT 15""",
)
def part_types(t: Tables) -> DataFrame:
    return star_select(
        star(t),
        "lineitem",
        {"p_type": "part.p_type"},
        {
            "revenue": revenue(),
            "avg_discount": Measure(("l_discount",), lambda d: F.round(F.avg(d), 6)),
        },
        having=F.col("revenue") > 0,
        order=[("revenue", "desc"), ("p_type", "asc")],
        limit=15,
    )


@query(
    "dash_customer_nations",
    """SELECT n_name AS nation, sum(l_quantity) AS items_sold
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 HAVING sum(l_quantity) > 0""",
)
def customer_nations(t: Tables) -> DataFrame:
    return star_select(
        star(t),
        "lineitem",
        {"nation": "order.customer.nation.n_name"},
        {"items_sold": Measure.sum("l_quantity")},
        having=F.col("items_sold") > 0,
    )


@query(
    "dash_supplier_nations",
    """SELECT n_name AS nation, count(DISTINCT s_suppkey) AS suppliers,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       GROUP BY 1 HAVING sum(l_extendedprice * (1 - l_discount)) > 0""",
)
def supplier_nations(t: Tables) -> DataFrame:
    return star_select(
        star(t),
        "lineitem",
        {"nation": "supplier.nation.n_name"},
        {"suppliers": Measure(("supplier.s_suppkey",), F.count), "revenue": revenue()},
        having=F.col("revenue") > 0,
    )


@query(
    "dash_customer_regions",
    """SELECT r_regionkey AS region_id, r_name AS region, count(*) AS order_count,
              round(sum(o_totalprice), 2) AS total_sales
       FROM (SELECT DISTINCT l_orderkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def customer_regions(t: Tables) -> DataFrame:
    """An order's total counts once, although the question starts at line items."""
    region = "order.customer.nation.region"
    return star_select(
        star(t),
        "lineitem",
        {"region_id": f"{region}.r_regionkey", "region": f"{region}.r_name"},
        {
            "order_count": Measure(("order.o_orderkey",), F.count),
            "total_sales": Measure(("order.o_totalprice",), lambda p: F.round(F.sum(p), 2)),
        },
        where=[(f"{region}.r_regionkey", lambda c: c.isNotNull())],
        having=F.col("order_count") > 0,
    )


@query(
    "dash_monthly_nations",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, n_name AS nation,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS monthly_revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""",
)
def monthly_nations(t: Tables) -> DataFrame:
    lines = enrich(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, ["o_orderdate"])
    lines = enrich(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = enrich(lines, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name"])
    return lines.groupBy(
        month_start(F.col("o_orderdate")).alias("order_month"), F.col("n_name").alias("nation")
    ).agg(F.round(F.sum(discounted()), 4).alias("monthly_revenue"))


@query(
    "dash_supplier_counts",
    """SELECT count(DISTINCT s_suppkey) AS suppliers, count(DISTINCT s_nationkey) AS nations FROM supplier""",
)
def supplier_counts(t: Tables) -> DataFrame:
    """Each key is counted apart, so no row is expanded for several distinct counts."""
    nations = t.supplier.agg(count_keys("s_nationkey").alias("nations"))
    suppliers = t.supplier.agg(count_keys("s_suppkey").alias("suppliers"))
    return suppliers.withColumn("nations", nations.scalar())


_SHARES = """
WITH g AS (SELECT p_name, s_nationkey, n_name,
                  sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS charge,
                  sum(l_extendedprice * (1 - l_discount)) AS discounted
           FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation ON s_nationkey = n_nationkey
           WHERE l_shipdate <= TIMESTAMP '1998-12-01' GROUP BY 1, 2, 3)
SELECT p_name AS part_name, n_name AS nation, round(charge, 2) AS total_charge_price,
       round(discounted, 4) AS total_discounted_price,
       round(charge / sum(charge) OVER (PARTITION BY s_nationkey), 6) AS charge_share_of_nation,
       round(discounted / sum(discounted) OVER (PARTITION BY s_nationkey), 6) AS discounted_share_of_nation
FROM g ORDER BY total_charge_price DESC, part_name, nation LIMIT 100"""


@query("dash_part_share_of_nation", _SHARES)
def part_share_of_nation(t: Tables) -> DataFrame:
    """Charge and discounted price per part name and nation, with their shares of the nation."""
    lines = t.lineitem.filter(F.col("l_shipdate") <= F.lit("1998-12-01").cast("timestamp_ntz"))
    lines = enrich(lines, t.part, {"l_partkey": "p_partkey"}, ["p_name"])
    lines = enrich(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = enrich(lines, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name"])
    shares = pct_of_parent(
        lines,
        ["p_name", "n_name"],
        ["s_nationkey"],
        {
            "charge": (F.sum(charged()), "charge_share"),
            "discounted": (F.sum(discounted()), "discounted_share"),
        },
    )
    shown = shares.select(
        F.col("p_name").alias("part_name"),
        F.col("n_name").alias("nation"),
        F.round("charge", 2).alias("total_charge_price"),
        F.round("discounted", 4).alias("total_discounted_price"),
        F.round("charge_share", 6).alias("charge_share_of_nation"),
        F.round("discounted_share", 6).alias("discounted_share_of_nation"),
    )
    return topk(shown, [("total_charge_price", "desc")], 100, tie_break=["part_name", "nation"])

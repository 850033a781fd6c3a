"""Ranks, running values, top-k and wide-to-tall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.functions import month_start
from grainframe.operators import (
    count_rows,
    enrich,
    fill_periods,
    lagged,
    moving_avg,
    rank_entities,
    row_id,
    running_total,
    top_entities,
    topk,
    union_sides,
)
from grainframe.plans.projection import discounted, mean
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables


@query(
    "rank_entities",
    """WITH g AS (SELECT user_id, CASE WHEN count(*) > 60 THEN 1 ELSE 0 END AS eligible,
                         round(sum(value), 2) / count(*) AS mean_value, count(*) AS events
                  FROM events GROUP BY 1)
       SELECT user_id, eligible, mean_value, events,
              rank() OVER (ORDER BY eligible DESC, mean_value DESC) AS user_rank FROM g""",
)
def rank_users(t: Tables) -> DataFrame:
    """Users ranked by eligibility, then by mean value."""
    return rank_entities(
        t.events,
        ["user_id"],
        {
            "eligible": F.when(count_rows() > 60, 1).otherwise(0),
            "mean_value": mean("value"),
            "events": count_rows(),
        },
        {"user_rank": [("eligible", "desc"), ("mean_value", "desc")]},
    )


@query(
    "rank_both",
    """WITH g AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1)
       SELECT o_custkey, orders, rank() OVER (ORDER BY orders) AS rank_asc,
              rank() OVER (ORDER BY orders DESC) AS rank_desc FROM g""",
)
def rank_both(t: Tables) -> DataFrame:
    """Heavily tied counts ranked in both directions."""
    return rank_entities(
        t.orders,
        ["o_custkey"],
        {"orders": count_rows()},
        {"rank_asc": [("orders", "asc")], "rank_desc": [("orders", "desc")]},
    )


@query(
    "topn_entity",
    """WITH r AS (SELECT o_custkey, rank() OVER (ORDER BY round(sum(o_totalprice), 2) DESC) AS rk
                  FROM orders GROUP BY 1)
       SELECT o_orderkey, o.o_custkey, o_totalprice FROM orders o JOIN r ON o.o_custkey = r.o_custkey
       WHERE rk <= 10""",
)
def topn_entity(t: Tables) -> DataFrame:
    """All orders of the ten customers with the highest order value."""
    total = F.round(F.sum("o_totalprice"), 2)
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return top_entities(orders, "o_custkey", total, 10)


@query(
    "running_total",
    """WITH g AS (SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders FROM orders GROUP BY 1)
       SELECT order_date, orders, (sum(orders) OVER (ORDER BY order_date))::BIGINT AS cumulative_orders
       FROM g""",
)
def running_orders(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("order_date", F.to_date("o_orderdate"))
    return running_total(dated, "order_date", "orders", count_rows(), "cumulative_orders")


@query(
    "yoy_growth",
    """WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority,
                         count(*) AS orders FROM orders GROUP BY 1, 2),
            l AS (SELECT *, lag(orders) OVER (PARTITION BY o_orderpriority ORDER BY order_year) AS previous
                  FROM g)
       SELECT order_year, o_orderpriority, orders, previous,
              (orders - previous) * 100 / nullif(previous, 0)::DOUBLE AS orders_growth_pct FROM l""",
)
def yoy_growth(t: Tables) -> DataFrame:
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("order_year"), "o_orderpriority").agg(
        count_rows().alias("orders")
    )
    return lagged(yearly, "orders", "order_year", within=["o_orderpriority"])


@query(
    "moving_avg",
    """WITH g AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, count(*) AS orders
                  FROM orders GROUP BY 1)
       SELECT order_month, orders,
              round(avg(orders) OVER (ORDER BY order_month ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)
                AS orders_ma5
       FROM g""",
)
def moving_average(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy(month_start(F.col("o_orderdate")).alias("order_month")).agg(
        count_rows().alias("orders")
    )
    out = moving_avg(monthly, "orders", "order_month", 5, out="orders_ma5")
    return out.withColumn("orders_ma5", F.round("orders_ma5", 6))


_GAPPED = """WITH g AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
                         count(*) AS orders FROM orders
                  WHERE month(o_orderdate) NOT IN (2, 7) OR o_orderpriority = '1-URGENT' GROUP BY 1, 2),
            ends AS (SELECT o_orderpriority, min(order_month) AS a, max(order_month) AS b FROM g GROUP BY 1),
            f AS (SELECT e.o_orderpriority, CAST(e.m AS DATE) AS order_month, coalesce(g.orders, 0) AS orders
                  FROM (SELECT o_orderpriority, unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS m FROM ends) e
                  LEFT JOIN g ON g.o_orderpriority = e.o_orderpriority AND g.order_month = e.m)"""


def _gapped_months(t: Tables) -> DataFrame:
    """Orders per priority and month; all but one priority lack two months a year, which are filled with 0."""
    kept = ~F.month("o_orderdate").isin(2, 7) | (F.col("o_orderpriority") == "1-URGENT")
    months = t.orders.filter(kept).groupBy(
        "o_orderpriority", month_start(F.col("o_orderdate")).alias("order_month")
    ).agg(count_rows().alias("orders"))
    return fill_periods(months, "order_month", "month", ["o_orderpriority"], {"orders": 0})


@query(
    "growth_by_calendar_month",
    _GAPPED
    + """, l AS (SELECT *, lag(orders) OVER (PARTITION BY o_orderpriority ORDER BY order_month) AS previous FROM f)
       SELECT o_orderpriority, order_month, orders, previous,
              (orders - previous) * 100 / nullif(previous, 0)::DOUBLE AS orders_growth_pct FROM l""",
)
def growth_by_calendar_month(t: Tables) -> DataFrame:
    """Growth against the month before, also where a month has no orders."""
    return lagged(_gapped_months(t), "orders", "order_month", within=["o_orderpriority"])


@query(
    "moving_avg_by_calendar_month",
    _GAPPED
    + """SELECT o_orderpriority, order_month, orders,
              round(avg(orders) OVER (PARTITION BY o_orderpriority ORDER BY order_month
                                      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS orders_ma3 FROM f""",
)
def moving_avg_by_calendar_month(t: Tables) -> DataFrame:
    """Mean over three calendar months."""
    out = moving_avg(_gapped_months(t), "orders", "order_month", 3, ["o_orderpriority"], out="orders_ma3")
    return out.withColumn("orders_ma3", F.round("orders_ma3", 6))


@query(
    "row_id",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_id FROM orders""",
)
def row_ids(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    numbered = row_id(orders, [("o_totalprice", "desc")], tie_break=["o_orderkey"])
    return numbered.select("o_orderkey", "row_id")


@query(
    "top_customers",
    """SELECT c_custkey, c_name, round(sum(o_totalprice), 2) / count(*) AS avg_price, count(*) AS orders
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
       ORDER BY avg_price DESC, c_custkey LIMIT 10""",
)
def top_customers(t: Tables) -> DataFrame:
    """Names are fetched for the ten customers that are left, not for all."""
    means = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        mean("o_totalprice").alias("avg_price"), count_rows().alias("orders")
    )
    best = topk(means, [("avg_price", "desc")], 10, tie_break=["c_custkey"])
    return enrich(best, t.customer, "c_custkey", ["c_name"])


@query(
    "best_entity",
    """SELECT p_brand FROM part GROUP BY 1 ORDER BY round(sum(p_retailprice), 2) / count(*) DESC, p_brand LIMIT 1""",
)
def best_entity(t: Tables) -> DataFrame:
    means = t.part.groupBy("p_brand").agg(mean("p_retailprice").alias("mean"))
    return topk(means, [("mean", "desc")], 1, tie_break=["p_brand"], hidden=["mean"])


@query(
    "limited",
    """SELECT least(count(*), 1000) AS "rows", least(count(*), 1000) AS priced FROM lineitem""",
)
def limited(t: Tables) -> DataFrame:
    """A bounded result without an order: which rows come is not defined, so they are counted."""
    some = t.lineitem.select("l_orderkey", (discounted() + 0).alias("revenue")).limit(1000)
    return some.agg(count_rows().alias("rows"), F.count("revenue").alias("priced"))


@query(
    "union_sides",
    """SELECT side, nation_key, count(*) AS lines, round(sum(price), 2) AS price FROM (
         SELECT 'customer' AS side, c_nationkey AS nation_key, l_extendedprice AS price
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         UNION ALL
         SELECT 'supplier', s_nationkey, l_extendedprice
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) GROUP BY 1, 2""",
)
def customer_and_supplier_sides(t: Tables) -> DataFrame:
    """The buying and the selling side of each line as rows, from one pass over the wide rows."""
    orders = enrich(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    wide = enrich(t.lineitem, orders, {"l_orderkey": "o_orderkey"}, ["c_nationkey"])
    wide = enrich(wide, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    tall = union_sides(
        wide,
        {
            "customer": {"nation_key": F.col("c_nationkey")},
            "supplier": {"nation_key": F.col("s_nationkey")},
        },
        common=["l_extendedprice"],
    )
    return tall.groupBy("side", "nation_key").agg(
        count_rows().alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("price")
    )

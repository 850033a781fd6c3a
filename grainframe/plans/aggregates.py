"""Aggregation at an explicit grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.functions import holiday_label, month_start, ratio
from grainframe.functions.dates import HOLIDAYS
from grainframe.operators import (
    agg_by,
    agg_native,
    agg_of_agg,
    align,
    collect_label,
    count_keys,
    count_owners,
    count_rows,
    enrich,
    headline,
    nest,
    pct_of_parent,
    pct_of_total,
    regrain,
    share_within,
    symmetric_measures,
)
from grainframe.plans.projection import discounted, mean
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables


@query(
    "count_keys",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers,
              count(*) AS lines FROM lineitem GROUP BY 1""",
)
def count_distinct_keys(t: Tables) -> DataFrame:
    """Each key is counted apart, so no row is expanded for several distinct counts."""
    flags = t.lineitem.groupBy("l_returnflag")
    orders = flags.agg(count_keys("l_orderkey").alias("orders"), count_rows().alias("lines"))
    suppliers = flags.agg(count_keys("l_suppkey").alias("suppliers"))
    return align([orders, suppliers], ["l_returnflag"])


@query(
    "count_owners",
    """SELECT event_type, count(DISTINCT CASE WHEN nullif(value, 0.01) > 5 THEN user_id END) AS owners
       FROM events GROUP BY 1""",
)
def count_owners_of_value(t: Tables) -> DataFrame:
    """Users that own a non-null attribute (a value over five)."""
    events = t.events.withColumn("large", F.when(F.col("value") > 5, F.col("value")))
    return events.groupBy("event_type").agg(count_owners("large", "user_id").alias("owners"))


@query(
    "wins_sum",
    """SELECT o_orderpriority, sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END)::BIGINT AS wins
       FROM orders GROUP BY 1""",
)
def wins_sum(t: Tables) -> DataFrame:
    won = F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)
    return t.orders.groupBy("o_orderpriority").agg(F.sum(won).alias("wins"))


@query(
    "cancel_rate",
    """SELECT n_name, count(DISTINCT o_orderkey) AS orders,
              count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderkey END)
                / nullif(count(DISTINCT o_orderkey), 0)::DOUBLE AS pending_rate
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       GROUP BY 1 HAVING count(DISTINCT o_orderkey) > 10""",
)
def cancel_rate(t: Tables) -> DataFrame:
    """A ratio of aggregates; order keys are unique in orders, so plain counts are exact."""
    orders = enrich(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    orders = enrich(orders, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])
    pending = F.count(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey")))
    totals = orders.groupBy("n_name").agg(
        F.count("o_orderkey").alias("orders"), pending.alias("pending")
    )
    rated = totals.withColumn("pending_rate", ratio(F.col("pending"), F.col("orders")))
    return rated.filter("orders > 10").drop("pending")


@query(
    "agg_by",
    """SELECT p_partkey, p_brand, p_retailprice, round(sum(p_retailprice) OVER (PARTITION BY p_brand), 2)
                / count(*) OVER (PARTITION BY p_brand) AS avg_brand_price, max(p_size) OVER (PARTITION BY p_brand) AS max_brand_size
       FROM part""",
)
def aggregate_by_brand(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_retailprice", "p_size")
    measures = {
        "avg_brand_price": mean("p_retailprice"),
        "max_brand_size": F.max("p_size"),
    }
    return agg_by(parts, measures, ["p_brand"]).drop("p_size")


@query(
    "fanout_safe",
    """SELECT l_returnflag, round(sum(o_totalprice), 2) AS total_price, count(*) AS orders
       FROM (SELECT DISTINCT l_returnflag, l_orderkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
       GROUP BY 1""",
)
def fanout_safe(t: Tables) -> DataFrame:
    """Order totals by line flag: joining to lines does not repeat an order's total."""
    return agg_native(
        t.lineitem,
        ["l_returnflag"],
        t.orders.select("o_orderkey", "o_totalprice"),
        ("l_orderkey", "o_orderkey"),
        {"total_price": F.round(F.sum("o_totalprice"), 2), "orders": count_rows()},
    )


@query(
    "regrain",
    """SELECT n_name, sum(size)::BIGINT AS total_size, avg(size) AS avg_size
       FROM (SELECT n_name, l_orderkey, max(p_size) AS size
             FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1""",
)
def regrain_sizes(t: Tables) -> DataFrame:
    """The largest part size per order, summed and averaged per supplier nation."""
    lines = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_size"])
    lines = enrich(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = enrich(lines, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name"])
    return regrain(
        lines,
        ["n_name"],
        ["l_orderkey"],
        {"size": F.max("p_size")},
        {
            "total_size": F.sum("size"),
            "avg_size": F.avg("size"),
        },
    )


@query(
    "pct_of_total",
    """SELECT o_orderpriority, count(*) AS orders,
              count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM orders GROUP BY 1""",
)
def percent_of_total(t: Tables) -> DataFrame:
    return pct_of_total(t.orders, ["o_orderpriority"], "orders", count_rows(), "share")


@query(
    "pct_of_parent",
    """WITH g AS (SELECT n_name, p_brand, sum(l_quantity) AS quantity, count(*) AS lines
                  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
       SELECT n_name, p_brand, quantity, lines,
              round(quantity / sum(quantity) OVER (PARTITION BY n_name), 6) AS quantity_share,
              round(lines / sum(lines) OVER (PARTITION BY n_name)::DOUBLE, 6) AS line_share
       FROM g""",
)
def percent_of_parent(t: Tables) -> DataFrame:
    lines = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_brand"])
    lines = enrich(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = enrich(lines, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name"])
    shares = pct_of_parent(
        lines,
        ["p_brand"],
        ["n_name"],
        {
            "quantity": (F.sum("l_quantity"), "quantity_share"),
            "lines": (count_rows(), "line_share"),
        },
    )
    return shares.withColumns(
        {c: F.round(c, 6) for c in ("quantity_share", "line_share")}
    )


@query(
    "avg_of_order_totals",
    """SELECT l_linestatus, round(sum(total), 2) / count(*) AS avg_order_total, max(n) AS most_lines
       FROM (SELECT l_linestatus, l_orderkey, sum(l_extendedprice) AS total, count(*) AS n
             FROM lineitem GROUP BY 1, 2) GROUP BY 1""",
)
def avg_of_order_totals(t: Tables) -> DataFrame:
    return agg_of_agg(
        t.lineitem,
        ["l_linestatus", "l_orderkey"],
        {"total": F.sum("l_extendedprice"), "n": count_rows()},
        ["l_linestatus"],
        {"avg_order_total": mean("total"), "most_lines": F.max("n")},
    )


@query(
    "bucket_hist",
    """SELECT round(o_totalprice / 50000) * 50000 AS price_bucket, count(*) AS orders,
              round(sum(o_totalprice), 2) / count(*) AS avg_price FROM orders GROUP BY 1""",
)
def bucket_hist(t: Tables) -> DataFrame:
    bucket = F.round(F.col("o_totalprice") / 50000) * 50000
    return t.orders.groupBy(bucket.alias("price_bucket")).agg(
        count_rows().alias("orders"), mean("o_totalprice").alias("avg_price")
    )


@query(
    "monthly_revenue",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month,
              CAST(year(l_shipdate) AS INTEGER) AS ship_year,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem GROUP BY 1, 2""",
)
def monthly_revenue(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(
        month_start(F.col("l_shipdate")).alias("ship_month"),
        F.year("l_shipdate").alias("ship_year"),
    ).agg(F.round(F.sum(discounted()), 4).alias("revenue"))


_HOLIDAY = "CASE {} ELSE w END".format(
    " ".join(
        f"WHEN m = {month} AND d BETWEEN {first} AND {last}"
        + (f" AND w = '{weekday}'" if weekday else "")
        + f" THEN '{label}'"
        for label, month, first, last, weekday in HOLIDAYS
    )
)


@query(
    "holiday_label",
    f"""SELECT {_HOLIDAY} AS label, count(*) AS orders, round(sum(o_totalprice), 2) / count(*) AS avg_price
        FROM (SELECT month(o_orderdate) AS m, day(o_orderdate) AS d, dayname(o_orderdate) AS w, o_totalprice
              FROM orders) GROUP BY 1""",
)
def orders_by_holiday(t: Tables) -> DataFrame:
    return t.orders.groupBy(holiday_label(F.col("o_orderdate")).alias("label")).agg(
        count_rows().alias("orders"), mean("o_totalprice").alias("avg_price")
    )


@query("distinct_dims", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_dims(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "any_of",
    """SELECT event_type, min(props) AS props, count(*) AS events FROM events GROUP BY 1""",
)
def any_of(t: Tables) -> DataFrame:
    """A representative value: the least one, so repeated runs agree."""
    return t.events.groupBy("event_type").agg(
        F.min("props").alias("props"), count_rows().alias("events")
    )


@query(
    "collect_label",
    """SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) > 4
                   THEN 'Many (' || count(DISTINCT o_orderpriority) || ')'
                   ELSE array_to_string(list_sort(list(DISTINCT o_orderpriority)), ', ') END AS priorities
       FROM orders GROUP BY 1""",
)
def collect_priorities(t: Tables) -> DataFrame:
    return collect_label(t.orders, ["o_custkey"], "o_orderpriority", "priorities", limit=4)


@query(
    "collect_all",
    """SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), ', ') AS types
       FROM part GROUP BY 1""",
)
def collect_all(t: Tables) -> DataFrame:
    return collect_label(t.part, ["p_brand"], "p_type", "types")


@query(
    "nested_breakdown",
    """WITH g AS (SELECT l_returnflag, p_type, count(*) AS n, count(DISTINCT l_orderkey) AS orders
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
       SELECT l_returnflag, string_agg(n || ':' || p_type || ':' || orders, ' ' ORDER BY n DESC, p_type DESC)
                AS breakdown
       FROM g WHERE n > 10 GROUP BY 1""",
)
def nested_breakdown(t: Tables) -> DataFrame:
    """Lines and orders per part type as a sorted list inside each flag, shown as text."""
    typed = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_type"])
    nested = nest(
        typed,
        ["l_returnflag"],
        ["p_type"],
        {"n": count_rows(), "orders": count_keys("l_orderkey")},
        "items",
        order=["n"],
        having=F.col("n") > 10,
    )
    text = F.transform(
        "items", lambda i: F.concat_ws(":", i.getField("n"), i.getField("p_type"), i.getField("orders"))
    )
    return nested.select("l_returnflag", F.array_join(text, " ").alias("breakdown"))


@query(
    "share_within_year",
    """WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority,
                         sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
       SELECT order_year, o_orderpriority, round(v, 2) AS total_price,
              round(100 * v / sum(v) OVER (PARTITION BY order_year), 6) AS percent_of_year FROM g""",
)
def share_within_year(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("order_year", F.year("o_orderdate"))
    shares = share_within(
        orders,
        ["o_orderpriority"],
        ["order_year"],
        "total_price",
        F.sum("o_totalprice"),
        "share",
    )
    return shares.select(
        "order_year",
        "o_orderpriority",
        F.round("total_price", 2).alias("total_price"),
        F.round(F.col("share") * 100, 6).alias("percent_of_year"),
    )


@query(
    "headline",
    """SELECT round(sum(l_extendedprice * (1 - l_discount)), 4) AS total_revenue,
              sum(l_quantity) AS total_items_sold, count(DISTINCT l_orderkey) AS total_orders,
              count(DISTINCT o_custkey) AS total_customers
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def headline_measures(t: Tables) -> DataFrame:
    """Distinct customers are counted over one row per order, not per line."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(discounted()).alias("revenue"), F.sum("l_quantity").alias("items")
    )
    joined = enrich(per_order, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"])
    return headline(
        joined,
        {
            "total_revenue": F.round(F.sum("revenue"), 4),
            "total_items_sold": F.sum("items"),
            "total_orders": F.count("l_orderkey"),
            "total_customers": count_keys("o_custkey"),
        },
    )


@query(
    "rowset",
    """WITH big AS (SELECT o_custkey, count(*) AS orders FROM orders WHERE o_totalprice > 300000 GROUP BY 1)
       SELECT c_mktsegment, count(*) AS customers, max(orders) AS most_orders,
              avg(orders) AS avg_orders
       FROM big JOIN customer ON o_custkey = c_custkey WHERE orders > 1 GROUP BY 1""",
)
def rowset(t: Tables) -> DataFrame:
    """A named sub-select used as the input of another query."""
    big = t.orders.filter("o_totalprice > 300000").groupBy("o_custkey").agg(
        count_rows().alias("orders")
    )
    repeat = enrich(
        big.filter("orders > 1"), t.customer, {"o_custkey": "c_custkey"}, ["c_mktsegment"]
    )
    return repeat.groupBy("c_mktsegment").agg(
        count_rows().alias("customers"),
        F.max("orders").alias("most_orders"),
        F.avg("orders").alias("avg_orders"),
    )


@query(
    "symmetric_measures",
    """SELECT c_mktsegment, sum(c_acctbal_r) AS home_balance_sum, sum(s_acctbal_r) AS away_balance_sum,
              sum(coalesce(c_acctbal_r, 0) + coalesce(s_acctbal_r, 0))::BIGINT AS total_balance_sum,
              sum(c_nationkey)::BIGINT AS home_nation_sum, sum(s_nationkey)::BIGINT AS away_nation_sum,
              sum(coalesce(c_nationkey, 0) + coalesce(s_nationkey, 0))::BIGINT AS total_nation_sum
       FROM (SELECT c_mktsegment, c_nationkey, s_nationkey, CAST(floor(c_acctbal) AS BIGINT) AS c_acctbal_r,
                    CAST(floor(s_acctbal) AS BIGINT) AS s_acctbal_r
             FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey) GROUP BY 1"""
    .replace("sum(c_acctbal_r) AS", "sum(c_acctbal_r)::BIGINT AS")
    .replace("sum(s_acctbal_r) AS", "sum(s_acctbal_r)::BIGINT AS"),
)
def home_and_away(t: Tables) -> DataFrame:
    """Home, away and total columns generated from two lists."""
    pairs = enrich(
        t.customer, t.supplier, {"c_custkey": "s_suppkey"}, ["s_acctbal", "s_nationkey"], keep="fact"
    )
    wide = pairs.select(
        "c_mktsegment",
        F.floor("c_acctbal").alias("home_balance"),
        F.floor("s_acctbal").alias("away_balance"),
        F.col("c_nationkey").alias("home_nation"),
        F.col("s_nationkey").alias("away_nation"),
    )
    measures = symmetric_measures(["balance", "nation"], ["home", "away"])
    return wide.groupBy("c_mktsegment").agg(*[m.alias(n) for n, m in measures.items()])

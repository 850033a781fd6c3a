"""Projection, filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.catalog import Measure, star_select
from grainframe.functions import age_bucket, case_map, only_if, ratio, tag, traits
from grainframe.functions.conditions import AGE_BANDS
from grainframe.operators import (
    agg_by,
    apply_filter,
    count_keys,
    count_rows,
    decode,
    enrich,
    has_match,
    latest,
    replace_columns,
    select_hidden,
)
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables, star


def discounted() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def charged() -> Column:
    return discounted() * (1 + F.col("l_tax"))


def mean(column: str) -> Column:
    """Mean of an amount in cents; the rounded sum is exact, so every engine agrees."""
    return ratio(F.round(F.sum(column), 2), F.count(column))


PRICING_SUMMARY = """
SELECT l_returnflag AS return_flag, l_linestatus AS line_status,
       sum(l_quantity) AS sum_qty,
       round(sum(l_extendedprice), 2) AS base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 4) AS avg_qty,
       round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 4) AS avg_discount,
       round(avg(l_extendedprice * (1 - l_discount)), 4) AS avg_discounted_price,
       round(avg(l_extendedprice) - avg(l_extendedprice * (1 - l_discount)), 4) AS avg_disc,
       count(DISTINCT l_orderkey) AS count_order,
       count(*) AS count_rows
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '1998-12-01'
GROUP BY 1, 2
ORDER BY 1 DESC, 2 DESC"""


@query("pricing_summary", PRICING_SUMMARY)
def pricing_summary(t: Tables) -> DataFrame:
    """The flagship: sums, means, a distinct order count and an alias reused in the same select.

    With a single distinct count Spark combines all measures to (group, order)
    on the map side, so rows are not expanded and no group meets in one task.
    """
    lines = t.lineitem.filter(F.col("l_shipdate") <= F.lit("1998-12-01").cast("timestamp_ntz"))
    totals = lines.groupBy(
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status")
    ).agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("base_price"),
        F.round(F.sum(discounted()), 4).alias("sum_disc_price"),
        F.round(F.sum(charged()), 2).alias("sum_charge"),
        F.round(F.avg("l_quantity"), 4).alias("avg_qty"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.round(F.avg("l_discount"), 4).alias("avg_discount"),
        F.avg(discounted()).alias("avg_discounted_price"),
        count_keys("l_orderkey").alias("count_order"),
        count_rows().alias("count_rows"),
    )
    saved = F.col("avg_price") - F.col("avg_discounted_price")
    return (
        totals.withColumn("avg_disc", F.round(saved, 4))
        .withColumn("avg_price", F.round("avg_price", 4))
        .withColumn("avg_discounted_price", F.round("avg_discounted_price", 4))
        .orderBy(F.col("return_flag").desc_nulls_last(), F.col("line_status").desc_nulls_last())
    )


@query(
    "hidden_sort",
    """SELECT p_name, p_brand FROM part WHERE p_size > 40
       ORDER BY p_retailprice DESC, p_size, p_partkey LIMIT 50""",
)
def hidden_sort(t: Tables) -> DataFrame:
    """Columns that filter and sort but are not shown."""
    return select_hidden(
        t.part.select("p_name", "p_brand", "p_retailprice", "p_size", "p_partkey"),
        hidden=["p_retailprice", "p_size", "p_partkey"],
        having=F.col("p_size") > 40,
        order=[F.desc_nulls_last("p_retailprice"), F.asc_nulls_last("p_size"), F.asc("p_partkey")],
        limit=50,
    )


@query(
    "alias_reuse",
    """SELECT l_returnflag, round(avg(l_extendedprice), 4) AS avg_price,
              round(avg(l_extendedprice * (1 - l_discount)), 4) AS avg_discounted,
              round(round(avg(l_extendedprice), 4) - round(avg(l_extendedprice * (1 - l_discount)), 4), 4)
                AS avg_saving
       FROM lineitem GROUP BY 1""",
)
def alias_reuse(t: Tables) -> DataFrame:
    means = t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.round(F.avg(discounted()), 4).alias("avg_discounted"),
    )
    return means.withColumn("avg_saving", F.round(F.col("avg_price") - F.col("avg_discounted"), 4))


@query(
    "filter_on_alias",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
       WHERE year(o_orderdate) BETWEEN 1996 AND 1997""",
)
def filter_on_alias(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("order_year", F.year("o_orderdate"))
    return dated.filter(F.col("order_year").between(1996, 1997)).select("o_orderkey", "order_year")


@query(
    "having_count",
    """SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 12""",
)
def having_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(count_rows().alias("orders")).filter("orders > 12")


@query(
    "min_cost_supplier",
    """WITH offers AS (
         SELECT l_partkey, l_suppkey, s_name, n_name, l_extendedprice / l_quantity AS unit_price
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
         WHERE r_name = 'EUROPE')
       SELECT DISTINCT l_partkey AS part_id, l_suppkey AS supplier_id, s_name AS supplier,
              n_name AS nation, unit_price AS min_part_cost
       FROM offers o
       WHERE unit_price = (SELECT min(unit_price) FROM offers i WHERE i.l_partkey = o.l_partkey)""",
)
def min_cost_supplier(t: Tables) -> DataFrame:
    """European suppliers with the lowest price of a part; the minimum is taken among them.

    Lines are reduced to one price per part and supplier, and both the rows and
    the minimum come from that one exchange.
    """
    places = enrich(t.nation, t.region.filter("r_name = 'EUROPE'"), {"n_regionkey": "r_regionkey"}, [])
    lines = enrich(t.lineitem, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_name", "s_nationkey"])
    offers = enrich(lines, places, {"s_nationkey": "n_nationkey"}, ["n_name"]).select(
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier"),
        F.col("n_name").alias("nation"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    per_supplier = offers.groupBy("part_id", "supplier_id", "supplier", "nation").agg(
        F.min("unit_price").alias("cost")
    )
    cheapest = agg_by(per_supplier, {"min_part_cost": F.min("cost")}, ["part_id"])
    return select_hidden(
        cheapest, hidden=["cost"], having=F.col("cost") == F.col("min_part_cost")
    )


@query(
    "predicates",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE (l_quantity BETWEEN 10 AND 20 OR l_returnflag IN ('R'))
         AND l_linenumber NOT IN (1, 2) AND NOT (l_discount >= 0.05) AND l_linestatus <> 'O'""",
)
def predicates(t: Tables) -> DataFrame:
    either = F.col("l_quantity").between(10, 20) | F.col("l_returnflag").isin("R")
    rest = ~F.col("l_linenumber").isin(1, 2) & ~(F.col("l_discount") >= 0.05)
    kept = t.lineitem.filter(either & rest & (F.col("l_linestatus") != "O"))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "like_filter",
    """SELECT p_partkey, p_name, p_name LIKE 'small%' AS is_small FROM part WHERE p_name LIKE '%bolt%'""",
)
def like_filter(t: Tables) -> DataFrame:
    bolts = t.part.filter(F.col("p_name").like("%bolt%"))
    return bolts.select("p_partkey", "p_name", F.col("p_name").like("small%").alias("is_small"))


_FLAGS = """SELECT event_id,
                CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type = 'error' END AS dead,
                CASE WHEN event_id % 5 = 0 THEN NULL ELSE value > 20 END AS deleted
            FROM events"""


@query(
    "null_logic",
    f"""SELECT event_id, dead IS NULL AS dead_unknown, deleted IS NOT NULL AS deleted_known
        FROM ({_FLAGS}) WHERE NOT deleted AND NOT dead OR dead IS NULL AND deleted""",
)
def null_logic(t: Tables) -> DataFrame:
    """Unknown flags stay unknown: neither the flag nor its negation keeps the row."""
    flags = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, F.col("event_type") == "error").alias("dead"),
        F.when(F.col("event_id") % 5 != 0, F.col("value") > 20).alias("deleted"),
    )
    dead, deleted = F.col("dead"), F.col("deleted")
    kept = flags.filter((~deleted & ~dead) | (dead.isNull() & deleted))
    return kept.select(
        "event_id",
        dead.isNull().alias("dead_unknown"),
        deleted.isNotNull().alias("deleted_known"),
    )


def band_sql(column: str, bands, default: str) -> str:
    """CASE over bands with inclusive bounds, open where a bound is missing."""
    whens = " ".join(
        f"WHEN {column} >= {-(2**31) if low is None else low} AND {column} <= {2**31 if high is None else high}"
        f" THEN '{label}'"
        for low, high, label in bands
    )
    return f"CASE {whens} ELSE '{default}' END"


@query(
    "case_bucket",
    f"""SELECT p_partkey, {band_sql("p_size", AGE_BANDS, "unknown")} AS age_bucket,
              CASE WHEN p_size < 1 THEN '0-1' WHEN p_size < 10 THEN '1-10'
                   WHEN p_size < 100 THEN '10-100' ELSE '100+' END AS size_bin
       FROM part""",
)
def case_bucket(t: Tables) -> DataFrame:
    size = F.col("p_size")
    size_bin = (
        F.when(size < 1, "0-1").when(size < 10, "1-10").when(size < 100, "10-100").otherwise("100+")
    )
    return t.part.select(
        "p_partkey",
        age_bucket(size).alias("age_bucket"),
        size_bin.alias("size_bin"),
    )


@query(
    "case_nested",
    """SELECT o_orderkey,
              CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status,
              CASE WHEN o_orderstatus = 'F' THEN
                     CASE WHEN o_totalprice > 250000 THEN 'large filled' ELSE 'small filled' END
                   ELSE 'other' END AS kind
       FROM orders""",
)
def case_nested(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    size = F.when(F.col("o_totalprice") > 250000, "large filled").otherwise("small filled")
    return t.orders.select(
        "o_orderkey",
        case_map(status, {"F": "filled", "O": "open"}, status).alias("status"),
        F.when(status == "F", size).otherwise("other").alias("kind"),
    )


@query(
    "decode_lookup",
    """SELECT c_custkey, coalesce(n_name, 'unknown') AS nation
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0)
         ON c_nationkey = n_nationkey""",
)
def decode_lookup(t: Tables) -> DataFrame:
    names = t.nation.filter("n_regionkey <> 0")
    decoded = decode(t.customer, "c_nationkey", names, "n_nationkey", "n_name", "nation", "unknown")
    return decoded.select("c_custkey", "nation")


@query(
    "casts",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS code, CAST(o_orderdate AS DATE) AS order_date,
              CAST(o_totalprice AS DECIMAL(12, 2)) AS price, CAST(o_orderdate AS DATE) >= DATE '1998-01-01'
                AS is_late
       FROM orders""",
)
def casts(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("code"),
        day.alias("order_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        (day >= F.to_date(F.lit("1998-01-01"))).alias("is_late"),
    )


@query(
    "conditional_count",
    """SELECT event_type, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS big_users,
              count(CASE WHEN value > 50 THEN 1 END) AS big_events,
              round(sum(CASE WHEN value > 50 THEN value END), 2) AS big_value
       FROM events GROUP BY 1""",
)
def conditional_count(t: Tables) -> DataFrame:
    big = F.col("value") > 50
    return t.events.groupBy("event_type").agg(
        count_keys(only_if(F.col("user_id"), big)).alias("big_users"),
        F.count_if(big).alias("big_events"),
        F.round(F.sum(only_if(F.col("value"), big)), 2).alias("big_value"),
    )


@query(
    "latest_slice",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def latest_slice(t: Tables) -> DataFrame:
    return latest(t.orders, "o_orderdate").select("o_orderkey", "o_totalprice")


def per_item(amount: Column) -> Column:
    """A reusable expression: an amount per unit of quantity."""
    return ratio(amount, F.col("l_quantity"))


@query(
    "param_expr",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS unit_price,
              l_extendedprice * l_tax / nullif(l_quantity, 0) AS unit_tax
       FROM lineitem""",
)
def param_expr(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        per_item(F.col("l_extendedprice")).alias("unit_price"),
        per_item(F.col("l_extendedprice") * F.col("l_tax")).alias("unit_tax"),
    )


@query(
    "replace_columns",
    """SELECT s_suppkey, s_nationkey, nullif(s_name, 'Supplier#000000001') AS s_name,
              CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END AS standing
       FROM supplier""",
)
def replace_some_columns(t: Tables) -> DataFrame:
    return replace_columns(
        t.supplier,
        {
            "s_name": F.nullif("s_name", F.lit("Supplier#000000001")),
            "standing": F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit"),
        },
    ).drop("s_acctbal")


@query(
    "returned_flag",
    """SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
                AS was_returned
       FROM orders""",
)
def returned_flag(t: Tables) -> DataFrame:
    returns = t.lineitem.filter(F.col("l_returnflag") == "R")
    flagged = has_match(t.orders, returns, {"o_orderkey": "l_orderkey"}, "was_returned")
    return flagged.select("o_orderkey", "was_returned")


@query(
    "traits",
    """SELECT 'l_discount' AS column_name, 'percent' AS trait, count(l_discount) AS filled FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'usd', count(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_tax', 'percent', count(l_tax) FROM lineitem""",
)
def trait_report(t: Tables) -> DataFrame:
    """Columns found by their unit tag, with how many values they hold."""
    tagged = t.lineitem.select(
        "l_orderkey",
        tag(F.col("l_extendedprice"), "l_extendedprice", "usd"),
        tag(F.col("l_discount"), "l_discount", "percent"),
        tag(F.col("l_tax"), "l_tax", "percent"),
    )
    found = traits(tagged.filter("l_orderkey is not null"))
    items = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(trait).alias("trait"), F.count(c).alias("filled")
        )
        for c, trait in found.items()
    ]
    return tagged.agg(F.array(*items).alias("report")).select(F.inline("report"))


@query(
    "star_select_units",
    """WITH g AS (SELECT l_returnflag, sum(l_extendedprice) AS price, sum(l_extendedprice) / sum(l_quantity) AS per_piece,
                         count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1)
       SELECT 'price' AS column_name, 'usd' AS trait, count(price) AS filled FROM g
       UNION ALL SELECT 'taxed', 'usd', count(price) FROM g
       UNION ALL SELECT 'mean_tax', 'percent', count(price) FROM g
       UNION ALL SELECT 'per_piece', 'usd', count(per_piece) FROM g
       UNION ALL SELECT 'per_discount', 'usd/percent', count(price) FROM g
       UNION ALL SELECT 'orders', 'count', count(orders) FROM g""",
)
def star_select_units(t: Tables) -> DataFrame:
    """Units of aggregates, from those of the columns they are made of."""
    found = star_select(
        star(t),
        "lineitem",
        dims={"l_returnflag": "l_returnflag"},
        measures={
            "price": Measure.sum("l_extendedprice"),
            "taxed": Measure.product("l_extendedprice", "l_tax"),
            "mean_tax": Measure.avg("l_tax"),
            "per_piece": Measure.ratio("l_extendedprice", "l_quantity"),
            "per_discount": Measure.ratio("l_extendedprice", "l_discount"),
            "same": Measure.ratio("l_extendedprice", "l_extendedprice"),
            "orders": Measure.count_keys("l_orderkey"),
        },
    )
    items = [
        F.struct(F.lit(c).alias("column_name"), F.lit(trait).alias("trait"), F.count(c).alias("filled"))
        for c, trait in traits(found).items()
    ]
    return found.agg(F.array(*items).alias("report")).select(F.inline("report"))


POST_LINK = "https://example.org/orders/"


@query(
    "const_concat",
    f"""SELECT o_orderkey, '{POST_LINK}' || o_orderkey AS link FROM orders""",
)
def const_concat(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.concat(F.lit(POST_LINK), F.col("o_orderkey").cast("string")).alias("link")
    )


@query(
    "cross_filter",
    """SELECT 'flag' AS question, l_returnflag AS member, count(*) AS lines FROM lineitem
         WHERE l_linestatus = 'F' GROUP BY 2
       UNION ALL
       SELECT 'line', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem
         WHERE l_linestatus = 'F' GROUP BY 2""",
)
def cross_filter(t: Tables) -> DataFrame:
    """One filter applied to every query of a set."""

    def by(column: str, label: str):
        member = F.col(column).cast("string").alias("member")
        return lambda df: df.groupBy(member).agg(count_rows().alias("lines")).select(
            F.lit(label).alias("question"), "member", "lines"
        )

    pack = {"flag": by("l_returnflag", "flag"), "line": by("l_linenumber", "line")}
    results = apply_filter(pack, t.lineitem, F.col("l_linestatus") == "F")
    return results["flag"].unionByName(results["line"])

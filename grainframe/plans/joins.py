"""Joins, hierarchies and spatial joins."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Measure, star_select
from grainframe.functions import box_ring, month_start, root_domain, split_part
from grainframe.operators import (
    bridge,
    combine_facts,
    count_rows,
    drill_across,
    enrich,
    enrich_from_dim,
    keep_in,
    keep_not_in,
    link,
    link_all,
    points_in_polygons,
    ancestors,
    root_of,
    with_parent,
)
from grainframe.plans.projection import discounted, mean
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables, star


@query(
    "star_join",
    """SELECT p_type, count(*) AS lines, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def star_join(t: Tables) -> DataFrame:
    typed = enrich(t.lineitem, t.part, {"l_partkey": "p_partkey"}, ["p_type"])
    return typed.groupBy("p_type").agg(
        count_rows().alias("lines"), F.round(F.sum(discounted()), 4).alias("revenue")
    )


@query(
    "region_chain",
    """SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY 1, 2""",
)
def region_chain(t: Tables) -> DataFrame:
    """The chain starts at the fact, so each table is broadcast by its own file size.

    Joined among themselves first, the small tables would be estimated as the
    product of their sizes and the fact would be shuffled for nothing.
    """
    lines = enrich(t.lineitem, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    lines = enrich(lines, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    lines = enrich(lines, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return lines.groupBy("r_name", "n_name").agg(F.round(F.sum(discounted()), 4).alias("revenue"))


def revenue() -> Measure:
    return Measure(
        ("l_extendedprice", "l_discount"), lambda price, off: F.round(F.sum(price * (1 - off)), 4)
    )


@query(
    "star_select_rev_by_region",
    """SELECT r_name AS region, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
              count(DISTINCT l_orderkey) AS orders
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       WHERE l_quantity > 5
       GROUP BY 1 HAVING sum(l_extendedprice) > 0""",
)
def star_select_rev_by_region(t: Tables) -> DataFrame:
    return star_select(
        star(t),
        "lineitem",
        {"region": "supplier.nation.region.r_name"},
        {"revenue": revenue(), "orders": Measure.count_keys("l_orderkey")},
        where=[("l_quantity", lambda q: q > 5)],
        having=F.col("revenue") > 0,
    )


@query(
    "star_select_native",
    """WITH priced AS (SELECT DISTINCT l_returnflag, o_orderkey, o_totalprice
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT f.l_returnflag AS flag, f.quantity, p.total_price, p.orders
       FROM (SELECT l_returnflag, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1) f
       JOIN (SELECT l_returnflag, round(sum(o_totalprice), 2) AS total_price, count(*) AS orders
             FROM priced GROUP BY 1) p ON f.l_returnflag = p.l_returnflag""",
)
def star_select_native(t: Tables) -> DataFrame:
    """A line measure beside an order measure: each order counts once per flag."""
    return star_select(
        star(t),
        "lineitem",
        {"flag": "l_returnflag"},
        {
            "quantity": Measure(("l_quantity",), lambda q: F.round(F.sum(q), 2)),
            "total_price": Measure(("order.o_totalprice",), lambda p: F.round(F.sum(p), 2)),
            "orders": Measure(("order.o_orderkey",), F.count),
        },
    )


@query(
    "star_select_partial",
    """SELECT o_orderkey AS order_id, count(l_linenumber) AS lines, sum(l_quantity) AS quantity
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def star_select_partial(t: Tables) -> DataFrame:
    """Line items do not cover all orders, so orders without any stay with a zero count."""
    return star_select(
        star(t),
        "lineitem",
        {"order_id": "order.o_orderkey"},
        {"lines": Measure(("l_linenumber",), F.count, empty=0), "quantity": Measure.sum("l_quantity")},
    )


def _thin_star(t: Tables) -> Catalog:
    """The order star without customers of two nations and without orders of every fifth customer."""
    catalog = star(t)
    few = {
        "customer": F.col("c_nationkey") > 1,
        "orders": F.col("o_custkey") % 5 != 0,
    }
    for name, kept in few.items():
        held = catalog.datasets[name]
        catalog.register(replace(held, df=held.df.filter(kept)))
    return catalog


@query(
    "star_select_chain",
    """WITH f AS (SELECT c_nationkey, l_linenumber, l_quantity
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_custkey % 5 <> 0
                  JOIN customer ON o_custkey = c_custkey AND c_nationkey > 1)
       SELECT n_name AS nation, count(l_linenumber) AS lines, sum(l_quantity) AS quantity
       FROM nation LEFT JOIN f ON n_nationkey = c_nationkey GROUP BY 1""",
)
def star_select_chain(t: Tables) -> DataFrame:
    """Nations behind three partial edges; those without customers stay with a zero count."""
    return star_select(
        _thin_star(t),
        "lineitem",
        {"nation": "order.customer.nation.n_name"},
        {"lines": Measure(("l_linenumber",), F.count, empty=0), "quantity": Measure.sum("l_quantity")},
    )


@query(
    "star_select_chain_filtered",
    """WITH f AS (SELECT o_custkey, l_linenumber
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_custkey % 5 <> 0)
       SELECT c_custkey AS customer, n_name AS nation, count(l_linenumber) AS lines
       FROM customer JOIN nation ON c_nationkey = n_nationkey AND c_nationkey > 1
       LEFT JOIN f ON o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING' GROUP BY 1, 2""",
)
def star_select_chain_filtered(t: Tables) -> DataFrame:
    """Customers of one segment, without orders or with; the filter is behind their edge as well."""
    return star_select(
        _thin_star(t),
        "lineitem",
        {"customer": "order.customer.c_custkey", "nation": "order.customer.nation.n_name"},
        {"lines": Measure(("l_linenumber",), F.count, empty=0)},
        where=[("order.customer.c_mktsegment", lambda c: c == "BUILDING")],
    )


@query(
    "dim_preserving",
    """SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines,
              round(sum(l_extendedprice), 2) AS price
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
)
def dim_preserving(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return enrich_from_dim(
        orders,
        t.lineitem,
        {"o_orderkey": "l_orderkey"},
        {"lines": count_rows(), "price": F.round(F.sum("l_extendedprice"), 2)},
        zero=["lines"],
    )


_LOOSE = """(SELECT l_orderkey, l_linenumber, nullif(l_suppkey, 7) + 5 AS supp_ref FROM lineitem)"""


def loose_lines(t: Tables) -> DataFrame:
    """Line items whose supplier reference is null for one supplier and off by five.

    So some references dangle and some suppliers are never referenced.
    """
    reference = F.nullif("l_suppkey", F.lit(7)) + 5
    return t.lineitem.select("l_orderkey", "l_linenumber", reference.alias("supp_ref"))


@query(
    "fact_preserving",
    f"""SELECT s_name, count(*) AS lines FROM {_LOOSE} LEFT JOIN supplier ON supp_ref = s_suppkey
        GROUP BY 1""",
)
def fact_preserving(t: Tables) -> DataFrame:
    joined = enrich(loose_lines(t), t.supplier, {"supp_ref": "s_suppkey"}, ["s_name"], keep="fact")
    return joined.groupBy("s_name").agg(count_rows().alias("lines"))


@query(
    "both_preserving",
    f"""SELECT s_name, count(l_orderkey) AS lines FROM {_LOOSE} FULL JOIN supplier ON supp_ref = s_suppkey
        GROUP BY 1""",
)
def both_preserving(t: Tables) -> DataFrame:
    joined = enrich(loose_lines(t), t.supplier, {"supp_ref": "s_suppkey"}, ["s_name"], keep="all")
    return joined.groupBy("s_name").agg(F.count("l_orderkey").alias("lines"))


@query(
    "role_playing",
    """SELECT cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS lines
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation cn ON c_nationkey = cn.n_nationkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
       GROUP BY 1, 2""",
)
def role_playing(t: Tables) -> DataFrame:
    """Nation in two roles, told apart by prefix.

    Orders meet customers before lines do (both grow with the data, and lines
    are then shuffled once), lines are counted per pair of nation numbers, and
    names are looked up for the pairs that are left.
    """
    orders = enrich(t.orders, t.customer, {"o_custkey": "c_custkey"}, ["c_nationkey"])
    lines = enrich(t.lineitem, orders, {"l_orderkey": "o_orderkey"}, ["c_nationkey"])
    lines = enrich(lines, t.supplier, {"l_suppkey": "s_suppkey"}, ["s_nationkey"])
    pairs = lines.groupBy("c_nationkey", "s_nationkey").agg(count_rows().alias("lines"))
    pairs = enrich(pairs, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"], "customer_")
    pairs = enrich(pairs, t.nation, {"s_nationkey": "n_nationkey"}, ["n_name"], "supplier_")
    return pairs.select(
        F.col("customer_n_name").alias("customer_nation"),
        F.col("supplier_n_name").alias("supplier_nation"),
        "lines",
    )


@query(
    "composite_key",
    """WITH supply AS (SELECT l_partkey AS p, l_suppkey AS s, min(l_extendedprice / l_quantity) AS low
                       FROM lineitem GROUP BY 1, 2)
       SELECT l_returnflag, count(*) AS lines_at_lowest
       FROM lineitem JOIN supply ON l_partkey = p AND l_suppkey = s
       WHERE l_extendedprice / l_quantity = low GROUP BY 1""",
)
def composite_key(t: Tables) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    supply = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.min(unit).alias("low"))
    priced = enrich(t.lineitem, supply, ["l_partkey", "l_suppkey"], ["low"])
    return priced.filter(unit == F.col("low")).groupBy("l_returnflag").agg(
        count_rows().alias("lines_at_lowest")
    )


@query(
    "alternate_key",
    """SELECT c_custkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_name,
              count(*) AS orders
       FROM orders JOIN customer ON 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') = c_name
       GROUP BY 1, 2""",
)
def alternate_key(t: Tables) -> DataFrame:
    """Orders that know the customer by name, joined on the unique name."""
    code = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    orders = t.orders.groupBy(code.alias("customer_name")).agg(count_rows().alias("orders"))
    return enrich(orders, t.customer, {"customer_name": "c_name"}, ["c_custkey"])


_DOMAIN = r"""regexp_extract(regexp_extract({0}, 'https?://([^/]+)/', 1), '([^.]+\.[^.]+)$', 1)"""


@query(
    "derived_key_link",
    f"""WITH sites AS (SELECT nullif({_DOMAIN.format("url")}, '') AS domain, count(*) AS pages
                       FROM pages GROUP BY 1)
        SELECT page_id, nullif({_DOMAIN.format("url")}, '') AS page_domain, s.pages AS site_pages
        FROM pages LEFT JOIN sites s ON s.domain = nullif({_DOMAIN.format("url")}, '')""",
)
def derived_key_link(t: Tables) -> DataFrame:
    """Pages linked to site totals through the domain extracted on both sides."""
    domain = root_domain(F.col("url"))
    sites = t.pages.groupBy(domain.alias("domain")).agg(count_rows().alias("pages"))
    joined = link(
        t.pages.select("page_id", "url"), sites, domain, F.col("domain"), ["pages"], "site_"
    )
    return joined.select("page_id", domain.alias("page_domain"), "site_pages")


@query(
    "name_part_link",
    """SELECT c_mktsegment, count(s_suppkey) AS suppliers, count(*) AS customers
       FROM customer LEFT JOIN supplier
         ON CAST(split_part(c_name, '#', 2) AS BIGINT) = CAST(split_part(s_name, '#', 2) AS BIGINT)
       GROUP BY 1""",
)
def name_part_link(t: Tables) -> DataFrame:
    """Two models linked on a part of a name."""

    def number(c: str):
        return split_part(F.col(c), "#", 2).cast("long")

    joined = link(t.customer, t.supplier, number("c_name"), number("s_name"), ["s_suppkey"])
    return joined.groupBy("c_mktsegment").agg(
        F.count("s_suppkey").alias("suppliers"), count_rows().alias("customers")
    )


@query(
    "link_all",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def link_all_columns(t: Tables) -> DataFrame:
    return link_all(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query(
    "bridge",
    """SELECT s_name, count(*) AS parts, round(sum(p_retailprice), 2) AS catalog_value
       FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def bridge_parts(t: Tables) -> DataFrame:
    """Parts and suppliers through line items; each pair counts once."""
    joined = bridge(
        t.part.select("p_partkey", "p_retailprice"),
        t.lineitem,
        t.supplier.select("s_suppkey", "s_name"),
        {"l_partkey": "p_partkey"},
        {"l_suppkey": "s_suppkey"},
    )
    return joined.groupBy("s_name").agg(
        count_rows().alias("parts"), F.round(F.sum("p_retailprice"), 2).alias("catalog_value")
    )


_TREE = """(SELECT event_id, event_type, CASE WHEN event_id > 1 THEN event_id // 2 END AS parent FROM events)"""


def _tree(t: Tables) -> DataFrame:
    parent = F.when(F.col("event_id") > 1, F.floor(F.col("event_id") / 2).cast("long"))
    return t.events.select("event_id", "event_type", parent.alias("parent"))


@query(
    "direct_parent",
    f"""SELECT c.event_id, c.parent, p.event_type AS parent_event_type
        FROM {_TREE} c LEFT JOIN {_TREE} p ON c.parent = p.event_id""",
)
def direct_parent(t: Tables) -> DataFrame:
    joined = with_parent(_tree(t), "event_id", "parent", ["event_type"])
    return joined.select("event_id", "parent", "parent_event_type")


@query(
    "hierarchy_root",
    f"""WITH RECURSIVE tree AS (SELECT * FROM {_TREE}),
        walk AS (SELECT event_id, event_id AS root, CAST(0 AS BIGINT) AS depth FROM tree WHERE parent IS NULL
                 UNION ALL
                 SELECT t.event_id, w.root, w.depth + 1 FROM tree t JOIN walk w ON t.parent = w.event_id)
        SELECT event_id, root, depth FROM walk""",
)
def hierarchy_root(t: Tables) -> DataFrame:
    return root_of(_tree(t), "event_id", "parent").select("event_id", "root", "depth")


@query(
    "hierarchy_ancestors",
    f"""WITH RECURSIVE tree AS (SELECT * FROM {_TREE}),
        up AS (SELECT event_id, parent AS ancestor, 1 AS distance FROM tree WHERE parent IS NOT NULL
               UNION ALL
               SELECT u.event_id, t.parent, u.distance + 1 FROM up u JOIN tree t ON u.ancestor = t.event_id
               WHERE t.parent IS NOT NULL AND u.distance < 6)
        SELECT event_id, ancestor, distance, false AS repeats FROM up""",
)
def hierarchy_ancestors(t: Tables) -> DataFrame:
    """All ancestors up to six levels above each event."""
    return ancestors(_tree(t), "event_id", "parent", 6)


_BY_FLAG = "SELECT l_partkey, count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem WHERE l_returnflag {0} 'R' GROUP BY 1"


@query(
    "sales_vs_returns",
    f"""SELECT coalesce(s.l_partkey, r.l_partkey) AS l_partkey, s.n AS sold_lines, s.q AS sold_quantity,
               r.n AS returned_lines, r.q AS returned_quantity
        FROM ({_BY_FLAG.format("<>")}) s FULL JOIN ({_BY_FLAG.format("=")}) r ON s.l_partkey = r.l_partkey""",
)
def sales_vs_returns(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"

    def totals(name: str):
        return {
            f"{name}_lines": count_rows(),
            f"{name}_quantity": F.round(F.sum("l_quantity"), 2),
        }

    return combine_facts(
        [(t.lineitem.filter(~returned), totals("sold")), (t.lineitem.filter(returned), totals("returned"))],
        ["l_partkey"],
    )


@query(
    "drill_across",
    """WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS orders,
                         round(sum(o_totalprice), 2) AS ordered FROM orders GROUP BY 1),
            l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, count(*) AS lines,
                         round(sum(l_extendedprice), 2) AS shipped FROM lineitem GROUP BY 1)
       SELECT coalesce(o.m, l.m) AS "month", orders, ordered, lines, shipped,
              coalesce(orders, 0) + coalesce(lines, 0) AS movements
       FROM o FULL JOIN l ON o.m = l.m""",
)
def drill_across_months(t: Tables) -> DataFrame:
    return drill_across(
        [
            (
                t.orders,
                month_start(F.col("o_orderdate")),
                {"orders": count_rows(), "ordered": F.round(F.sum("o_totalprice"), 2)},
            ),
            (
                t.lineitem,
                month_start(F.col("l_shipdate")),
                {"lines": count_rows(), "shipped": F.round(F.sum("l_extendedprice"), 2)},
            ),
        ],
        "month",
        {"movements": F.coalesce("orders", F.lit(0)) + F.coalesce("lines", F.lit(0))},
    )


@query(
    "anti_membership",
    """SELECT p_partkey, p_name FROM part
       WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48 AND l_partkey IS NOT NULL)""",
)
def anti_membership(t: Tables) -> DataFrame:
    bulk = t.lineitem.filter("l_quantity > 48")
    return keep_not_in(t.part, "p_partkey", bulk, "l_partkey").select("p_partkey", "p_name")


@query(
    "semi_membership",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def semi_membership(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 400000")
    return keep_in(t.customer, "c_custkey", large, "o_custkey").select("c_custkey", "c_name")


@query(
    "attribute_enrich",
    """WITH brands AS (SELECT p_brand, count(*) AS brand_parts, round(sum(p_retailprice), 2) / count(*) AS brand_price
                       FROM part GROUP BY 1)
       SELECT p_partkey, p.p_brand, brand_parts, brand_price
       FROM part p LEFT JOIN brands b ON p.p_brand = b.p_brand""",
)
def attribute_enrich(t: Tables) -> DataFrame:
    """A table of brand facts hung onto the brand of each part."""
    brands = t.part.groupBy("p_brand").agg(
        count_rows().alias("brand_parts"), mean("p_retailprice").alias("brand_price")
    )
    return enrich(t.part.select("p_partkey", "p_brand"), brands, "p_brand", keep="fact")


# Overlapping boxes, one per nation; the SQL tests them as ranges.
_ZONES = """SELECT n_nationkey AS zone, n_name AS zone_name,
                   CAST(n_nationkey * 2000 AS DOUBLE) AS x0, CAST(n_nationkey * 2000 + 3000 AS DOUBLE) AS x1,
                   CAST(n_regionkey * 20000 - 1000 AS DOUBLE) AS y0,
                   CAST(n_regionkey * 20000 + 29000 AS DOUBLE) AS y1
            FROM nation"""


def _zones(t: Tables) -> DataFrame:
    x0, y0 = F.col("n_nationkey") * 2000, F.col("n_regionkey") * 20000 - 1000
    return t.nation.select(
        F.col("n_nationkey").alias("zone"),
        F.col("n_name").alias("zone_name"),
        box_ring(x0, y0, x0 + 3000, y0 + 30000).alias("ring"),
    )


@query(
    "point_in_polygon",
    f"""SELECT z.zone_name, count(*) AS lines
        FROM lineitem l JOIN ({_ZONES}) z
          ON l_quantity * 1000 >= x0 AND l_quantity * 1000 < x1 AND l_extendedprice >= y0 AND l_extendedprice < y1
        GROUP BY 1""",
)
def point_in_polygon(t: Tables) -> DataFrame:
    """Line items as points (quantity, price) in overlapping zones."""
    points = t.lineitem.select(
        (F.col("l_quantity") * 1000).alias("x"), F.col("l_extendedprice").alias("y")
    )
    inside = points_in_polygons(points, _zones(t), cell=1000.0)
    return inside.groupBy("zone_name").agg(count_rows().alias("lines"))


@query(
    "point_in_polygon_left",
    f"""SELECT p.p_partkey, z.zone_name
        FROM part p LEFT JOIN ({_ZONES}) z
          ON p_size * 1000 >= x0 AND p_size * 1000 < x1 AND p_retailprice * 20 >= y0 AND p_retailprice * 20 < y1""",
)
def point_in_polygon_left(t: Tables) -> DataFrame:
    """Points without a zone stay."""
    points = t.part.select(
        "p_partkey",
        (F.col("p_size") * 1000.0).alias("x"),
        (F.col("p_retailprice") * 20).alias("y"),
    )
    joined = points_in_polygons(points, _zones(t), cell=1000.0, point_key="p_partkey", how="left")
    return joined.select("p_partkey", "zone_name")


# Zones of two parts, the first with a hole: outer box, hole, second part.
_RINGS = """(SELECT 'ring' AS zone_name, 0 AS x0, 0 AS y0, 40000 AS x1, 60000 AS y1, 10000 AS hx0, 20000 AS hy0,
                    30000 AS hx1, 50000 AS hy1, 45000 AS px0, 10000 AS py0, 50000 AS px1, 90000 AS py1
             UNION ALL SELECT 'low', 5000, 5000, 20000, 15000, 8000, 7000, 12000, 9000, 30000, 5000, 45000, 8000)"""


def _ring_zones(t: Tables) -> DataFrame:
    def box(*at: float) -> Column:
        return box_ring(*[F.lit(float(v)) for v in at])

    zones = [
        ("ring", (0, 0, 40000, 60000), (10000, 20000, 30000, 50000), (45000, 10000, 50000, 90000)),
        ("low", (5000, 5000, 20000, 15000), (8000, 7000, 12000, 9000), (30000, 5000, 45000, 8000)),
    ]
    frames = [
        t.spark.range(1).select(F.lit(name).alias("zone_name"), F.array(box(*hole), box(*outer), box(*part)).alias("rings"))
        for name, outer, hole, part in zones
    ]
    return frames[0].unionByName(frames[1])


@query(
    "point_in_rings",
    f"""SELECT z.zone_name, count(*) AS lines
        FROM (SELECT l_quantity * 1000 AS x, l_extendedprice AS y FROM lineitem) l JOIN {_RINGS} z
          ON (x >= x0 AND x < x1 AND y >= y0 AND y < y1 AND NOT (x >= hx0 AND x < hx1 AND y >= hy0 AND y < hy1))
          OR (x >= px0 AND x < px1 AND y >= py0 AND y < py1)
        GROUP BY 1""",
)
def point_in_rings(t: Tables) -> DataFrame:
    """Line items as points (quantity, price) in zones of two parts, one part with a hole."""
    points = t.lineitem.select((F.col("l_quantity") * 1000).alias("x"), F.col("l_extendedprice").alias("y"))
    inside = points_in_polygons(points, _ring_zones(t), cell=1000.0, ring="rings")
    return inside.groupBy("zone_name").agg(count_rows().alias("lines"))

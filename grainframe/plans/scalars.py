"""Scalar, list and geometry functions, grouped by family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.functions import (
    add_units,
    box_ring,
    calc_percent,
    capital_first,
    date_from_parts,
    day_name,
    day_of_week,
    explode_list,
    fuzzy_date,
    has_tag,
    hash_color,
    julian_to_date,
    month_start,
    regexp_group,
    ring_area,
    ring_centroid,
    rings_area,
    rings_centroid,
    root_domain,
    sort_desc,
    split_part,
    strip_flag,
    tag_map,
    tag_value,
    unless_sentinel,
    within_last,
    year_diff,
)
from grainframe.operators import count_rows
from grainframe.plans.registry import query
from grainframe.plans.tables import Tables


@query(
    "str_basic",
    """SELECT p_partkey, p_brand || ' ' || p_type AS label, upper(p_name) AS up, lower(p_type) AS low,
              upper(substr(p_name, 1, 1)) || substr(p_name, 2) AS capital, CAST(length(p_name) AS INTEGER) AS len,
              substring(p_name, 2, 3) AS part, CAST(strpos(p_name, 'bolt') AS INTEGER) AS bolt_at
       FROM part""",
)
def str_basic(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.concat("p_brand", F.lit(" "), "p_type").alias("label"),
        F.upper(name).alias("up"),
        F.lower("p_type").alias("low"),
        capital_first(name).alias("capital"),
        F.length(name).alias("len"),
        F.substring(name, 2, 3).alias("part"),
        F.instr(name, "bolt").alias("bolt_at"),
    )


_DIRTY = """(SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'NA??' WHEN o_orderkey % 4 = 1
               THEN o_orderpriority || '?' ELSE '  ' || o_orderpriority || ' ' END AS raw FROM orders)"""


@query(
    "str_clean",
    f"""SELECT o_orderkey, trim(raw) AS trimmed,
               CASE WHEN rtrim(raw, '?') = 'NA' THEN '-' ELSE rtrim(raw, '?') END AS plain,
               replace(raw, '?', '') AS replaced FROM {_DIRTY}""",
)
def str_clean(t: Tables) -> DataFrame:
    key, text = F.col("o_orderkey"), F.col("o_orderpriority")
    raw = (
        F.when(key % 4 == 0, F.lit("NA??"))
        .when(key % 4 == 1, F.concat(text, F.lit("?")))
        .otherwise(F.concat(F.lit("  "), text, F.lit(" ")))
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey",
        F.trim("raw").alias("trimmed"),
        strip_flag(F.col("raw")).alias("plain"),
        F.replace("raw", F.lit("?"), F.lit("")).alias("replaced"),
    )


@query(
    "str_split",
    """SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS first,
              string_split(o_orderpriority, '-')[2] AS second, string_split(o_orderpriority, '-')[3] AS third,
              string_split(o_orderpriority, ' ')[-1] AS last
       FROM orders""",
)
def str_split(t: Tables) -> DataFrame:
    text = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        split_part(text, "-", 1).alias("first"),
        split_part(text, "-", 2).alias("second"),
        split_part(text, "-", 3).alias("third"),
        split_part(text, " ", -1).alias("last"),
    )


@query(
    "url_domain",
    r"""SELECT page_id, nullif(regexp_extract(regexp_extract(url, 'https?://([^/]+)/', 1),
                                              '([^.]+\.[^.]+)$', 1), '') AS domain,
               nullif(lower(regexp_extract(url, '(https?://[^/]+/[^/]+)', 1)), '') AS section_url,
               nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS campaign
        FROM pages""",
)
def url_domain(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id",
        root_domain(url).alias("domain"),
        F.lower(regexp_group(url, "(https?://[^/]+/[^/]+)")).alias("section_url"),
        regexp_group(url, "[?&]utm_source=([^&#]+)").alias("campaign"),
    )


@query(
    "null_fns",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
              coalesce(nullif(c_mktsegment, 'BUILDING'), nullif(c_name, 'Customer#000000000'), 'none') AS label,
              CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS kept
       FROM customer""",
)
def null_fns(t: Tables) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    name = F.nullif("c_name", F.lit("Customer#000000000"))
    return t.customer.select(
        "c_custkey",
        segment.alias("segment"),
        F.coalesce(segment, name, F.lit("none")).alias("label"),
        unless_sentinel(F.col("c_mktsegment"), "BUILDING", "MACHINERY").alias("kept"),
    )


@query(
    "hash_color",
    """SELECT p_brand, parts, printf('#%02x%02x%02x', base, base, other) AS color FROM (
         SELECT p_brand, parts, code % 200 + 48 AS base, (code % 200 + 97) % 200 + 48 AS other FROM (
           SELECT p_brand, count(*) AS parts, CAST('0x' || substr(md5(p_brand), 1, 8) AS BIGINT) AS code
           FROM part GROUP BY 1))""",
)
def hash_colors(t: Tables) -> DataFrame:
    """A colour per brand."""
    brands = t.part.groupBy("p_brand").agg(count_rows().alias("parts"))
    return brands.withColumn("color", hash_color(F.col("p_brand")))


@query(
    "math_fns",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice / 3, 4) AS third,
              floor(l_extendedprice + 0.5) AS whole, round(log10(l_extendedprice), 6) AS log_price,
              round(log10(CASE WHEN l_tax = 0 THEN 1 ELSE l_tax END), 6) AS log_tax,
              abs(l_quantity - 25) AS distance, CAST(l_orderkey % 7 AS BIGINT) AS week_part,
              l_quantity * 2 - 1 AS odd
       FROM lineitem""",
)
def math_fns(t: Tables) -> DataFrame:
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(price / 3, 4).alias("third"),
        F.floor(price + 0.5).cast("double").alias("whole"),  # halves go up, whatever their last bit
        F.round(F.log10(price), 6).alias("log_price"),
        F.round(F.log(10.0, F.when(tax == 0, 1.0).otherwise(tax)), 6).alias("log_tax"),
        F.abs(F.col("l_quantity") - 25).alias("distance"),
        F.pmod("l_orderkey", F.lit(7)).alias("week_part"),
        (F.col("l_quantity") * 2 - 1).alias("odd"),
    )


@query(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
              CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h, CAST(ts AS DATE) AS event_date,
              CAST(dayofweek(ts) AS INTEGER) AS weekday, dayname(ts) AS weekday_name,
              CAST(date_trunc('month', ts) AS DATE) AS month_start
       FROM events""",
)
def date_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.dayofmonth(ts).alias("d"),
        F.hour(ts).alias("h"),
        F.to_date(ts).alias("event_date"),
        day_of_week(ts).alias("weekday"),
        day_name(ts).alias("weekday_name"),
        month_start(ts).alias("month_start"),
    )


@query(
    "date_math",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 DAY AS DATE) AS plus_days,
              CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS minus_month,
              CAST(CAST(o_orderdate AS DATE) + INTERVAL 100 YEAR AS DATE) AS plus_century,
              CAST(date_diff('year', o_orderdate, TIMESTAMP '2002-06-30') AS INTEGER) AS years,
              CAST(o_orderdate AS DATE) BETWEEN DATE '1999-06-30' AND DATE '2002-06-30' AS is_recent,
              try_cast(year(o_orderdate) || '-' || month(o_orderdate) || '-' || (o_orderkey % 31 + 1) AS DATE)
                AS from_parts
       FROM orders""",
)
def date_math(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    day_number = (F.col("o_orderkey") % 31 + 1).cast("int")
    return t.orders.select(
        "o_orderkey",
        add_units(day, "day", 10).alias("plus_days"),
        add_units(day, "month", -1).alias("minus_month"),
        add_units(day, "year", 100).alias("plus_century"),
        year_diff(day, F.to_date(F.lit("2002-06-30"))).alias("years"),
        within_last(day, "year", 3, "2002-06-30").alias("is_recent"),
        date_from_parts(F.year(day), F.month(day), day_number).alias("from_parts"),
    )


@query(
    "julian_date",
    """SELECT o_orderkey, CAST(DATE '1900-01-01' + CAST(CAST(jd AS DOUBLE) - 2415021 AS INTEGER) AS DATE)
                AS order_day
       FROM (SELECT o_orderkey,
                    CAST(date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) + 2415021
                         + (o_orderkey % 10) / 10.0 AS VARCHAR) AS jd FROM orders)""",
)
def julian_dates(t: Tables) -> DataFrame:
    """Julian days with a fraction, as text, back to dates."""
    days = F.date_diff(F.to_date("o_orderdate"), F.to_date(F.lit("1900-01-01"))) + 2415021
    text = (days + (F.col("o_orderkey") % 10) / 10.0).cast("string")
    return t.orders.select("o_orderkey", text.alias("jd")).select(
        "o_orderkey", julian_to_date(F.col("jd")).alias("order_day")
    )


@query(
    "fuzzy_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_day
       FROM orders""",
)
def fuzzy_dates(t: Tables) -> DataFrame:
    """Dates written in the free forms seen in catalogues, read back."""
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 5
    plain = F.date_format(day, "yyyy MMM d")
    padded = F.concat(
        F.date_format(day, "yyyy MMM "), F.lpad(F.dayofmonth(day).cast("string"), 2, " ")
    )
    text = (
        F.when(kind == 0, plain)
        .when(kind == 1, padded)
        .when(kind == 2, F.concat(plain, F.lit(" 2342?")))
        .when(kind == 3, F.concat(plain, F.lit("?")))
        .otherwise(F.lit("-"))
    )
    return t.orders.select("o_orderkey", fuzzy_date(text).alias("order_day"))


@query(
    "explode_split",
    r"""SELECT lang, count(*) AS lines, count(DISTINCT line) AS distinct_lines
        FROM (SELECT lang, trim(unnest(string_split(text, chr(10)))) AS line FROM documents)
        GROUP BY 1""",
)
def explode_split(t: Tables) -> DataFrame:
    """Lines of whole documents as rows."""
    lines = explode_list(t.documents.select("lang", "text"), "text", "\n", "line")
    return lines.groupBy("lang").agg(
        count_rows().alias("lines"), F.count_distinct("line").alias("distinct_lines")
    )


@query(
    "explode_struct",
    """SELECT p_partkey, 1 AS place, string_split(p_name, ' ')[1] AS word FROM part
       UNION ALL SELECT p_partkey, 2, string_split(p_name, ' ')[2] FROM part""",
)
def explode_struct(t: Tables) -> DataFrame:
    """An array of records unfolded to rows and columns."""
    words = F.transform(
        F.split("p_name", " "),
        lambda w, i: F.struct((i + 1).alias("place"), w.alias("word")),
    )
    return t.part.select("p_partkey", F.inline(words))


_NUMS = "list_value(l_linenumber, l_orderkey % 5, l_partkey % 9)"


@query(
    "array_fns",
    f"""SELECT l_orderkey, l_linenumber, array_to_string(list_reverse_sort({_NUMS}), ',') AS sorted_desc,
               array_to_string(list_filter({_NUMS}, lambda x: x > 2), ',') AS kept,
               array_to_string(list_transform({_NUMS}, lambda x: x * 10), ',') AS scaled,
               array_to_string(list_sort(list_distinct({_NUMS})), ',') AS unique_values,
               l_quantity
        FROM lineitem""",
)
def array_fns(t: Tables) -> DataFrame:
    """Sort, filter, map and distinct over lists; functions are passed as lambdas."""
    numbers = F.array(
        F.col("l_linenumber").cast("long"), F.col("l_orderkey") % 5, F.col("l_partkey") % 9
    )

    def text(items):
        return F.array_join(items.cast("array<string>"), ",")

    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        text(sort_desc(numbers)).alias("sorted_desc"),
        text(F.filter(numbers, lambda x: x > 2)).alias("kept"),
        text(F.transform(numbers, lambda x: x * 10)).alias("scaled"),
        text(F.array_sort(F.array_distinct(F.array_compact(numbers)))).alias("unique_values"),
        "l_quantity",
    )


@query(
    "tag_lookup",
    """SELECT o_orderkey, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS missing,
              o_orderstatus = 'F' AS is_filled, true AS has_status,
              CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' END AS urgent
       FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'F'""",
)
def tag_lookup(t: Tables) -> DataFrame:
    """Lookups in a list of key/value tags."""

    def pair(key: str, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("yes"))
    tags = F.array(
        pair("status", F.col("o_orderstatus")),
        pair("priority", F.col("o_orderpriority")),
        pair("urgent", urgent),
    )
    tagged = t.orders.select("o_orderkey", tags.alias("tags"))
    all_tags = F.col("tags")
    kept = tagged.filter(has_tag(all_tags, "urgent") | has_tag(all_tags, "status", "F"))
    return kept.select(
        "o_orderkey",
        tag_value(all_tags, "priority").alias("priority"),
        tag_value(all_tags, "nothing").alias("missing"),
        has_tag(all_tags, "status", "F").alias("is_filled"),
        has_tag(all_tags, "status").alias("has_status"),
        tag_map(all_tags).getItem("urgent").alias("urgent"),
    )


@query(
    "polygon_measures",
    """SELECT c_nationkey, round((x1 - x0) * (y1 - y0), 2) AS area, round((x0 + x1) / 2, 4) AS center_x,
              round((y0 + y1) / 2, 4) AS center_y
       FROM (SELECT c_nationkey, CAST(min(c_custkey) AS DOUBLE) AS x0, CAST(max(c_custkey) + 1 AS DOUBLE) AS x1,
                    min(c_acctbal) AS y0, max(c_acctbal) + 1 AS y1 FROM customer GROUP BY 1)""",
)
def polygon_measures(t: Tables) -> DataFrame:
    """Area and centroid of each nation's box over (customer number, balance)."""
    boxes = t.customer.groupBy("c_nationkey").agg(
        box_ring(
            F.min("c_custkey"), F.min("c_acctbal"), F.max("c_custkey") + 1, F.max("c_acctbal") + 1
        ).alias("ring")
    )
    center = ring_centroid(F.col("ring"))
    return boxes.select(
        "c_nationkey",
        F.round(ring_area(F.col("ring")), 2).alias("area"),
        F.round(center.getField("x"), 4).alias("center_x"),
        F.round(center.getField("y"), 4).alias("center_y"),
    )


@query(
    "rings_measures",
    """SELECT c_nationkey, round(w * h * 1.75, 4) AS area,
              round((w * h * (x0 + w / 2) * 0.75 + w * h * (x0 + w * 2.5)) / (w * h * 1.75), 4) AS center_x,
              round(y0 + h / 2, 4) AS center_y
       FROM (SELECT *, x1 - x0 AS w, y1 - y0 AS h
             FROM (SELECT c_nationkey, CAST(min(c_custkey) AS DOUBLE) AS x0, CAST(max(c_custkey) + 1 AS DOUBLE) AS x1,
                          min(c_acctbal) AS y0, max(c_acctbal) + 1 AS y1 FROM customer GROUP BY 1))""",
)
def rings_measures(t: Tables) -> DataFrame:
    """Each nation's box with a hole in its middle, and a second part beside it."""
    boxes = t.customer.groupBy("c_nationkey").agg(
        F.min("c_custkey").cast("double").alias("x0"),
        F.min("c_acctbal").alias("y0"),
        (F.max("c_custkey") + 1).cast("double").alias("x1"),
        (F.max("c_acctbal") + 1).alias("y1"),
    )
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    w, h = x1 - x0, y1 - y0
    rings = F.array(
        box_ring(x0 + w / 4, y0 + h / 4, x1 - w / 4, y1 - h / 4), box_ring(x0, y0, x1, y1), box_ring(x1 + w, y0, x1 + w * 2, y1)
    )
    shaped = boxes.select("c_nationkey", rings.alias("rings"))
    center = rings_centroid(F.col("rings"))
    return shaped.select(
        "c_nationkey",
        F.round(rings_area(F.col("rings")), 4).alias("area"),
        F.round(center.getField("x"), 4).alias("center_x"),
        F.round(center.getField("y"), 4).alias("center_y"),
    )


@query(
    "calc_percent",
    """SELECT o_orderpriority,
              round(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*)::DOUBLE, 2) * 100 AS filled_pct
       FROM orders GROUP BY 1""",
)
def filled_percent(t: Tables) -> DataFrame:
    filled = F.count_if(F.col("o_orderstatus") == "F")
    return t.orders.groupBy("o_orderpriority").agg(
        (calc_percent(filled, count_rows(), 2) * 100).alias("filled_pct")
    )

"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Dataset
from grainframe.plans.registry import query
from grainframe.plans.tables import SCHEMAS, Tables
from grainframe.session import scratch_path
from grainframe.sources import (
    RollupMeasure,
    append_new,
    bind,
    bind_nested,
    csv_to_parquet,
    distinct_read,
    distinct_write,
    export,
    freshness,
    load,
    lookup_from_json,
    materialize,
    pick_source,
    refresh,
    refresh_partitions,
    rollup_read,
    rollup_write,
    scan_csv,
    scan_parquet,
    scan_quoted,
    scan_tsv,
    view,
    write_bucketed,
)


@query(
    "scan_project",
    """SELECT l_orderkey AS order_id, l_partkey AS part_id, l_extendedprice AS price
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'""",
)
def scan_project(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate"]
    path = f"{t.folder}/lineitem.parquet"
    df = scan_parquet(t.spark, path, columns, SCHEMAS["lineitem"])
    recent = df.filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return recent.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_extendedprice").alias("price"),
    )


@query(
    "scan_csv_roundtrip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def scan_csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-csv")
    t.orders.write.option("header", "true").csv(path)
    return scan_csv(t.spark, path, SCHEMAS["orders"])


@query(
    "scan_tsv_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def scan_tsv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-tsv")
    t.customer.write.option("header", "true").option("sep", "\t").csv(path)
    return scan_tsv(t.spark, path, SCHEMAS["customer"])


@query("scan_csv_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_documents(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes through CSV and back."""
    path = scratch_path(t.spark, "documents-csv")
    writer = t.documents.write.option("header", "true").option("escape", '"')
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer.options(**kept).csv(path)
    return scan_csv(t.spark, path, SCHEMAS["documents"])


def _as_text(t: Tables, label: str, sep: str = ",") -> str:
    """The documents as delimited text with line breaks and quotes inside fields."""
    path = scratch_path(t.spark, label)
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    t.documents.write.options(header="true", sep=sep, **kept).csv(path)
    return path


@query("scan_quoted_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_quoted_documents(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes through CSV and back, a task per file split."""
    return scan_quoted(t.spark, _as_text(t, "documents-quoted"), SCHEMAS["documents"])


@query(
    "scan_quoted_inferred",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def scan_quoted_inferred(t: Tables) -> DataFrame:
    """The same as tab-separated text without a schema; whole numbers are widened to those of the table."""
    read = scan_quoted(t.spark, _as_text(t, "documents-quoted-tsv", "\t"), sep="\t")
    wide = {c: F.col(c).cast("long") for c in ("doc_id", "n_chars")}
    return read.withColumns(wide)


@query("scan_csv_inferred", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def scan_csv_inferred(t: Tables) -> DataFrame:
    """Types from the whole file; whole numbers and times are widened to those of the table."""
    path = scratch_path(t.spark, "orders-inferred")
    t.orders.write.option("header", "true").csv(path)
    whole, time = F.col("o_orderkey").cast("long"), F.col("o_orderdate").cast("timestamp_ntz")
    read = scan_csv(t.spark, path)
    return read.select(
        whole.alias("o_orderkey"), "o_orderstatus", "o_totalprice", time.alias("o_orderdate")
    )


@query("scan_tsv_inferred", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_tsv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-inferred")
    t.customer.write.option("header", "true").option("sep", "\t").csv(path)
    read = scan_tsv(t.spark, path)
    return read.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal")


@query(
    "bind_columns",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id,
              c_acctbal AS account_balance FROM customer""",
)
def bind_columns(t: Tables) -> DataFrame:
    return bind(
        t.customer,
        {
            "c_custkey": "id",
            "c_name": "name",
            "c_nationkey": "nation_id",
            "c_acctbal": "account_balance",
        },
    )


@query(
    "bind_computed",
    """SELECT l_orderkey || '-' || l_linenumber AS row_key, upper(l_returnflag || l_linestatus) AS state,
              l_quantity > 25 AS is_bulk,
              CASE WHEN l_discount > 0.05 THEN 'deep' ELSE 'flat' END AS discount_kind,
              CAST(l_suppkey AS VARCHAR) AS supplier_code
       FROM lineitem""",
)
def bind_computed(t: Tables) -> DataFrame:
    return bind(
        t.lineitem,
        {},
        {
            "row_key": F.concat_ws("-", "l_orderkey", "l_linenumber"),
            "state": F.upper(F.concat("l_returnflag", "l_linestatus")),
            "is_bulk": F.col("l_quantity") > 25,
            "discount_kind": "CASE WHEN l_discount > 0.05D THEN 'deep' ELSE 'flat' END",
            "supplier_code": F.col("l_suppkey").cast("string"),
        },
    )


@query(
    "bind_repeat",
    """SELECT o_orderkey AS id, o_orderkey AS ticket_number, o_custkey AS customer_id,
              coalesce(nullif(o_orderpriority, '5-LOW'), o_orderstatus) AS handling
       FROM orders""",
)
def bind_repeat(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("urgent", F.nullif("o_orderpriority", F.lit("5-LOW")))
    columns = {
        "o_orderkey": ["id", "ticket_number"],
        "o_custkey": "customer_id",
        "urgent": "handling",
        "o_orderstatus": "handling",
    }
    return bind(orders, columns, allow_repeat=True)


@query(
    "bind_nested",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def bind_nested_fields(t: Tables) -> DataFrame:
    parsed = t.events.select("event_id", F.from_json("props", "k long").alias("p"))
    return bind_nested(parsed, "p", ["k"])


@query(
    "view_by_type",
    """SELECT 'purchase' AS kind, event_id AS id, user_id AS buyer, value AS amount
         FROM events WHERE event_type = 'purchase'
       UNION ALL
       SELECT 'signup', event_id, user_id, value FROM events WHERE event_type = 'signup'""",
)
def view_by_type(t: Tables) -> DataFrame:
    columns = {"event_id": "id", "user_id": "buyer", "value": "amount"}
    purchases = view(t.events, F.col("event_type") == "purchase", columns, "purchases")
    signups = view(t.events, F.col("event_type") == "signup", columns)
    return purchases.select(F.lit("purchase").alias("kind"), "*").unionByName(
        signups.select(F.lit("signup").alias("kind"), "*")
    )


@query("ctas_roundtrip", "SELECT p_partkey, p_brand, p_size FROM part")
def ctas_roundtrip(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    return materialize(parts, scratch_path(t.spark, "parts"))


@query(
    "mod_partition_counts",
    """SELECT CAST(o_orderkey % 10 AS INTEGER) AS mod_division, count(*) AS orders
       FROM orders GROUP BY 1""",
)
def mod_partition_counts(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-mod")
    stored = write_bucketed(t.orders, path, "o_orderkey", 10)
    return stored.groupBy("mod_division").agg(F.count("o_orderkey").alias("orders"))


@query("export_columns", "SELECT s_suppkey, s_name FROM supplier")
def export_columns(t: Tables) -> DataFrame:
    return export(t.supplier, ["s_suppkey", "s_name"], scratch_path(t.spark, "suppliers"))


@query(
    "append_twice",
    """SELECT o_orderpriority, 2 * count(*) AS orders FROM orders GROUP BY o_orderpriority""",
)
def append_twice(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-load")
    load(t.orders, path, "truncate")
    stored = load(t.orders, path, "append")
    return stored.groupBy("o_orderpriority").agg(F.count("o_orderkey").alias("orders"))


@query("csv_to_parquet", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_to_parquet_job(t: Tables) -> DataFrame:
    source = scratch_path(t.spark, "suppliers-csv")
    t.supplier.write.option("header", "true").csv(source)
    target = scratch_path(t.spark, "suppliers-parquet")
    return csv_to_parquet(t.spark, source, target, SCHEMAS["supplier"])


@query("csv_to_parquet_inferred", "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, s_acctbal FROM supplier")
def csv_to_parquet_inferred(t: Tables) -> DataFrame:
    """The conversion without a schema."""
    source = scratch_path(t.spark, "suppliers-plain-csv")
    t.supplier.write.option("header", "true").csv(source)
    stored = csv_to_parquet(t.spark, source, scratch_path(t.spark, "suppliers-plain"))
    return stored.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", "s_acctbal")


@query(
    "incremental_new_keys",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders,
              count(DISTINCT o_orderkey) AS distinct_orders
       FROM orders GROUP BY 1""",
)
def incremental_new_keys(t: Tables) -> DataFrame:
    """Loads early orders, then all orders: only unseen keys are added, even when run twice."""
    path = scratch_path(t.spark, "orders-incremental")
    year = F.year("o_orderdate")
    materialize(t.orders.filter(year < 1998), path)
    append_new(path, t.orders.filter(year >= 1997), "o_orderkey")
    stored = append_new(path, t.orders, "o_orderkey")
    return stored.groupBy(year.alias("order_year")).agg(
        F.count("o_orderkey").alias("orders"), F.count_distinct("o_orderkey").alias("distinct_orders")
    )


@query(
    "incremental_newest",
    """SELECT user_id, event_id, event_type, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
)
def incremental_newest(t: Tables) -> DataFrame:
    """One event per user, loaded in two batches: of a batch's rows the newest of a new user stays."""
    path = scratch_path(t.spark, "users-incremental")
    newest = t.events.select("user_id", "event_id", "event_type", "ts").withColumn("at", F.struct("ts", "event_id"))
    materialize(newest.filter("false"), path)
    append_new(path, newest.filter("user_id % 3 = 0"), "user_id", "at")
    return append_new(path, newest, "user_id", "at").drop("at")


def _daily(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    return rollup_write(
        t.orders,
        {"order_date": F.to_date("o_orderdate"), "priority": F.col("o_orderpriority")},
        {
            "total_price": RollupMeasure("sum", price),
            "orders": RollupMeasure("count", F.col("o_orderkey")),
            "smallest": RollupMeasure("min", price),
            "largest": RollupMeasure("max", price),
        },
        scratch_path(t.spark, "orders-daily"),
    )


@query(
    "rollup_daily",
    """SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS priority,
              round(sum(o_totalprice), 2) AS total_price, count(o_orderkey) AS orders,
              min(o_totalprice) AS smallest, max(o_totalprice) AS largest
       FROM orders GROUP BY 1, 2""",
)
def rollup_daily(t: Tables) -> DataFrame:
    return _daily(t).withColumn("total_price", F.round("total_price", 2))


@query(
    "rollup_reaggregate",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
              round(sum(o_totalprice), 2) AS total_price, count(o_orderkey) AS orders,
              min(o_totalprice) AS smallest, max(o_totalprice) AS largest
       FROM orders GROUP BY 1""",
)
def rollup_reaggregate(t: Tables) -> DataFrame:
    """Yearly totals from the daily rollup equal yearly totals from the orders."""
    yearly = rollup_read(
        _daily(t),
        {"order_year": F.year("order_date")},
        {"total_price": "sum", "orders": "count", "smallest": "min", "largest": "max"},
    )
    return yearly.withColumn("total_price", F.round("total_price", 2))


_YEARLY_CUSTOMERS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
              count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1"""


@query("rollup_distinct", _YEARLY_CUSTOMERS)
def rollup_distinct(t: Tables) -> DataFrame:
    """Customers per year from stored (day, priority, customer) pairs; plain daily counts could not tell."""
    dims = {"order_date": F.to_date("o_orderdate"), "priority": F.col("o_orderpriority")}
    pairs = distinct_write(t.orders, dims, F.col("o_custkey"), scratch_path(t.spark, "orders-customers"))
    return distinct_read(pairs, {"order_year": F.year("order_date")}, "customers")


@query(
    "rollup_distinct_sketch",
    f"SELECT order_year, true AS within_error FROM ({_YEARLY_CUSTOMERS})",
)
def rollup_distinct_sketch(t: Tables) -> DataFrame:
    """The same from daily sketches, within five standard errors of the exact count."""
    sketches = rollup_write(
        t.orders,
        {"order_date": F.to_date("o_orderdate")},
        {"customers": RollupMeasure("sketch", F.col("o_custkey"))},
        scratch_path(t.spark, "orders-sketches"),
    )
    year = {"order_year": F.year("order_date")}
    guess = rollup_read(sketches, year, {"customers": "sketch"}).withColumnRenamed("customers", "guess")
    error = F.abs(F.col("guess") - F.col("customers")) / F.col("customers")
    return rollup_distinct(t).join(guess, "order_year").select(
        "order_year", (error <= 5 * 1.04 / 2**6).alias("within_error")
    )


@query(
    "complete_where",
    """SELECT l_linestatus, count(*) AS rows_returned, round(sum(l_quantity), 2) AS quantity
       FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 10 GROUP BY 1""",
)
def complete_where(t: Tables) -> DataFrame:
    """A table of returns only answers the question, so the full fact is not read."""
    returned = "l_returnflag = 'R'"
    path = scratch_path(t.spark, "returns")
    returns = materialize(t.lineitem.filter(returned), path)
    chosen = pick_source([returned, "l_quantity > 10"], [(returns, returned), (t.lineitem, None)])
    return chosen.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("rows_returned"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "freshness_lag",
    """SELECT event_type, max(ts) AS newest,
              CAST(DATE '2024-02-15' - CAST(max(ts) AS DATE) AS INTEGER) AS lag_days
       FROM events GROUP BY 1""",
)
def freshness_lag(t: Tables) -> DataFrame:
    return freshness(t.events, "ts", "2024-02-15", ["event_type"])


@query(
    "refresh_stale",
    "SELECT event_type, count(*) AS events, max(ts) AS newest FROM events GROUP BY 1",
)
def refresh_stale(t: Tables) -> DataFrame:
    """A stored copy that ends on 10 January is too old on 1 February and is rebuilt."""
    old = F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")
    stored = scratch_path(t.spark, "events-stored")
    materialize(t.events.filter(old), stored)
    target = scratch_path(t.spark, "events-rebuilt")
    fresh = refresh(t.spark, stored, target, "ts", lambda: t.events, 7, "2024-02-01")
    return fresh.groupBy("event_type").agg(
        F.count("event_id").alias("events"), F.max("ts").alias("newest")
    )


@query(
    "refresh_partitions",
    """SELECT strftime(o_orderdate, '%Y-%m') AS order_month, o_orderpriority, count(*) AS orders,
              round(sum(o_totalprice), 2) AS total_price, max(o_orderdate) AS newest
       FROM orders GROUP BY 1, 2""",
)
def refresh_partitions_monthly(t: Tables) -> DataFrame:
    """A monthly table built up to mid 1997 and then brought up to date, from its last month on."""
    path = scratch_path(t.spark, "orders-monthly")
    month = F.date_format("o_orderdate", "yyyy-MM")

    def build(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_orderpriority", month.alias("order_month")).agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.sum("o_totalprice"), 2).alias("total_price"),
            F.max("o_orderdate").alias("newest"),
        )

    early = t.orders.filter(F.col("o_orderdate") < F.lit("1997-06-15").cast("timestamp_ntz"))
    for source in (early, t.orders):
        stored = refresh_partitions(source, path, "o_orderdate", ("order_month", month), build)
    return stored


@query(
    "catalog_views",
    """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total_price
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       WHERE o_orderstatus = 'F' GROUP BY n_name""",
)
def catalog_views(t: Tables) -> DataFrame:
    """Tables of a model registered as SQL views and asked in SQL."""
    model = Catalog()
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey")):
        model.register(Dataset(name, getattr(t, name), (key,)), view=True)
    return t.spark.sql(
        """SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total_price
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           WHERE o_orderstatus = 'F' GROUP BY n_name"""
    )


@query(
    "json_lookup",
    """SELECT DISTINCT 'k' AS code, json_extract_string(props, '$.k') AS label FROM events""",
)
def json_lookup(t: Tables) -> DataFrame:
    return lookup_from_json(t.events, F.col("props"))

"""The test tables under their declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grainframe.catalog import Catalog, Dataset, Edge
from grainframe.sources import scan_parquet

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


class Tables:
    """``Tables(spark, folder).orders`` is the orders table.

    Declared schemas spare the footer read that inference needs per table.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return scan_parquet(self.spark, f"{self.folder}/{name}.parquet", schema=SCHEMAS[name])


def types_of(name: str) -> dict[str, str]:
    logical = {"long": "bigint"}
    pairs = [item.strip().split(" ") for item in SCHEMAS[name].split(",")]
    return {column: logical.get(kind, kind) for column, kind in pairs}


def star(t: Tables) -> Catalog:
    """The order star: line items, their orders, parts and suppliers, and geography."""
    catalog = Catalog()
    grains = {
        "region": ("r_regionkey",),
        "nation": ("n_nationkey",),
        "customer": ("c_custkey",),
        "supplier": ("s_suppkey",),
        "part": ("p_partkey",),
        "orders": ("o_orderkey",),
        "lineitem": ("l_orderkey", "l_linenumber"),
    }
    alternate = {"customer": ("c_name",), "supplier": ("s_name",), "nation": ("n_name",)}
    units = {"l_extendedprice": "usd", "l_discount": "percent", "l_tax": "percent"}
    for name, grain in grains.items():
        catalog.register(
            Dataset(
                name,
                getattr(t, name),
                grain,
                types=types_of(name),
                alternate_keys=alternate.get(name, ()),
                traits=units if name == "lineitem" else {},
            )
        )
    for source, target, on, role, partial in (
        ("lineitem", "orders", {"l_orderkey": "o_orderkey"}, "order", True),
        ("lineitem", "part", {"l_partkey": "p_partkey"}, "part", True),
        ("lineitem", "supplier", {"l_suppkey": "s_suppkey"}, "supplier", True),
        ("orders", "customer", {"o_custkey": "c_custkey"}, "customer", True),
        ("customer", "nation", {"c_nationkey": "n_nationkey"}, "nation", True),
        ("supplier", "nation", {"s_nationkey": "n_nationkey"}, "nation", True),
        ("nation", "region", {"n_regionkey": "r_regionkey"}, "region", True),
    ):
        catalog.link(Edge(source, target, on, role, partial=partial))
    return catalog

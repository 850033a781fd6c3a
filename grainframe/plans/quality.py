"""Data-quality reports over the given tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.plans import aggregates, projection, windows  # noqa: F401  (queries of the pack)
from grainframe.plans.joins import loose_lines
from grainframe.plans.registry import ORACLES, QUERIES, query
from grainframe.plans.tables import Tables, types_of, star
from grainframe.quality import (
    candidate_keys,
    check_domain,
    check_edges,
    check_fk,
    check_grain,
    check_not_null,
    check_schema,
    run_pack,
    suggest_binding,
    validate_catalog,
)


@query(
    "check_schema",
    " UNION ALL ".join(
        f"""SELECT '{column}' AS "column", '{kind}' AS declared, '{kind}' AS actual, true AS same_type,
                   count(*) AS "rows", count({column}) AS not_null, count({column}) AS fitting FROM lineitem"""
        for column, kind in types_of("lineitem").items()
    ),
)
def schema_report(t: Tables) -> DataFrame:
    return check_schema(star(t).datasets["lineitem"])


@query(
    "grain_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def grain_violations(t: Tables) -> DataFrame:
    """Line items repeat their declared key, which is why facts are never de-duplicated by it."""
    return check_grain(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "null_profile",
    """SELECT 'event_id' AS "column", 0::BIGINT AS nulls, count(*) AS "rows" FROM events
       UNION ALL SELECT 'kind', count(*) FILTER (event_type = 'error'), count(*) FROM events
       UNION ALL SELECT 'amount', count(*) FILTER (value <= 10), count(*) FROM events""",
)
def null_profile(t: Tables) -> DataFrame:
    events = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") > 10, F.col("value")).alias("amount"),
    )
    return check_not_null(events, ["event_id", "kind", "amount"])


_LOOSE = "(SELECT nullif(l_suppkey, 7) + 5 AS r FROM lineitem)"


@query(
    "fk_coverage",
    f"""SELECT *, CASE WHEN unused_keys > 0 THEN '~' ELSE '' END
                  || CASE WHEN null_rows + dangling_rows > 0 THEN '?' ELSE '' END AS modifier
        FROM (SELECT (SELECT count(*) FROM lineitem) AS fact_rows,
                     (SELECT count(*) FROM {_LOOSE} WHERE r IS NULL) AS null_rows,
                     (SELECT count(*) FROM {_LOOSE} WHERE r NOT IN (SELECT s_suppkey FROM supplier))
                       AS dangling_rows,
                     (SELECT count(*) FROM supplier) AS dim_keys,
                     (SELECT count(*) FROM supplier WHERE s_suppkey NOT IN
                        (SELECT r FROM {_LOOSE} WHERE r IS NOT NULL)) AS unused_keys)""",
)
def fk_coverage(t: Tables) -> DataFrame:
    return check_fk(loose_lines(t), t.supplier, {"supp_ref": "s_suppkey"})


@query(
    "enum_domain",
    """SELECT event_type, count(*) AS "rows" FROM events
       WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY 1""",
)
def enum_domain(t: Tables) -> DataFrame:
    return check_domain(t.events, "event_type", ["view", "click", "purchase"])


_EDGES = (
    ("lineitem", "order", "l_orderkey", "orders", "o_orderkey", "bigint"),
    ("lineitem", "part", "l_partkey", "part", "p_partkey", "bigint"),
    ("lineitem", "supplier", "l_suppkey", "supplier", "s_suppkey", "bigint"),
    ("orders", "customer", "o_custkey", "customer", "c_custkey", "bigint"),
    ("customer", "nation", "c_nationkey", "nation", "n_nationkey", "int"),
    ("supplier", "nation", "s_nationkey", "nation", "n_nationkey", "int"),
    ("nation", "region", "n_regionkey", "region", "r_regionkey", "int"),
)


@query(
    "check_edges",
    "SELECT *, NOT contains(needed, '?') AS sufficient FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{source}.{role}' AS edge, '{kind}' AS source_type, '{kind}' AS target_type,
                   true AS same_type, '~' AS declared,
                   CASE WHEN EXISTS (SELECT 1 FROM {target} WHERE {key} NOT IN
                          (SELECT {ref} FROM {source} WHERE {ref} IS NOT NULL)) THEN '~' ELSE '' END
                   || CASE WHEN EXISTS (SELECT 1 FROM {source} WHERE {ref} IS NULL OR {ref} NOT IN
                          (SELECT {key} FROM {target})) THEN '?' ELSE '' END AS needed"""
        for source, role, ref, target, key, kind in _EDGES
    )
    + ")",
)
def edge_report(t: Tables) -> DataFrame:
    return check_edges(star(t))


def _distinct(*columns: str) -> str:
    values = columns[0] if len(columns) == 1 else f"({', '.join(columns)})"
    # A pair is a smallest key only if neither column is one already.
    single = " OR ".join(f"count(DISTINCT {c}) = count(*)" for c in columns[: len(columns) // 2 * 2])
    return f"""SELECT '{",".join(columns)}' AS key_columns, count(*) AS "rows",
                      count(DISTINCT {values}) = count(*) AND NOT ({single or "false"}) AS ok FROM orders"""


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_ORDER_SETS = [*combinations(_ORDER_COLUMNS, 1), *combinations(_ORDER_COLUMNS, 2)]


@query(
    "candidate_keys",
    f"""SELECT key_columns, "rows" FROM ({" UNION ALL ".join(_distinct(*s) for s in _ORDER_SETS)}) WHERE ok""",
)
def order_keys(t: Tables) -> DataFrame:
    return candidate_keys(t.orders, _ORDER_COLUMNS, 2)


@query(
    "suggest_binding",
    """SELECT 'c_custkey' AS "column", 0::BIGINT AS nulls, count(*) AS "rows",
              count(DISTINCT c_custkey) = count(*) AS is_key, '' AS modifier FROM customer
       UNION ALL SELECT 'c_name', 0, count(*), count(DISTINCT c_name) = count(*), '' FROM customer
       UNION ALL SELECT 'segment', count(*) FILTER (c_mktsegment = 'BUILDING'), count(*), false, '?' FROM customer
       UNION ALL SELECT 'c_nationkey', 0, count(*), false,
              CASE WHEN (SELECT count(*) FROM nation) > count(DISTINCT c_nationkey) THEN '~' ELSE '' END
              FROM customer""",
)
def suggested_binding(t: Tables) -> DataFrame:
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    customers = t.customer.select("c_custkey", "c_name", segment, "c_nationkey")
    return suggest_binding(customers, {"c_nationkey": (t.nation, "n_nationkey")})


@query(
    "validate_model",
    """SELECT 'lineitem' AS dataset, 'grain' AS "check", 'l_orderkey,l_linenumber' AS subject,
              count(*) AS violations
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def validate_model(t: Tables) -> DataFrame:
    """All declarations of the order star checked; only the known repeated key is reported."""
    return validate_catalog(star(t))


_PACK = ("pricing_summary", "region_chain", "fanout_safe", "rank_entities", "fk_coverage")


@query(
    "pack_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS query, true AS passed, count(*) AS "rows", CAST(NULL AS VARCHAR) AS error
            FROM ({ORACLES[name]})"""
        for name in _PACK
    ),
)
def pack_report(t: Tables) -> DataFrame:
    """A few queries run as a pack, with rows or the error of each."""
    report = run_pack(t.spark, {n: QUERIES[n] for n in _PACK}, t.folder)
    return report.select("query", "passed", "rows", "error")

"""Data preparation jobs over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainframe.plans.registry import query
from grainframe.plans.tables import Tables
from grainframe.prep import (
    apply_fix,
    check_delimited,
    clean_strings,
    decode_text,
    fix_headers,
    flatten,
    minimise_text,
    normalise_flags,
    null_sentinels,
    read_commented_tsv,
    snake_columns,
    strip_citations,
)
from grainframe.session import scratch_path


@query(
    "clean_strings",
    r"""SELECT doc_id, regexp_replace(regexp_replace(raw, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'),
                                      '\r\n?', chr(10), 'g') AS text
        FROM (SELECT doc_id, chr(7) || text || chr(13) || chr(10) || lang || chr(13) || source || chr(127) AS raw
              FROM documents)""",
)
def clean_documents(t: Tables) -> DataFrame:
    """Whole documents with control characters and mixed line ends put in, cleaned again."""
    dirty = F.concat(
        F.lit("\x07"), "text", F.lit("\r\n"), "lang", F.lit("\r"), "source", F.lit("\x7f")
    )
    return clean_strings(t.documents.select("doc_id", dirty.alias("text")))


@query(
    "utf8_policy",
    """SELECT doc_id, text AS ignored, text || chr(65533) AS replaced FROM documents""",
)
def utf8_policy(t: Tables) -> DataFrame:
    """Documents with a stray byte at the end, decoded by two policies."""
    stray = F.concat(F.encode("text", "utf-8"), F.unhex(F.lit("FF")))
    raw = t.documents.select("doc_id", stray.alias("ignored"), stray.alias("replaced"))
    return decode_text(decode_text(raw, "ignored", "ignore"), "replaced", "replace")


@query(
    "fix_headers",
    """SELECT o_orderkey AS id, o_custkey AS column_2, o_totalprice AS price, o_totalprice / 2 AS price_2
       FROM orders""",
)
def repaired_headers(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_totalprice") / 2)
    return raw.toDF(*fix_headers([" id ", "", "price", "price"]))


@query(
    "ragged_rows",
    """SELECT 'ragged row' AS problem,
              c_custkey || ',"' || c_name || ', Ltd",' || c_mktsegment
                || CASE WHEN c_custkey % 3 = 0 THEN ',extra' ELSE '' END AS detail,
              4 AS fields, 3 AS expected
       FROM customer WHERE c_custkey % 3 = 0""",
)
def ragged_rows(t: Tables) -> DataFrame:
    """Text lines with a quoted separator; every third one has a field too many."""
    extra = F.when(F.col("c_custkey") % 3 == 0, F.lit(",extra")).otherwise(F.lit(""))
    line = F.concat(
        F.col("c_custkey").cast("string"), F.lit(',"'), "c_name", F.lit(', Ltd",'), "c_mktsegment", extra
    )
    path = scratch_path(t.spark, "ragged")
    t.customer.select(line.alias("value")).write.text(path)
    return check_delimited(t.spark, path, header="id,name,segment")


@query(
    "strip_comments",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment
       FROM customer WHERE c_custkey % 4 <> 0""",
)
def strip_comments(t: Tables) -> DataFrame:
    """Tab-separated lines with padding; every fourth one is a comment."""
    mark = F.when(F.col("c_custkey") % 4 == 0, F.lit("# ")).otherwise(F.lit(""))
    line = F.concat(
        mark, F.col("c_custkey").cast("string"), F.lit("\t "), "c_name", F.lit(" \t"), "c_mktsegment"
    )
    path = scratch_path(t.spark, "commented")
    t.customer.select(line.alias("value")).write.text(path)
    return read_commented_tsv(t.spark, path, header="#id\tname\tsegment")


@query(
    "null_sentinels",
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS reading,
              CASE WHEN event_id % 7 = 0 THEN '-' ELSE event_type END AS kind
       FROM events""",
)
def sentinels_to_null(t: Tables) -> DataFrame:
    """``-`` becomes null among numbers and stays among words."""
    gap = F.col("event_id") % 7 == 0
    raw = t.events.select(
        "event_id",
        F.when(gap, F.lit("-")).otherwise(F.col("event_id").cast("string")).alias("reading"),
        F.when(gap, F.lit("-")).otherwise(F.col("event_type")).alias("kind"),
    )
    return null_sentinels(raw)


@query(
    "key_repair",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'E' ELSE l_linestatus END AS l_linestatus
       FROM lineitem""",
)
def key_repair(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    return apply_fix(lines, bad, "l_linestatus", "E").drop("l_returnflag")


@query(
    "normalise_flags",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1) THEN '-' ELSE p_type END AS p_type,
              CASE p_name WHEN 'small ring' THEN 350.0 WHEN 'red widget' THEN 380.0 ELSE p_retailprice END
                AS p_retailprice
       FROM part""",
)
def normalised_flags(t: Tables) -> DataFrame:
    """Flags stripped, missing values unified, two known bad prices overridden."""
    key = F.col("p_partkey") % 5
    dirty = F.when(key == 0, F.lit("NA?")).when(key == 2, F.concat("p_type", F.lit("??")))
    dirty = dirty.when(key != 1, F.col("p_type"))
    parts = t.part.select("p_partkey", "p_name", dirty.alias("p_type"), "p_retailprice")
    fixed = normalise_flags(
        parts,
        ["p_type"],
        overrides={"p_retailprice": ("p_name", {"small ring": 350.0, "red widget": 380.0})},
    )
    return fixed.drop("p_name")


@query(
    "minimise_text",
    r"""WITH article AS (
          SELECT doc_id, text || ' (Linnaeus, 1758) == Species == many == Distribution == in ' || source
                 || ' == Taxonomy == family ' || lang || ' == References == none' AS x FROM documents),
        cut AS (
          SELECT doc_id, x, regexp_replace(regexp_replace(x, '(?s)== Species ==.*?(==|$)', '\1'),
                                           '(?s)== References ==.*', '') AS s FROM article),
        bare AS (
          SELECT doc_id, x, regexp_replace(regexp_replace(regexp_replace(s, '\([^)]*\d{4}[^)]*\)', '', 'g'),
                 ',\s*\d{4}', '', 'g'), '\b[A-Z][a-z]+\s*,\s*\d{4}', '', 'g') AS s FROM cut),
        art AS (
          SELECT doc_id, x, regexp_replace(regexp_replace(s, '\(Art\.\s*\d*\)', '', 'g'), 'Art\.\s*\d+', '', 'g')
                 AS s FROM bare)
        SELECT doc_id, trim(regexp_replace(s, '[\s\x0B]+', ' ', 'g'))
               || ' ' || trim(regexp_extract(x, '(?s)== Distribution ==(.*?)(==|$)', 1))
               || ' ' || trim(regexp_extract(x, '(?s)== Taxonomy ==(.*?)(==|$)', 1)) AS summary
        FROM art""",
)
def minimise_documents(t: Tables) -> DataFrame:
    """Documents dressed as encyclopedia articles and cut down again."""
    article = F.concat(
        "text",
        F.lit(" (Linnaeus, 1758) == Species == many == Distribution == in "),
        "source",
        F.lit(" == Taxonomy == family "),
        "lang",
        F.lit(" == References == none"),
    )
    return minimise_text(t.documents.select("doc_id", article.alias("summary")), "summary")


@query(
    "minimise_text_plain",
    r"""WITH dressed AS (SELECT doc_id, text || ' (Linnaeus, 1758), 1999 Art. 12 (Art. 7)' AS x FROM documents),
        cut AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(x, '\([^)]*\d{4}[^)]*\)', '', 'g'),
                       ',\s*\d{4}', '', 'g'), '\b[A-Z][a-z]+\s*,\s*\d{4}', '', 'g') AS x FROM dressed),
        art AS (SELECT doc_id, regexp_replace(regexp_replace(x, '\(Art\.\s*\d*\)', '', 'g'), 'Art\.\s*\d+', '', 'g')
                       AS x FROM cut)
        SELECT doc_id, regexp_replace(regexp_replace(x, '[\s\x0B]+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS summary
        FROM art""",
)
def plain_citations(t: Tables) -> DataFrame:
    """The citation rules alone, on whole documents."""
    dressed = F.concat("text", F.lit(" (Linnaeus, 1758), 1999 Art. 12 (Art. 7)"))
    return t.documents.select("doc_id", strip_citations(dressed).alias("summary"))


@query(
    "snake_columns",
    "SELECT p_partkey AS part_key, p_retailprice AS unit_price_usd, p_size AS size FROM part",
)
def snake_case_columns(t: Tables) -> DataFrame:
    camel = t.part.select(
        F.col("p_partkey").alias("PartKey"),
        F.col("p_retailprice").alias("unitPriceUSD"),
        F.col("p_size").alias("Size"),
    )
    return snake_columns(camel)


@query(
    "flatten",
    """SELECT c_custkey AS id, c_name AS who_name, c_nationkey AS who_place_nation,
              c_mktsegment AS who_place_segment
       FROM customer""",
)
def flatten_customer(t: Tables) -> DataFrame:
    place = F.struct(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    who = F.struct(F.col("c_name").alias("name"), place.alias("place"))
    return flatten(t.customer.select(F.col("c_custkey").alias("id"), who.alias("who")))

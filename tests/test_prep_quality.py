"""Cleaning jobs and checks on small dirty inputs."""

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Dataset, Edge
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
)
from grainframe.quality import (
    candidate_keys,
    check_domain,
    check_fk,
    check_grain,
    check_not_null,
    check_schema,
    run_pack,
    suggest_binding,
    validate_catalog,
)


def test_clean_strings(spark):
    df = spark.createDataFrame([(1, "a\x00b\x07\tc\r\nd\re\nf\x7f"), (2, None)], "i int, v string")
    assert rows(clean_strings(df)) == [(1, "ab\tc\nd\ne\nf"), (2, None)]


def test_utf8_modes(spark):
    df = spark.createDataFrame([(b"ok\xff\xef\xbf\xbd",)], "v binary")
    assert rows(decode_text(df, "v", "ignore")) == [("ok�",)]
    assert rows(decode_text(df, "v", "replace")) == [("ok��",)]
    with pytest.raises(PySparkException):
        decode_text(df, "v", "strict").collect()
    with pytest.raises(ValueError):
        decode_text(df, "v", "guess")


def test_headers():
    assert fix_headers([" a ", "", "a", "b", "a", ""]) == ["a", "column_2", "a_2", "b", "a_3", "column_6"]


def test_repaired_headers_are_unique():
    assert fix_headers(["price", "price", "price_2"]) == ["price", "price_3", "price_2"]
    assert fix_headers(["", "column_1", "x"]) == ["column_1_2", "column_1", "x"]


def test_snake_and_flatten(spark):
    df = spark.sql("SELECT 1 AS tableId, named_struct('cityName', 'x', 'geo', named_struct('lat', 2.0D)) AS placeInfo")
    assert flatten(df).columns == ["tableId", "placeInfo_cityName", "placeInfo_geo_lat"]
    assert snake_columns(flatten(df)).columns == ["table_id", "place_info_city_name", "place_info_geo_lat"]


def test_ragged_and_headers(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text('id,,name,name\n1,2,3,4\n1,2,3\n"a,b",2,3,4\n1,2,3,4,5\n')
    got = rows(check_delimited(spark, str(path)), "problem", "detail", "fields", "expected")
    assert got == [
        ("blank header", "position 2", 4, 4),
        ("ragged row", "1,2,3", 3, 4),
        ("ragged row", "1,2,3,4,5", 5, 4),
        ("repeated header", "name", 4, 4),
    ]


def test_quoted_header_counts_like_data(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('id,"last, first"\n1,"Doe, Jo"\n2,x\n3\n')
    assert rows(check_delimited(spark, str(path)), "problem", "detail") == [("ragged row", "3")]


def test_line_equal_to_the_header_is_data(spark, tmp_path):
    path = tmp_path / "plain.tsv"
    path.write_text("Code\tName\nA1\tAlpha\nCode\tName\n")
    assert rows(read_commented_tsv(spark, str(path))) == [("A1", "Alpha"), ("Code", "Name")]


def test_commented_tsv(spark, tmp_path):
    path = tmp_path / "sites.tsv"
    path.write_text("#Code\tName\n# note\nA1\t  Alpha \n\n  # more\nB2\tBeta\n")
    got = read_commented_tsv(spark, str(path))
    assert got.columns == ["Code", "Name"] and rows(got) == [("A1", "Alpha"), ("B2", "Beta")]


def test_sentinels_only_in_numeric_columns(spark):
    data = [("1.5", "x", "-"), ("-", "-", "-"), ("2e3", "y", "")]
    df = spark.createDataFrame(data, "num string, word string, empty string")
    assert rows(null_sentinels(df)) == [("1.5", "x", "-"), ("2e3", "y", ""), (None, "-", "-")]


def test_sentinels_beside_special_numbers(spark):
    data = [("nan", "1_000"), ("-inf", "-"), ("-", "2")]
    df = spark.createDataFrame(data, "a string, b string")
    assert rows(null_sentinels(df)) == [("-inf", None), ("nan", "1_000"), (None, "2")]


def test_fix_and_flags(spark):
    df = spark.createDataFrame([("LES", "F"), ("S1", "1")], "name string, no string")
    assert rows(apply_fix(df, F.col("name") == "LES", "no", "E")) == [("LES", "E"), ("S1", "1")]
    engines = spark.createDataFrame([("R2", 1.0, "LOX?"), ("X", 2.0, None)], "n string, isp double, ox string")
    got = normalise_flags(engines, ["ox"], overrides={"isp": ("n", {"R2": 380.0})})
    assert rows(got) == [("R2", 380.0, "LOX"), ("X", 2.0, "-")]


def test_minimise_text(spark):
    article = (
        "Foo is a genus of snails (Smith, 1901) living in seas, 1999.\n\n== Species ==\nFoo a\n"
        "== Distribution ==\n Pacific \n== Taxonomy ==\nBar\n== References ==\nlong list"
    )
    df = spark.createDataFrame([(1, article), (2, ""), (3, None), (4, "Short (x 1234)")], "i int, v string")
    got = {r["i"]: r["v"] for r in minimise_text(df, "v").collect()}
    assert got[1] == (
        "Foo is a genus of snails living in seas. == Distribution == Pacific == Taxonomy == Bar Pacific Bar"
    )
    assert got[2] == "" and got[3] is None and got[4] == "Short"


def test_first_sentence_stands_in(spark):
    text = "(Linnaeus described this genus in 1758)."
    df = spark.createDataFrame([(text,)], "v string")
    assert rows(minimise_text(df, "v")) == [("(Linnaeus described this genus in 1758)",)]


def test_schema_report(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    report = check_schema(Dataset("t", df, ("a",), types={"a": "bigint", "b": "int"}))
    assert rows(report) == [("a", "bigint", "string", False, 2, 2, 1), ("b", "int", None, False, 2, 0, 0)]


def test_grain_nulls_domain(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "z")], "k int, v string")
    assert rows(check_grain(df, ["k"])) == [(1, 2)]
    assert rows(check_not_null(df, ["k", "v"])) == [("k", 0, 4), ("v", 1, 4)]
    assert rows(check_domain(df, "v", ["a", "b"])) == [("z", 1)]


def test_known_grain_violation(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    repeated = check_grain(lines, ["l_orderkey", "l_linenumber"])
    single = lines.select("l_orderkey", "l_linenumber").distinct().count()
    extra = repeated.selectExpr("sum(rows - 1)").first()[0]
    assert (single, lines.count()) == (45832, 60000) and single + extra == 60000


def test_fk_both_ways(spark):
    fact = spark.createDataFrame([(10,), (10,), (None,), (99,)], "r int")
    dim = spark.createDataFrame([(10,), (20,)], "k int")
    assert rows(check_fk(fact, dim, {"r": "k"})) == [(4, 1, 1, 2, 1, "~?")]
    assert check_fk(fact.filter("r = 10"), dim.filter("k = 10"), {"r": "k"}).first()["modifier"] == ""


def test_candidate_keys(spark):
    data = [(i, i // 10, i % 10, 5, None if i == 0 else i) for i in range(100)]
    df = spark.createDataFrame(data, "id int, a int, b int, c int, holey int")
    assert rows(candidate_keys(df, df.columns, 2), "key_columns") == [("a,b",), ("id",)]


def test_candidate_keys_of_a_wide_table_in_few_passes(spark):
    wide = spark.range(60).select(
        "id", *[(F.col("id") % (i % 9 + 2)).alias(f"c{i}") for i in range(69)]
    )
    wide = wide.withColumns({"d": F.col("id") % 7 * -0.0, "when": F.timestamp_seconds("id"), "raw": F.encode(F.col("id").cast("string"), "UTF-8")})
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    found = {r["key_columns"] for r in candidate_keys(wide, wide.columns, 2).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before)
    assert {"id", "when", "raw"} <= found and "d" not in found
    counts = {c: wide.select(c).distinct().count() for c in ("c7", "c8")}
    assert "c7,c8" in found and counts == {"c7": 9, "c8": 10} and jobs < 60  # lcm(9, 10) >= 60


def test_suggest_binding(spark):
    df = spark.createDataFrame([(1, 10, "x"), (2, None, None)], "id int, ref int, v string")
    dim = spark.createDataFrame([(10,), (20,)], "k int")
    assert rows(suggest_binding(df, {"ref": (dim, "k")})) == [
        ("id", 0, 2, True, ""),
        ("ref", 1, 2, False, "~?"),
        ("v", 1, 2, False, "?"),
    ]


def test_run_pack_reports_every_failure(spark, folder):
    def fails(session, path):
        raise ValueError("no such table")

    pack = {"good": lambda s, p: s.range(3), "bad": fails, "late": lambda s, p: s.sql("SELECT raise_error('x') AS a")}
    got = {r["query"]: r for r in run_pack(spark, pack, folder).collect()}
    assert got["good"]["passed"] and got["good"]["rows"] == 3
    assert not got["bad"]["passed"] and got["bad"]["error"] == "no such table"


def test_validate_catalog_lists_broken_promises(spark):
    fact = spark.createDataFrame([(1, 10, "a"), (1, 99, "z"), (2, None, None)], "id int, ref int, kind string")
    dim = spark.createDataFrame([(10, "x"), (20, "x")], "k int, name string")
    types = {"id": "int", "ref": "int", "kind": "string"}
    catalog = Catalog()
    catalog.register(
        Dataset("fact", fact, ("id",), types, nullable=frozenset({"ref"}), domains={"kind": ("a", "b")})
    )
    catalog.register(Dataset("dim", dim, ("k",), alternate_keys=("name",)))
    catalog.link(Edge("fact", "dim", {"ref": "k"}))
    assert rows(validate_catalog(catalog)) == [
        ("dim", "alternate key", "name", 1),
        ("fact", "coverage", "dim", 1),
        ("fact", "domain", "kind", 1),
        ("fact", "grain", "id", 1),
        ("fact", "not null", "kind", 1),
        ("fact", "reference", "dim", 2),
    ]

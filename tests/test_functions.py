"""Scalar helpers where engines differ: nulls, ranges, rounding, odd dates."""

import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from grainframe.functions import (
    add_units,
    band,
    capital_first,
    case_map,
    date_from_parts,
    day_name,
    day_of_week,
    explode_list,
    fuzzy_date,
    has_tag,
    hash_color,
    holiday_label,
    julian_to_date,
    regexp_group,
    register_trait,
    root_domain,
    sort_desc,
    split_part,
    strip_flag,
    tag,
    tag_map,
    tag_value,
    traits,
    unless_sentinel,
    within_last,
    year_diff,
)


def values(spark, data, expr, kind="string"):
    """The expression over column ``v``, in input order."""
    df = spark.createDataFrame(list(enumerate(data)), f"i int, v {kind}")
    return [r[1] for r in df.select("i", expr(F.col("v"))).sort("i").collect()]


def test_split_part_out_of_range(spark):
    data = ["A/B", "A", "", None]
    assert values(spark, data, lambda v: split_part(v, "/", 2)) == ["B", None, None, None]
    assert values(spark, ["a|b|c"], lambda v: split_part(v, "|", -1)) == ["c"]
    assert values(spark, ["Last, First"], lambda v: split_part(v, ",", 1)) == ["Last"]


def test_regexp_group_gives_null(spark):
    assert values(spark, ["x9", "x"], lambda v: regexp_group(v, r"(\d)")) == ["9", None]


def test_root_domain(spark):
    data = ["https://m.example.com/a", "http://example.org/", "nothing", None]
    assert values(spark, data, root_domain) == ["example.com", "example.org", None, None]


def test_flags_and_sentinels(spark):
    assert values(spark, ["LOX?", "NA??", "RP-1"], strip_flag) == ["LOX", "-", "RP-1"]
    assert values(spark, ["-", "x"], lambda v: unless_sentinel(v, "-")) == [None, "x"]
    assert values(spark, ["setosa", "", None], capital_first) == ["Setosa", "", None]


def test_hash_color_is_stable(spark):
    first, again, other = values(spark, ["a", "a", "b"], hash_color)
    assert first == again != other and first.startswith("#") and len(first) == 7


def test_julian_days_round_half_even_way(spark):
    data = ["2436115.58", "2436116.31"]
    assert values(spark, data, julian_to_date) == [dt.date(1957, 10, 4)] * 2


def test_fuzzy_dates(spark):
    data = ["1959 Jan 21 2342?", "1956 Dec  8", "-", "", None, "1960 Foo 1"]
    expected = [dt.date(1959, 1, 21), dt.date(1956, 12, 8), None, None, None, None]
    assert values(spark, data, fuzzy_date) == expected


def test_calendar(spark):
    sunday = dt.date(2024, 1, 7)
    assert values(spark, [sunday], day_of_week, "date") == [0]
    assert values(spark, [sunday, None], day_name, "date") == ["Sunday", None]
    assert values(spark, [dt.date(2024, 1, 31)], lambda v: add_units(v, "month", 1), "date") == [
        dt.date(2024, 2, 29)
    ]
    assert values(spark, [dt.date(2023, 12, 31)], lambda v: year_diff(v, F.lit("2024-01-01").cast("date")), "date") == [1]
    recent = lambda v: within_last(v, "day", 7, "2024-01-10")
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
    assert values(spark, days, recent, "date") == [False, True, True, False]


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2023, 2, 31), (2023, 2, 3), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [None, dt.date(2023, 2, 3), None]


def test_holidays(spark):
    data = [dt.date(2024, 11, 28), dt.date(2024, 11, 29), dt.date(2024, 5, 27), dt.date(2024, 3, 5)]
    assert values(spark, data, holiday_label, "date") == [
        "Thanksgiving",
        "Black Friday",
        "Memorial Day",
        "Tuesday",
    ]


def test_bands_and_cases(spark):
    bands = [(None, 12, "child"), (13, 19, "teenager"), (20, None, "adult")]
    assert values(spark, [12, 13, 99, None], lambda v: band(v, bands, "unknown"), "int") == [
        "child",
        "teenager",
        "adult",
        "unknown",
    ]
    assert values(spark, ["F", "X"], lambda v: case_map(v, {"F": "filled"}, v)) == ["filled", "X"]


TAGS = "array<struct<key:string,value:string>>"


def test_tags(spark):
    data = [[("place", "city"), ("name", "A"), ("name", "B")], [("name", None)], [], None]
    assert values(spark, data, lambda v: tag_value(v, "name"), TAGS) == ["A", None, None, None]
    assert values(spark, data, lambda v: has_tag(v, "name"), TAGS) == [True, False, False, None]
    assert values(spark, data, lambda v: has_tag(v, "place", "city"), TAGS) == [True, False, False, None]
    assert values(spark, data, tag_map, TAGS)[0] == {"place": "city", "name": "B"}


def test_lists(spark):
    assert values(spark, [[1, 3, None, 2]], sort_desc, "array<int>") == [[3, 2, 1, None]]
    df = spark.createDataFrame([(1, "a| b ||c"), (2, ""), (3, None)], "i int, v string")
    full = [(1, "a"), (1, "b"), (1, "c")]
    assert rows(explode_list(df, "v", "|", "part", keep_empty=False), "i", "part") == full
    assert rows(explode_list(df, "v", "|", "part"), "i", "part") == [(1, ""), *full, (2, "")]


def test_traits_survive_filters(spark):
    register_trait("letter_grade")
    df = spark.range(3).select(
        tag(F.col("id"), "price", "usd"), tag(F.col("id"), "grade", "letter_grade"), F.col("id")
    )
    assert traits(df.filter("id > 0")) == {"price": "usd", "grade": "letter_grade"}

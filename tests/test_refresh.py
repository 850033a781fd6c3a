"""Refresh of partitions, distinct counts from rollups, calendar filling, views."""

import datetime as dt
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Dataset
from grainframe.operators import fill_periods, lagged
from grainframe.sources import (
    RollupMeasure,
    distinct_read,
    distinct_write,
    refresh_partitions,
    rollup_read,
    rollup_write,
)

def _month():
    return "month", F.date_format("at", "yyyy-MM")


def _build(df):
    return df.groupBy("k", _month()[1].alias("month")).agg(F.sum("v").alias("v"), F.max("at").alias("newest"))


def _source(spark, items):
    data = [(k, None if at is None else dt.date.fromisoformat(at), v) for k, at, v in items]
    return spark.createDataFrame(data, "k string, at date, v int")


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_only_partitions_after_the_watermark_are_built(spark, tmp_path):
    path = tmp_path / "monthly"
    first = [("a", "2024-01-05", 1), ("b", "2024-01-07", 2), ("a", "2024-02-10", 4), ("a", None, 9)]
    got = refresh_partitions(_source(spark, first), str(path), "at", _month(), _build)
    assert rows(got.select("k", "month", "v")) == rows(_build(_source(spark, first)).select("k", "month", "v"))
    before = _files(path)
    again = refresh_partitions(_source(spark, first), str(path), "at", _month(), _build)
    assert _files(path) == before and again.count() == 4
    more = [*first, ("b", "2024-02-10", 8), ("b", "2024-02-11", 16), ("c", "2024-04-01", 32), (None, None, 64)]
    got = refresh_partitions(_source(spark, more), str(path), "at", _month(), _build)
    columns = ["k", "month", "v", "newest"]
    assert rows(got.select(columns)) == rows(_build(_source(spark, more)).select(columns))
    after = _files(path)
    january = [f for f in before if "2024-01" in f]
    assert january and all(after[f] == before[f] for f in january)
    assert not [f for f in before if "2024-02" in f and f in after]
    late = [*more, ("z", "2024-01-30", 128)]  # at or before the watermark, in a month that is not built again
    assert rows(refresh_partitions(_source(spark, late), str(path), "at", _month(), _build).select(columns)) == rows(got.select(columns))


def test_refresh_of_empty_sources(spark, tmp_path):
    path = str(tmp_path / "t")
    none = _source(spark, []).limit(0)
    assert refresh_partitions(none, path, "at", _month(), _build).count() == 0
    some = _source(spark, [("a", "2024-01-05", 1)])
    assert refresh_partitions(some, path, "at", _month(), _build).count() == 1
    assert refresh_partitions(none, path, "at", _month(), _build).count() == 1


def test_distinct_counts_from_rollups(spark, tmp_path):
    data = [(d, k % 7, None if k % 5 == 0 else k) for d in range(6) for k in range(d * 10, d * 10 + 40)] * 2
    df = spark.createDataFrame([*data, (None, 1, 3), (9, 1, None)], "day int, g int, k int")
    exact = {r.half: r.n for r in df.groupBy((F.col("day") / 3).cast("int").alias("half")).agg(F.count_distinct("k").alias("n")).collect()}
    dims = {"day": F.col("day"), "g": F.col("g")}
    half = {"half": (F.col("day") / 3).cast("int")}
    pairs = distinct_write(df, dims, F.col("k"), str(tmp_path / "pairs"))
    found = {r.half: r.n for r in distinct_read(pairs, half, "n").collect()}
    assert found == {h: n for h, n in exact.items() if n}  # a group without any key has no pair
    stored = rollup_write(df, dims, {"n": RollupMeasure("sketch", F.col("k"))}, str(tmp_path / "sketch"))
    guessed = {r.half: r.n for r in rollup_read(stored, half, {"n": "sketch"}).collect()}
    assert guessed.keys() == exact.keys() and all(abs(guessed[h] - n) <= 0.09 * n for h, n in exact.items())
    with pytest.raises(ValueError):
        rollup_read(stored, half, {"n": "distinct"})


def test_calendar_filling(spark):
    day = dt.date
    data = [("a", day(2023, 11, 1), 5), ("a", day(2024, 2, 1), 7), ("b", day(2024, 1, 1), 1), (None, day(2024, 1, 1), 2),
            (None, day(2024, 3, 1), 3), ("c", None, 4), ("a", None, 8)]
    df = spark.createDataFrame(data, "g string, m date, n int").withColumn("extra", F.lit("x"))
    found = fill_periods(df, "m", "month", ["g"], {"n": 0})
    added = [("a", day(2023, 12, 1), 0), ("a", day(2024, 1, 1), 0), (None, day(2024, 2, 1), 0)]
    assert rows(found.select("g", "m", "n")) == sorted(
        [*data, *added], key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
    assert {r.extra for r in found.where("n = 0").collect()} == {None} and found.columns == df.columns
    grown = lagged(found.where("g = 'a' and m is not null"), "n", "m", within=["g"])
    assert {r.m: r.previous for r in grown.collect()}[day(2024, 2, 1)] == 0
    assert fill_periods(df.limit(0), "m", "month", ["g"]).count() == 0
    hours = spark.sql("SELECT timestamp_ntz'2024-01-01 22:00' AS h UNION ALL SELECT timestamp_ntz'2024-01-02 01:00'")
    assert fill_periods(hours, "h", "hour").count() == 4
    for unit, last in (("quarter", "2024-07-01"), ("week", "2024-01-15"), ("year", "2026-01-01"), ("day", "2024-01-03")):
        ends = spark.sql(f"SELECT date'2024-01-01' AS d UNION ALL SELECT date'{last}'")
        assert fill_periods(ends, "d", unit).count() == 3, unit
    with pytest.raises(ValueError):
        fill_periods(df, "m", "fortnight")


def test_views_of_a_catalog(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    Catalog().register(Dataset("grain_view_test", df, ("id",)), view=True)
    try:
        assert spark.sql("SELECT v FROM grain_view_test WHERE id = 2").first().v == "y"
    finally:
        spark.catalog.dropTempView("grain_view_test")

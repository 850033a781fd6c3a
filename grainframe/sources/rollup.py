"""Rollups written at a coarser grain, and choosing or refreshing stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainframe.operators.measures import additive
from grainframe.sources.write import materialize


@dataclass(frozen=True)
class RollupMeasure:
    """A stored measure: ``kind`` is sum, count, min, max or sketch over ``value``.

    A sketch stores what distinct counts are estimated from: 2^12 registers a group,
    which are merged when the rollup is read; the standard error is 1.04 / 2^6, 1.6 %.
    Values are ints, longs or text.  See :func:`distinct_write` for exact counts.
    """

    kind: str
    value: Column

    def build(self) -> Column:
        return {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "sketch": _sketch}[self.kind](self.value)


#: Registers of a distinct sketch, as a power of two.
SKETCH_BITS = 12


def _sketch(value: Column) -> Column:
    return F.hll_sketch_agg(value, SKETCH_BITS)


def _combined(kind: str, name: str) -> Column:
    if kind == "sketch":
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0))
    return additive(kind, name)


def rollup_write(
    df: DataFrame, dims: Mapping[str, Column], measures: Mapping[str, RollupMeasure], path: str
) -> DataFrame:
    """Store measures at the grain of ``dims``; kinds that cannot be combined are refused."""
    for name, measure in measures.items():
        _combined(measure.kind, name)
    groups = df.groupBy(*[c.alias(n) for n, c in dims.items()])
    return materialize(groups.agg(*[m.build().alias(n) for n, m in measures.items()]), path)


def rollup_read(
    rollup: DataFrame, dims: Mapping[str, Column], measures: Mapping[str, str]
) -> DataFrame:
    """Answer a coarser question from a rollup; ``measures`` maps name to its kind."""
    groups = rollup.groupBy(*[c.alias(n) for n, c in dims.items()])
    return groups.agg(*[_combined(kind, name).alias(name) for name, kind in measures.items()])


def distinct_write(df: DataFrame, dims: Mapping[str, Column], key: Column, path: str) -> DataFrame:
    """Store the distinct ``(dims, key)`` pairs, from which any coarser distinct count is exact.

    Rows without a key are left out, as they are by ``count(DISTINCT key)``.
    """
    pairs = df.select(*[c.alias(n) for n, c in dims.items()], key.alias("key")).where("key is not null")
    return materialize(pairs.distinct(), path)


def distinct_read(pairs: DataFrame, dims: Mapping[str, Column], out: str) -> DataFrame:
    """Exact distinct keys per coarser ``dims`` from stored pairs.

    Pairs are made distinct at the coarser grain and then counted, so a group that holds
    most keys is counted by many tasks.
    """
    coarse = pairs.select(*[c.alias(n) for n, c in dims.items()], "key").distinct()
    return coarse.groupBy(*dims).agg(F.count("key").alias(out))


def pick_source(
    where: Sequence[str], candidates: Sequence[tuple[DataFrame, str | None]]
) -> DataFrame:
    """The first table that is complete for a filter, with the filter applied.

    Each candidate is ``(table, complete_where)``: it holds every row meeting
    ``complete_where`` (``None``: every row).  It is used if that predicate is
    one of the conjuncts in ``where``; no implication is worked out.
    """
    for df, complete_where in candidates:
        if complete_where is None or complete_where in where:
            for condition in where:
                df = df.filter(condition)
            return df
    raise ValueError(f"no candidate is complete for {' and '.join(where)}")


def freshness(df: DataFrame, column: str, as_of: dt.datetime | str, by: Sequence[str] = ()) -> DataFrame:
    """Newest value of the freshness column and whole days between it and ``as_of``."""
    newest = df.groupBy(*by).agg(F.max(column).alias("newest"))
    lag = F.date_diff(F.to_date(F.lit(as_of)), F.to_date("newest"))
    return newest.withColumn("lag_days", lag)


def refresh(
    spark: SparkSession,
    read_path: str,
    write_path: str,
    column: str,
    build: Callable[[], DataFrame],
    max_age_days: int,
    as_of: dt.datetime | str,
) -> DataFrame:
    """The stored table, built to ``write_path`` first if there is none or its newest row is too old."""
    try:
        stored = spark.read.parquet(read_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return materialize(build(), write_path)
    lag = freshness(stored, column, as_of).first()["lag_days"]
    if lag is not None and lag <= max_age_days:
        return stored
    return materialize(build(), write_path)


def refresh_partitions(
    source: DataFrame,
    path: str,
    column: str,
    partition: tuple[str, Column],
    build: Callable[[DataFrame], DataFrame],
    newest: str = "newest",
) -> DataFrame:
    """A stored table brought up to date by building only the partitions that new rows can touch.

    ``partition`` is ``(name, expression)`` over ``source``; the expression must not fall
    as ``column`` rises, such as its month.  ``build`` makes the table from source rows
    and keeps ``name`` and, as ``newest``, the greatest ``column`` of each row.  The
    greatest stored ``newest`` is the watermark: if the source holds later rows, the
    watermark's partition and those after it are built from all their source rows and
    replace the stored ones; files of earlier partitions are not touched, so rows that
    arrive with a ``column`` at or before the watermark are only taken up where their
    partition is built again.  Rows whose ``column`` is null lie in the partition of
    null, which is built along with the others.  Without a stored table all is built.

    Only ``newest`` and the partition are read of the stored table.  The replaced
    partitions are committed together by the writer, so a lost executor repeats its tasks.
    """
    name, expression = partition
    spark = source.sparkSession
    fresh = build(source)

    def write(df: DataFrame, mode: str) -> None:
        spread = df.hint("rebalance", F.col(name))
        spread.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(name).parquet(path)

    try:
        stored = spark.read.schema(fresh.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        write(fresh, "static")
        return spark.read.schema(fresh.schema).parquet(path)
    mark = stored.agg(F.max(newest).alias("at"), F.max_by(name, newest).alias("part")).first()
    late = source if mark["at"] is None else source.where(F.col(column) > F.lit(mark["at"]))
    if not late.isEmpty():
        stale = source if mark["at"] is None else source.where((expression >= F.lit(mark["part"])) | F.col(column).isNull())
        write(build(stale), "dynamic")
    return spark.read.schema(fresh.schema).parquet(path)

"""Writers and load jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainframe.session import cut_lineage
from grainframe.sources.quoted import quoted_to_parquet
from grainframe.sources.scan import Schema


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Create or replace a table from a query and return what was written."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_table(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Create or replace a catalog table laid out in buckets of ``key``.

    Two tables with equal bucket counts join or aggregate on the key without a
    shuffle.  The rebalance hint brings each bucket to few writers, so files
    stay large, and splits a bucket with a hot key over several.
    """
    spread = df.hint("rebalance", buckets, F.col(key))
    writer = spread.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_bucketed(df: DataFrame, path: str, key: str, n: int, column: str = "mod_division") -> DataFrame:
    """Parquet partitioned by ``key`` modulo ``n``.

    The rebalance hint brings each bucket to few writers, so files stay large,
    and splits a bucket too big for one writer.
    """
    bucketed = df.withColumn(column, F.pmod(F.col(key), F.lit(n)).cast("int"))
    bucketed.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(bucketed.schema).parquet(path)


def export(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Write only ``columns``."""
    return materialize(df.select(*columns), path)


def load(df: DataFrame, path: str, disposition: str = "truncate") -> DataFrame:
    """Load into a table: ``truncate`` replaces its rows, ``append`` adds to them."""
    modes = {"truncate": "overwrite", "append": "append"}
    if disposition not in modes:
        raise ValueError(f"disposition must be truncate or append, not {disposition!r}")
    return materialize(df, path, modes[disposition])


def csv_to_parquet(spark: SparkSession, source: str, target: str, schema: Schema | None = None) -> DataFrame:
    """Convert CSV files with a header to parquet, each file by one task per split."""
    return quoted_to_parquet(spark, source, target, schema)


def append_new(target: str, incoming: DataFrame, key: str, newest: str | None = None) -> DataFrame:
    """Append incoming rows whose key the target does not hold yet.

    Of incoming rows that share a key the one with the greatest ``newest`` stays (nulls
    last; ties by the row's other values, so the choice does not change between runs).
    A null key is a key like any other; running the job again adds nothing.

    The work follows the batch: only the target's key column is read, row groups outside
    the batch's key range are skipped, and the keys left are reduced to those the batch
    holds too (by a broadcast where the batch's keys are few) before they are made
    distinct and taken out of the batch.
    """
    spark = incoming.sparkSession
    rest = [c for c in incoming.columns if c not in (key, newest)]
    order = ([F.col(newest)] if newest else []) + [F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})] * bool(rest)
    if order:
        first = F.max_by(F.struct(*incoming.columns), F.struct(*[F.struct(o.isNotNull(), o) for o in order]))
        batch = incoming.groupBy(F.col(key).alias("__batch")).agg(first.alias("__row")).select("__row.*")
    else:
        batch = incoming.distinct()
    batch = cut_lineage(batch, "new-keys")
    hits = _held_keys(spark.read.parquet(target), batch, key)
    batch.join(hits, F.col(key).eqNullSafe(F.col("__known")), "left_anti").write.mode("append").parquet(target)
    return spark.read.schema(incoming.schema).parquet(target)


def _held_keys(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Keys of ``batch`` that ``stored`` holds, as ``__known``; only keys in the batch's range are read."""
    span = batch.agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count_if(F.col(key).isNull()).alias("nulls")
    ).first()
    known = stored.select(F.col(key).alias("__known"))
    within = F.lit(False) if span.low is None else F.col("__known").between(F.lit(span.low), F.lit(span.high))
    if span.nulls:
        within = within | F.col("__known").isNull()
    same = F.col("__known").eqNullSafe(F.col(key))
    return known.where(within).join(batch.select(key), same, "left_semi").distinct()

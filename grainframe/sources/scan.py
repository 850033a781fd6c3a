"""File scans.  Pass a schema for large inputs: inference reads the text once more.

Quoted fields of delimited text may hold line breaks, so here one task reads a whole
file.  For large files, ``scan_quoted`` reads by splits and keeps such fields, and where
every record is one line, ``multiLine="false"`` splits as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Schema = StructType | str


def scan_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: Schema | None = None
) -> DataFrame:
    """Parquet files, only the named columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns is not None else df


def _delimited(spark: SparkSession, path: str, sep: str, schema: Schema | None, **options) -> DataFrame:
    reader = spark.read.option("header", "true").option("sep", sep).option("escape", '"')
    reader = reader.option("multiLine", "true")
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is None:
        reader = reader.option("inferSchema", "true").option("samplingRatio", "1.0")
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_csv(spark: SparkSession, path: str, schema: Schema | None = None, **options) -> DataFrame:
    """CSV with a header; types from ``schema`` or from the whole file."""
    return _delimited(spark, path, ",", schema, **options)


def scan_tsv(spark: SparkSession, path: str, schema: Schema | None = None, **options) -> DataFrame:
    """Tab-separated text with a header; types from ``schema`` or from the whole file."""
    return _delimited(spark, path, "\t", schema, **options)

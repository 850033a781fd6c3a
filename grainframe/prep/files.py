"""Raw delimited files: structure checks and commented tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainframe.prep.columns import fix_headers


_QUOTED = '"[^"]*"'


def _fields(line: Column, sep: str) -> Column:
    """Number of fields of a line; separators inside quotes do not count."""
    return F.size(F.split(F.regexp_replace(line, _QUOTED, ""), re.escape(sep)))


def _names(header: str, sep: str) -> list[str]:
    """Names of a header line, split by the rule of ``_fields``."""
    inside = [found.span() for found in re.finditer(_QUOTED, header)]
    outer = [
        cut.span()
        for cut in re.finditer(re.escape(sep), header)
        if not any(start <= cut.start() < end for start, end in inside)
    ]
    starts, ends = [0, *[end for _, end in outer]], [*[start for start, _ in outer], len(header)]
    return [header[a:b].strip().strip('"') for a, b in zip(starts, ends)]


def _header(lines: DataFrame, header: str | None) -> str | None:
    """The given header line, or the first line of a single file."""
    if header is not None:
        return header
    first = lines.first()
    return None if first is None else first["value"]


def check_delimited(
    spark: SparkSession, path: str, sep: str = ",", header: str | None = None
) -> DataFrame:
    """Structure problems of delimited text with one record per line.

    Rows ``(problem, detail, fields, expected)``: every ragged line, and blank
    or repeated header names.  All offenders are returned; sort and limit for a
    short report.  A folder of files without headers needs ``header``.
    """
    lines = spark.read.text(path)
    first = _header(lines, header)
    if first is None:
        empty = lines.agg(F.count(F.lit(1)).alias("fields"))
        return empty.select(
            F.lit("empty file").alias("problem"),
            F.lit(path).alias("detail"),
            F.col("fields").cast("int"),
            F.lit(0).alias("expected"),
        )
    names = _names(first, sep)
    width = len(names)
    count = _fields(F.col("value"), sep)
    ragged = lines.filter((F.col("value") != "") & (count != width))
    out = ragged.select(
        F.lit("ragged row").alias("problem"),
        F.col("value").alias("detail"),
        count.alias("fields"),
        F.lit(width).alias("expected"),
    )
    found = [("blank header", f"position {i}") for i, n in enumerate(names, start=1) if not n]
    found += [("repeated header", n) for n in sorted({n for n in names if n and names.count(n) > 1})]
    if found:
        rows = [(problem, detail, width, width) for problem, detail in found]
        schema = "problem string, detail string, fields int, expected int"
        out = out.unionByName(spark.createDataFrame(rows, schema))
    return out


def read_commented_tsv(
    spark: SparkSession, path: str, sep: str = "\t", mark: str = "#", header: str | None = None
) -> DataFrame:
    """Delimited text whose first line is the header (marked or not) and with comment lines.

    Comment and empty lines are dropped, fields are trimmed, all columns are
    text.  A header in the file is the first line of each file; lines equal to it
    further down are data.  A folder of files without headers needs ``header``.
    """
    first = _header(spark.read.text(path), header)
    if first is None:
        raise ValueError(f"no header line in {path}")
    names = fix_headers(first.lstrip(mark).strip().split(sep))
    rows = (
        spark.read.schema(", ".join(f"c{i} string" for i in range(len(names))))
        .option("sep", sep)
        .option("comment", mark)
        .option("header", header is None and not first.startswith(mark))
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return rows.filter(~F.coalesce(F.col("c0").startswith(mark), F.lit(False))).toDF(*names)

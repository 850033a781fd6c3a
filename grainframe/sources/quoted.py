"""Delimited files whose quoted fields hold line breaks, read by one task per file split.

A reader that honours such quotes has to read a file from its start, so one task takes a
whole file.  Here the lines of every split are read by their own task, and what a task
cannot know, whether its split starts inside quotes, is carried over the splits: a line
lies inside quotes if an odd number of quotes stand before it in its file.

Lines of one split are numbered and their quotes summed in a window of the split, for
either start; one summary row per split then says which of the two holds.  A record is a
line outside quotes and the lines inside quotes after it, which may reach over several
splits.  Records of one line, usually nearly all, are not brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grainframe.session import cut_lineage, scratch_path
from grainframe.sources.scan import Schema

_PLACE = ("file", "block")


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, split start, place in the split and quote counts, written once.

    ``before`` counts the quotes of earlier lines of the split; ``last0`` and ``last1``
    are the latest line up to this one that starts a record if the split starts outside
    (0) or inside (1) quotes.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    numbered = lines.withColumns({"line": F.monotonically_increasing_id(), "quotes": quotes.cast("long")})
    along = Window.partitionBy(*_PLACE).orderBy("line")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    counted = numbered.withColumns(
        {
            "before": F.sum("quotes").over(upto) - F.col("quotes"),
            "nth": F.row_number().over(along).cast("long"),
        }
    )
    starts = {
        f"last{k}": F.max(F.when(F.col("before") % 2 == k, F.col("nth"))).over(upto) for k in (0, 1)
    }
    return cut_lineage(counted.withColumns(starts).drop("line"), "quoted-lines")


def _split_facts(lines: DataFrame) -> DataFrame:
    """Per split: whether it starts inside quotes and the record that was open before it.

    One row per split, at most some hundred thousand for the largest inputs; windows
    over them are per file.  Files with an odd number of quotes have a field that is never
    closed and are refused.
    """
    each = lines.groupBy(*_PLACE).agg(
        F.sum("quotes").alias("quotes"), F.max("last0").alias("end0"), F.max("last1").alias("end1")
    )
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    facts = each.withColumn("inside", odd)
    end = F.when(F.col("inside") == 1, F.col("end1")).otherwise(F.col("end0"))
    facts = facts.withColumn("end", F.when(end.isNotNull(), F.struct("block", end.alias("nth"))))
    facts = cut_lineage(
        facts.withColumn("open", F.last("end", ignorenulls=True).over(earlier)), "quoted-splits"
    )
    total = facts.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).where("odd = 1")
    unclosed = [r.file for r in total.select("file").orderBy("file").limit(5).collect()]
    if unclosed:
        raise ValueError(f"a quoted field is never closed in {', '.join(unclosed)}")
    return facts.select(*_PLACE, "inside", "open")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record``: every record as text; ``first`` marks a file's first one.

    Line breaks inside quotes are kept as they are; a carriage return before the line
    feed that ends a record is left out, and so are empty lines between records.
    """
    lines = _placed_lines(spark, path)
    splits = _split_facts(lines)
    start = F.when(F.col("inside") == 1, F.col("last1")).otherwise(F.col("last0"))
    home = F.when(start.isNotNull(), F.struct("block", start.alias("nth"))).otherwise(F.col("open"))
    keyed = lines.join(splits, list(_PLACE)).select(
        "file",
        home.alias("home"),
        F.struct("block", "nth").alias("at"),
        "value",
        ((F.col("quotes") % 2 == 0) & home.eqNullSafe(F.struct("block", "nth"))).alias("whole"),
    )
    single = keyed.where("whole").select("file", "home", F.col("value").alias("record"))
    parts = keyed.where("not whole").groupBy("file", "home").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("lines"))
    joined = parts.select("file", "home", F.array_join("lines.value", "\n").alias("record"))
    text = F.regexp_replace("record", r"\r\z", "")
    first = (F.col("home.block") == 0) & (F.col("home.nth") == 1)
    records = single.unionByName(joined).select("file", first.alias("first"), text.alias("record"))
    return records.where("first or record <> ''")


def _parsed(record: Column, schema: str, sep: str, **options) -> Column:
    settings = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    return F.from_csv(record, schema, settings | options)


def _names(header: str, sep: str) -> list[str]:
    """Fields of a header record; quotes may hold separators, line breaks and doubled quotes."""
    names, field, inside, i = [], "", False, 0
    while i < len(header):
        if header[i] == '"':
            if inside and header[i + 1 : i + 2] == '"':
                field, i = field + '"', i + 1
            else:
                inside = not inside
        elif not inside and header.startswith(sep, i):
            names.append(field)
            field, i = "", i + len(sep) - 1
        else:
            field += header[i]
        i += 1
    return [*names, field]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def infer_types(df: DataFrame) -> dict[str, str]:
    """The narrowest type that every value of each text column fits, in one pass.

    Tried in turn: int, bigint, double, date (``yyyy-MM-dd``), timestamp (date and time),
    boolean (true or false); else, and for a column without values, string.
    """
    forms = {
        "int": "", "bigint": "", "double": "",
        "date": r"^\d{4}-\d{2}-\d{2}$", "timestamp": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}", "boolean": "(?i)^(true|false)$",
    }
    order = tuple(forms)

    def fits(c: str, kind: str) -> Column:
        value = F.col(_quoted(c))
        return value.try_cast(kind).isNotNull() & (value.rlike(forms[kind]) if forms[kind] else F.lit(True))

    tests = [
        F.count_if(F.col(_quoted(c)).isNotNull() & ~fits(c, kind)).alias(f"{i}:{kind}")
        for i, c in enumerate(df.columns)
        for kind in order
    ]
    held = [F.count(_quoted(c)).alias(f"{i}:n") for i, c in enumerate(df.columns)]
    found = df.agg(*tests, *held).first()
    return {
        c: next((kind for kind in order if found[f"{i}:n"] and not found[f"{i}:{kind}"]), "string")
        for i, c in enumerate(df.columns)
    }


def quoted_to_parquet(
    spark: SparkSession, source: str, target: str, schema: Schema | None = None, sep: str = ",", **options
) -> DataFrame:
    """Convert delimited files with a header to parquet, each file by as many tasks as it has splits.

    Fields follow RFC 4180: a field with a quote, separator or line break is quoted, and
    quotes inside are doubled.  Fields are taken by place; the first record of each file
    is its header.  Without ``schema`` the header of the first file names the columns and
    types come from all values.  ``options`` are those of ``from_csv``.  Rows are those
    that ``scan_csv`` gives, in no certain order.
    """
    records = quoted_records(spark, source)
    if schema is None:
        head = records.where("first").orderBy("file").limit(1).collect()
        names = _names(head[0].record, sep) if head else []
        if not names:
            raise ValueError(f"no header in {source}")
        text = ", ".join(f"{_quoted(n)} string" for n in names)
        written = cut_lineage(
            records.where("not first").select(_parsed(F.col("record"), text, sep, **options).alias("r")).select("r.*"),
            "quoted-text",
        )
        types = infer_types(written)
        rows = written.select(*[F.col(_quoted(c)).cast(kind).alias(c) for c, kind in types.items()])
    else:
        ddl = schema.simpleString()[len("struct<") : -1] if isinstance(schema, StructType) else schema
        rows = records.where("not first").select(_parsed(F.col("record"), ddl, sep, **options).alias("r")).select("r.*")
    rows.write.mode("overwrite").parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


def scan_quoted(spark: SparkSession, path: str, schema: Schema | None = None, sep: str = ",", **options) -> DataFrame:
    """:func:`quoted_to_parquet` into the shared scratch folder."""
    return quoted_to_parquet(spark, path, scratch_path(spark, "quoted"), schema, sep, **options)

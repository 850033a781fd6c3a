"""Lists, key/value tags and delimited text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_map(tags: Column) -> Column:
    """``array<struct<key,value>>`` as a map; of repeated keys the last one stays.

    Repeats are legal in tag lists but not in ``map_from_entries``, so earlier
    repeats are dropped by position first.
    """
    kept = F.filter(
        tags,
        lambda t, i: F.array_position(
            F.transform(F.slice(tags, i + 2, F.size(tags)), lambda later: later.getField("key")),
            t.getField("key"),
        )
        == 0,
    )
    return F.map_from_entries(kept)


def tag_value(tags: Column, key: str) -> Column:
    """Value of the first tag named ``key``, null where there is none."""
    hits = F.filter(tags, lambda t: t.getField("key") == key)
    return F.try_element_at(hits, F.lit(1)).getField("value")


def has_tag(tags: Column, key: str, value: str | None = None) -> Column:
    """True if a tag named ``key`` exists (with ``value``, or with any non-null one)."""
    if value is None:
        return F.exists(
            tags, lambda t: (t.getField("key") == key) & t.getField("value").isNotNull()
        )
    return F.exists(tags, lambda t: (t.getField("key") == key) & (t.getField("value") == value))


def sort_desc(items: Column) -> Column:
    """Array sorted from high to low; structs compare by their first field first."""
    return F.sort_array(items, asc=False)


def explode_list(
    df: DataFrame, column: str, separator: str, out: str, keep_empty: bool = True
) -> DataFrame:
    """One row per trimmed part of a delimited text column, empty parts included unless unwanted."""
    parts = F.transform(F.split(F.col(column), re.escape(separator)), lambda p: F.trim(p))
    return df.withColumn(out, F.explode(parts if keep_empty else F.filter(parts, lambda p: p != "")))

"""All declarations about a table checked in one scan of it.

Every key that a check needs (a grain, an alternate key, either end of an edge) leaves a
row as ``(tag, key, facts, dims)``; the tag names the check.  One aggregate then has the
counts per tag and key, with a map-side part, so a hot key is one row before the shuffle.
A value that breaks a declaration leaves a row of its own tag in the same scan; sound
tables leave none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT, DIM = "facts", "dims"


@dataclass(frozen=True)
class KeyUse:
    """Columns of a table as the key of check ``tag``, on its ``side``; ``types`` are compared."""

    tag: int
    side: str
    columns: tuple[str, ...]
    types: tuple[T.DataType, ...]


@dataclass(frozen=True)
class Breach:
    """Rows that break a declaration."""

    tag: int
    broken: Column


def as_text(value: Column, kind: T.DataType) -> Column:
    """Text that is equal for equal values of a type only; null stays null."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return value.cast("string")


def types_of(df: DataFrame, columns: Sequence[str]) -> tuple[T.DataType, ...]:
    return tuple(df.schema[c].dataType for c in columns)


def common_types(a: DataFrame, left: Sequence[str], b: DataFrame, right: Sequence[str]) -> tuple[T.DataType, ...]:
    """The types in which columns of two tables are compared, as in a union of them."""
    if types_of(a, left) == types_of(b, right):
        return types_of(a, left)
    return tuple(f.dataType for f in a.select(*left).union(b.select(*right)).schema)


def _row(tag: int, key: Column, side: str) -> Column:
    counts = [F.lit(int(side == s)).cast("long").alias(s) for s in (FACT, DIM)]
    return F.struct(F.lit(tag).alias("tag"), key.alias("key"), *counts)


def tagged_keys(df: DataFrame, uses: Sequence[KeyUse], breaches: Sequence[Breach] = ()) -> DataFrame:
    """``tag, key, facts, dims`` of all uses and breaches, in one scan."""
    rows = [
        _row(
            use.tag,
            F.array(*[as_text(F.col(c).cast(kind), kind) for c, kind in zip(use.columns, use.types)]),
            use.side,
        )
        for use in uses
    ]
    none = F.array().cast("array<string>")
    bad = [F.when(b.broken, _row(b.tag, none, FACT)) for b in breaches]
    every = F.array(*rows) if rows else None
    if bad:
        broken = F.filter(F.array(*bad), lambda r: r.isNotNull())
        every = broken if every is None else F.concat(every, broken)
    return df.select(F.inline(every))


def counts_by_tag(keys: Sequence[DataFrame]) -> DataFrame:
    """Per tag: what :func:`checks.check_fk` counts, and ``repeated`` keys of the ``dims`` side."""
    per_key = reduce(DataFrame.unionByName, keys).groupBy("tag", "key").agg(
        F.sum(FACT).alias(FACT), F.sum(DIM).alias(DIM)
    )
    known = ~F.exists("key", lambda v: v.isNull())
    facts, dims = F.col(FACT), F.col(DIM)

    def total(value: Column, condition: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    one = F.lit(1)
    return per_key.groupBy("tag").agg(
        total(facts, F.lit(True)).alias("fact_rows"),
        total(facts, ~known).alias("null_rows"),
        total(facts, known & (dims == 0)).alias("dangling_rows"),
        total(one, known & (dims > 0)).alias("dim_keys"),
        total(one, known & (dims > 0) & (facts == 0)).alias("unused_keys"),
        total(one, dims > 1).alias("repeated"),
    )


def edge_uses(
    tag: int, source: str, target: str, on: Mapping[str, str], tables: Mapping[str, DataFrame]
) -> list[tuple[str, KeyUse]]:
    """Both ends of an edge, each with the name of its table."""
    left, right = tuple(on), tuple(on.values())
    types = common_types(tables[source], left, tables[target], right)
    return [(source, KeyUse(tag, FACT, left, types)), (target, KeyUse(tag, DIM, right, types))]

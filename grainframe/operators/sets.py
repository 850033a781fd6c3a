"""Top-k with a tie-breaker and wide-to-tall reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.operators.ordering import Order, sort_columns


def topk(
    df: DataFrame, order: Order, n: int, tie_break: Sequence[str] = (), hidden: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` rows of the order (a per-task top-k, then a merge)."""
    columns = sort_columns([*order, *[(c, "asc") for c in tie_break]])
    return df.orderBy(*columns).limit(n).drop(*hidden)


def union_sides(
    df: DataFrame,
    sides: Mapping[str, Mapping[str, Column]],
    common: Sequence[str] = (),
    label: str = "side",
) -> DataFrame:
    """One row per side of each wide row; every side gives the same output columns.

    The sides become an array that is unfolded, so the wide table is read once
    instead of once per branch of a union.
    """
    items = [
        F.struct(F.lit(name).alias(label), *[c.alias(n) for n, c in columns.items()])
        for name, columns in sides.items()
    ]
    return df.select(*common, F.inline(F.array(*items)))

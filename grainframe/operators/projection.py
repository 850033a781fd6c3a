"""Hidden columns, column replacement and shared filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame


def select_hidden(
    df: DataFrame,
    hidden: Sequence[str],
    having: Column | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Filter, sort and cut using columns that are then left out of the result."""
    if having is not None:
        df = df.filter(having)
    if order:
        df = df.orderBy(*order)
    if limit is not None:
        df = df.limit(limit)
    return df.drop(*hidden)


def replace_columns(
    df: DataFrame, new: Mapping[str, Column] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """``SELECT * EXCLUDE (drop), new`` with replaced columns kept in place."""
    return df.drop(*drop).withColumns(dict(new or {}))


def apply_filter(
    queries: Mapping[str, Callable[[DataFrame], DataFrame]], df: DataFrame, condition: Column
) -> dict[str, DataFrame]:
    """Run a set of queries on the same filtered input."""
    filtered = df.filter(condition)
    return {name: query(filtered) for name, query in queries.items()}

"""Physical columns under logical names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(
    df: DataFrame,
    columns: Mapping[str, str | Sequence[str]],
    exprs: Mapping[str, Column | str] | None = None,
    allow_repeat: bool = False,
) -> DataFrame:
    """Select ``columns`` (physical to logical) and computed columns (logical to expression).

    A physical column may feed several logical ones (give a list).  With
    ``allow_repeat`` a logical name may be fed by several physical columns: the
    first non-null one is taken.
    """
    feeds: dict[str, list[str]] = {}
    for physical, logical in columns.items():
        for name in [logical] if isinstance(logical, str) else logical:
            feeds.setdefault(name, []).append(physical)
    repeated = [n for n, cols in feeds.items() if len(cols) > 1]
    if repeated and not allow_repeat:
        raise ValueError(f"bound more than once: {', '.join(repeated)}")
    out = [
        (F.col(cols[0]) if len(cols) == 1 else F.coalesce(*[F.col(c) for c in cols])).alias(name)
        for name, cols in feeds.items()
    ]
    for name, expr in (exprs or {}).items():
        out.append((F.expr(expr) if isinstance(expr, str) else expr).alias(name))
    return df.select(*out)


def bind_nested(df: DataFrame, record: str, fields: Sequence[str], prefix: str = "") -> DataFrame:
    """Fields of a struct column as columns of their own, the struct dropped."""
    taken = {prefix + f: F.col(record).getField(f) for f in fields}
    return df.withColumns(taken).drop(record)


def view(df: DataFrame, where: Column, columns: Mapping[str, str], name: str | None = None) -> DataFrame:
    """A filtered, renamed slice of a table as a dataset, optionally a temp view."""
    out = bind(df.filter(where), columns)
    if name is not None:
        out.createOrReplaceTempView(name)
    return out

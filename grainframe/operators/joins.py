"""Joins that say which side survives.

No broadcast hints: Catalyst broadcasts a side whose file size is below
``spark.sql.autoBroadcastJoinThreshold``, adaptive execution does the same for
a side found small at run time, and larger sides get a sort-merge join whose
skewed partitions are split.  Splitting a skewed partition of the preserved
partner is impossible in a full join (and for the right side of a left join),
so those are built from a match/left join plus an anti join on distinct keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

On = str | Sequence[str] | Mapping[str, str]


def _pairs(on: On) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: On,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    keep: str = "match",
) -> DataFrame:
    """Add dimension attributes to facts; the dimension must be unique on its key.

    ``on`` maps fact columns to dimension columns and ``prefix`` keeps several
    roles of one dimension apart.  ``keep`` picks the surviving side:

    - ``match``: both sides must match (complete reference)
    - ``fact``: facts without a dimension stay (nullable reference)
    - ``dim``: dimension rows without facts stay (partial reference)
    - ``all``: both stay (nullable and partial)
    """
    pairs = _pairs(on)
    keys = {f: f"__on{i}" for i, f in enumerate(pairs)}
    wanted = [c for c in dim.columns if c not in pairs.values()] if columns is None else columns
    # Without a prefix the columns keep their identity: a renaming alias would
    # hide that two uses of one join are the same exchange.
    side = dim.select(
        *[F.col(d).alias(keys[f]) for f, d in pairs.items()],
        *[F.col(c).alias(prefix + c) if prefix else F.col(c) for c in wanted],
    )
    condition = _all([F.col(f) == F.col(k) for f, k in keys.items()])
    how = "left" if keep in ("fact", "all") else "inner"
    joined = fact.join(side, condition, how).drop(*keys.values())
    if keep in ("match", "fact"):
        return joined
    used = fact.select(*keys).distinct()
    unused = side.join(used, condition, "left_anti")
    unused = unused.select(
        *[F.col(k).alias(f) for f, k in keys.items()], *[prefix + c for c in wanted]
    )
    return joined.unionByName(unused, allowMissingColumns=True)


def enrich_from_dim(
    dim: DataFrame, fact: DataFrame, on: On, measures: Mapping[str, Column], zero: Sequence[str] = ()
) -> DataFrame:
    """One row per dimension row with fact measures, facts or not.

    ``on`` maps dimension columns to fact columns.  Facts are aggregated to the
    key before the join, so a hot key is combined map-side and the join is one
    to one.  Measures named in ``zero`` (counts) are 0 instead of null.
    """
    pairs = _pairs(on)
    keys = {d: f"__on{i}" for i, d in enumerate(pairs)}
    totals = fact.groupBy(*[F.col(f).alias(keys[d]) for d, f in pairs.items()]).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    out = dim.join(totals, _all([F.col(d) == F.col(k) for d, k in keys.items()]), "left")
    return out.drop(*keys.values()).fillna(0, subset=list(zero))


def link(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    columns: Sequence[str] | None = None,
    prefix: str = "",
    keep: str = "fact",
) -> DataFrame:
    """Join two models on keys that both have to be computed."""
    made = right.withColumn("__link", right_key)
    out = enrich(
        left.withColumn("__left_link", left_key),
        made,
        {"__left_link": "__link"},
        columns if columns is not None else right.columns,
        prefix,
        keep,
    )
    return out.drop("__left_link")


def link_all(left: DataFrame, right: DataFrame, keys: Sequence[str], keep: str = "match") -> DataFrame:
    """Link two models on shared keys; of columns both have, the left one stays."""
    fresh = [c for c in right.columns if c not in left.columns]
    return enrich(left, right, list(keys), fresh, keep=keep)


def bridge(left: DataFrame, between: DataFrame, right: DataFrame, left_on: On, right_on: On) -> DataFrame:
    """Many-to-many join through a bridge table, one row per linked pair.

    The bridge is reduced to distinct pairs first: repeated links neither
    inflate measures nor travel through the two joins.
    """
    to_left, to_right = _pairs(left_on), _pairs(right_on)
    links = between.select(*to_left, *to_right).distinct()
    return enrich(enrich(links, left, to_left), right, to_right)


def decode(
    df: DataFrame, code: str, lookup: DataFrame, key: str, label: str, out: str, default: str | None = None
) -> DataFrame:
    """Code to label through a lookup table instead of a CASE with many branches."""
    side = lookup.select(F.col(key).alias("__code"), F.col(label).alias("__label"))
    joined = df.join(side, F.col(code) == F.col("__code"), "left")
    value = F.col("__label")
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    return joined.withColumn(out, value).drop("__code", "__label")


def has_match(df: DataFrame, other: DataFrame, on: On, out: str) -> DataFrame:
    """Flag rows whose key occurs in ``other``; never multiplies rows."""
    pairs = _pairs(on)
    keys = {a: f"__on{i}" for i, a in enumerate(pairs)}
    present = other.select(*[F.col(b).alias(keys[a]) for a, b in pairs.items()]).distinct()
    present = present.withColumn("__hit", F.lit(True))
    joined = df.join(present, _all([F.col(a) == F.col(k) for a, k in keys.items()]), "left")
    return joined.withColumn(out, F.col("__hit").isNotNull()).drop("__hit", *keys.values())


def _members(other: DataFrame, column: str) -> DataFrame:
    return other.select(F.col(column).alias("__member")).filter("__member is not null").distinct()


def keep_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows whose value occurs in a column of ``other``."""
    members = _members(other, other_column or column)
    return df.join(members, F.col(column) == F.col("__member"), "left_semi")


def keep_not_in(df: DataFrame, column: str, other: DataFrame, other_column: str | None = None) -> DataFrame:
    """Rows whose value does not occur in ``other``; nulls on either side never match or stay."""
    members = _members(other, other_column or column)
    known = df.filter(F.col(column).isNotNull())
    return known.join(members, F.col(column) == F.col("__member"), "left_anti")


def align(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Put frames that are unique on ``keys`` side by side, keeping every key.

    A union and one grouped pass: one shuffle of already aggregated rows for
    any number of frames, where a chain of full joins would take one per frame.
    Null keys align with each other.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def combine_facts(
    facts: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str]
) -> DataFrame:
    """Facts of equal grain side by side: each is aggregated to ``keys``, then aligned."""
    totals = [
        df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()]) for df, measures in facts
    ]
    return align(totals, keys)


def drill_across(
    selects: Sequence[tuple[DataFrame, Column, Mapping[str, Column]]],
    key: str,
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Independent aggregates of several facts on a shared key, plus derived columns.

    Each select is ``(frame, key expression, measures)`` and is filtered by its
    caller; a key present in only one of them stays.
    """
    totals = [
        df.groupBy(expr.alias(key)).agg(*[m.alias(n) for n, m in measures.items()])
        for df, expr, measures in selects
    ]
    return align(totals, [key]).withColumns(dict(derive or {}))

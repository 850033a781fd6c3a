"""Aggregation at the right grain.

Two rules live here and nowhere else.  Measures of a fact are aggregated over
its raw rows, never after a de-duplication by its declared key.  Attributes of
a dimension reached through a fact count once per dimension key within each
group, so a join cannot inflate them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from grainframe.functions.conditions import ratio
from grainframe.operators.joins import align

Measures = Mapping[str, Column]


def _aliased(measures: Measures) -> list[Column]:
    return [m.alias(n) for n, m in measures.items()]


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_keys(*keys: str | Column) -> Column:
    """Distinct keys in the group; rows with a null key part do not count."""
    return F.count_distinct(*[F.col(k) if isinstance(k, str) else k for k in keys])


def count_owners(attribute: str, *keys: str) -> Column:
    """Distinct owners (by key) of a non-null attribute."""
    has = F.col(attribute).isNotNull()
    return F.count_distinct(*[F.when(has, F.col(k)) for k in keys])


def headline(df: DataFrame, measures: Measures) -> DataFrame:
    """Whole-table measures, one row."""
    return df.agg(*_aliased(measures))


def with_total(df: DataFrame, measures: Measures, source: DataFrame | None = None) -> DataFrame:
    """Every row with measures taken over all rows (of ``source`` if given).

    A scalar subquery: evaluated once and handed to the tasks as a value, so no
    join and no window over the whole input.
    """
    base = df if source is None else source
    names = list(measures)
    total = base.agg(F.struct(*_aliased(measures)).alias("t")).scalar()
    out = df.withColumn("__total", total)
    return out.withColumns({n: F.col("__total").getField(n) for n in names}).drop("__total")


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the greatest value of ``column``."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def agg_by(df: DataFrame, measures: Measures, by: Sequence[str]) -> DataFrame:
    """Each row with measures taken over its ``by`` group.

    Aggregated and joined back: partial aggregation shrinks a hot group before
    the shuffle and the join may split or broadcast, whereas a window would
    sort the whole group in one task.  Null groups match each other.
    """
    renamed = {c: f"__by{i}" for i, c in enumerate(by)}
    totals = df.groupBy(*[F.col(c).alias(r) for c, r in renamed.items()]).agg(*_aliased(measures))
    condition = F.lit(True)
    for column, name in renamed.items():
        condition = condition & F.col(column).eqNullSafe(F.col(name))
    return df.join(totals, condition, "inner").drop(*renamed.values())


def agg_native(
    fact: DataFrame,
    dims: Sequence[str],
    dim: DataFrame,
    on: tuple[str, str],
    measures: Measures,
) -> DataFrame:
    """Measures of a dimension grouped by attributes of a fact, each key once per group.

    ``on`` is (fact column, dimension key).  Distinct (group, key) pairs are
    formed before the join, so the join sees pairs instead of fact rows.
    """
    fact_key, dim_key = on
    pairs = fact.select(*dims, F.col(fact_key).alias("__key")).distinct()
    side = dim.withColumnRenamed(dim_key, "__dim_key")
    joined = pairs.join(side, F.col("__key") == F.col("__dim_key"))
    return joined.groupBy(*dims).agg(*_aliased(measures))


def regrain(
    df: DataFrame, dims: Sequence[str], key: Sequence[str], inner: Measures, outer: Measures
) -> DataFrame:
    """``outer(group(inner) by key)`` grouped by ``dims``: one inner value per key first."""
    per_key = df.groupBy(*dims, *[k for k in key if k not in dims]).agg(*_aliased(inner))
    return per_key.groupBy(*dims).agg(*_aliased(outer))


def agg_of_agg(
    df: DataFrame, inner_by: Sequence[str], inner: Measures, outer_by: Sequence[str], outer: Measures
) -> DataFrame:
    """Aggregate to ``inner_by``, then the result to ``outer_by``."""
    return df.groupBy(*inner_by).agg(*_aliased(inner)).groupBy(*outer_by).agg(*_aliased(outer))


def pct_of_total(df: DataFrame, dims: Sequence[str], name: str, measure: Column, out: str) -> DataFrame:
    """An additive measure per group and its share of the grand total."""
    groups = df.groupBy(*dims).agg(measure.alias(name))
    shared = with_total(groups, {"__all": F.sum(name)})
    return shared.withColumn(out, ratio(F.col(name), F.col("__all"))).drop("__all")


def pct_of_parent(
    df: DataFrame, child: Sequence[str], parent: Sequence[str], measures: Mapping[str, tuple[Column, str]]
) -> DataFrame:
    """Additive measures per (parent, child) and their share of the parent's total.

    ``measures`` maps the measure name to ``(aggregate, share name)``.
    """
    dims = [*parent, *[c for c in child if c not in parent]]
    groups = df.groupBy(*dims).agg(*[m.alias(n) for n, (m, _) in measures.items()])
    shared = agg_by(groups, {f"__all_{n}": F.sum(n) for n in measures}, list(parent))
    for name, (_, out) in measures.items():
        shared = shared.withColumn(out, ratio(F.col(name), F.col(f"__all_{name}")))
    return shared.drop(*[f"__all_{n}" for n in measures])


def share_within(
    df: DataFrame, dims: Sequence[str], within: Sequence[str], name: str, measure: Column, out: str
) -> DataFrame:
    """A subgroup's share of its period (or other enclosing group)."""
    return pct_of_parent(df, dims, within, {name: (measure, out)})


def collect_label(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    out: str,
    limit: int | None = None,
    separator: str = ", ",
    many: str = "Many ({n})",
) -> DataFrame:
    """Distinct values of each group as sorted, delimited text.

    With ``limit``, a group with more values shows ``many`` with its count; then
    at most ``limit`` values per group are ever brought together (the ranking
    filter is applied before and after the shuffle).  Without it the cell holds
    all values, as asked.
    """
    pairs = df.filter(F.col(value).isNotNull()).select(*by, value).distinct()
    listed = pairs
    if limit is not None:
        order = Window.partitionBy(*by).orderBy(value)
        listed = pairs.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= limit)
    text = F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), separator)
    labels = listed.groupBy(*by).agg(text.alias(out))
    if limit is None:
        return labels
    before, after = many.split("{n}")
    sizes = pairs.groupBy(*by).agg(count_rows().alias("__size"))
    both = align([labels, sizes], list(by))
    over = F.concat(F.lit(before), F.col("__size").cast("string"), F.lit(after))
    return both.withColumn(out, F.when(F.col("__size") > limit, over).otherwise(F.col(out))).drop("__size")


def nest(
    df: DataFrame,
    outer: Sequence[str],
    inner: Sequence[str],
    measures: Measures,
    out: str,
    order: Sequence[str],
    having: Column | None = None,
) -> DataFrame:
    """Sub-aggregates of each outer group as a list of structs, high to low by ``order``.

    The list has one element per inner value, not per row, and whole: this form
    is for inner values that are few by nature.  For groups of any size take
    :func:`nest_flat`, which keeps one row per element.
    """
    flat = df.groupBy(*outer, *inner).agg(*_aliased(measures))
    if having is not None:
        flat = flat.filter(having)
    fields = [*order, *[c for c in [*inner, *measures] if c not in order]]
    items = flat.select(*outer, F.struct(*fields).alias("__item"))
    return items.groupBy(*outer).agg(F.sort_array(F.collect_list("__item"), asc=False).alias(out))


def nest_flat(
    df: DataFrame,
    outer: Sequence[str],
    inner: Sequence[str],
    measures: Measures,
    having: Column | None = None,
) -> DataFrame:
    """What :func:`nest` lists, as one row per outer group and inner value, for groups of any size."""
    flat = df.groupBy(*outer, *inner).agg(*_aliased(measures))
    return flat if having is None else flat.filter(having)


def symmetric_measures(names: Sequence[str], sides: Sequence[str], agg=F.sum) -> dict[str, Column]:
    """For each name one measure per side (``side_name``) and their total."""
    out: dict[str, Column] = {}
    for name in names:
        for side in sides:
            out[f"{side}_{name}_sum"] = agg(F.col(f"{side}_{name}"))
        both = F.lit(0)
        for side in sides:
            both = both + F.coalesce(F.col(f"{side}_{name}"), F.lit(0))
        out[f"total_{name}_sum"] = agg(both)
    return out


# How a stored measure is combined when its rollup is read at a coarser grain.
_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def additive(kind: str, name: str) -> Column:
    """Aggregate that combines stored partial results of ``kind``."""
    if kind not in _COMBINE:
        raise ValueError(f"{kind!r} cannot be re-aggregated from a rollup; store its parts instead")
    return _COMBINE[kind](name)

"""Checks of bindings, grain, nulls, references and domains.

Each returns a DataFrame and works on counts per key, so a hot key is one row
after the map-side combine.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from grainframe.catalog import Catalog, Dataset
from grainframe.quality.passes import DIM, Breach, KeyUse, counts_by_tag, edge_uses, tagged_keys, types_of


def check_schema(dataset: Dataset) -> DataFrame:
    """Declared against actual type of every bound column, and how many values fit."""
    actual = {f.name: f.dataType.simpleString() for f in dataset.df.schema.fields}
    items = []
    for column, declared in dataset.types.items():
        present = column in actual
        fits = F.count(F.col(column).try_cast(declared)) if present else F.lit(0).cast("long")
        values = F.count(column) if present else F.lit(0).cast("long")
        items.append(
            F.struct(
                F.lit(column).alias("column"),
                F.lit(declared).alias("declared"),
                F.lit(actual.get(column)).cast("string").alias("actual"),
                F.lit(actual.get(column) == declared).alias("same_type"),
                F.count(F.lit(1)).alias("rows"),
                values.alias("not_null"),
                fits.alias("fitting"),
            )
        )
    return dataset.df.agg(F.array(*items).alias("report")).select(F.inline("report"))


def check_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and row count per column, one pass."""
    items = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            F.count(F.lit(1)).alias("rows"),
        )
        for c in columns
    ]
    return df.agg(F.array(*items).alias("report")).select(F.inline("report"))


def check_fk(fact: DataFrame, dim: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Coverage of a reference in both directions and the modifier it calls for.

    Both sides are reduced to distinct keys first.  ``modifier`` is ``?`` if
    references may be null or dangling, ``~`` if some dimension keys are unused.
    """
    keys = [f"__k{i}" for i in range(len(on))]
    refs = fact.groupBy(*[F.col(f).alias(k) for f, k in zip(on, keys)]).agg(
        F.count(F.lit(1)).alias("__facts")
    )
    members = dim.groupBy(*[F.col(d).alias(k) for d, k in zip(on.values(), keys)]).agg(
        F.count(F.lit(1)).alias("__dims")
    )
    both = refs.unionByName(members, allowMissingColumns=True)
    both = both.groupBy(*keys).agg(F.sum("__facts").alias("__facts"), F.sum("__dims").alias("__dims"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    facts, dims = F.coalesce("__facts", F.lit(0)), F.col("__dims")

    def total(value, condition):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    report = both.agg(
        total(facts, F.lit(True)).alias("fact_rows"),
        total(facts, ~known).alias("null_rows"),
        total(facts, known & dims.isNull()).alias("dangling_rows"),
        total(F.lit(1), known & dims.isNotNull()).alias("dim_keys"),
        total(F.lit(1), known & dims.isNotNull() & (facts == 0)).alias("unused_keys"),
    )
    return report.withColumn("modifier", _modifier())


def check_domain(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the declared domain, with their row counts; nulls pass."""
    outside = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def _fused(tables: Mapping[str, DataFrame], uses: Sequence[tuple[str, KeyUse]], breaches=()) -> DataFrame:
    """Counts per tag, each table scanned once."""
    passes = []
    for name, df in tables.items():
        own, broken = [u for n, u in uses if n == name], [b for n, b in breaches if n == name]
        if own or broken:
            passes.append(tagged_keys(df, own, broken))
    return counts_by_tag(passes)


def _modifier() -> Column:
    """``~`` and ``?`` as the counts call for."""
    loose = (F.col("null_rows") > 0) | (F.col("dangling_rows") > 0)
    return F.concat(
        F.when(F.col("unused_keys") > 0, F.lit("~")).otherwise(F.lit("")),
        F.when(loose, F.lit("?")).otherwise(F.lit("")),
    )


def check_edges(catalog: Catalog) -> DataFrame:
    """Types on both ends of every edge, its coverage and whether its flags suffice.

    Every table is scanned once for all edges it takes part in.
    """
    tables = {name: d.df for name, d in catalog.datasets.items()}
    uses, facts = [], []
    for tag, edge in enumerate(catalog.edges):
        uses += edge_uses(tag, edge.source, edge.target, edge.on, tables)
        left = [k.simpleString() for k in types_of(tables[edge.source], edge.on)]
        right = [k.simpleString() for k in types_of(tables[edge.target], list(edge.on.values()))]
        declared = ("~" if edge.partial else "") + ("?" if edge.nullable else "")
        facts.append((tag, f"{edge.source}.{edge.name}", ",".join(left), ",".join(right), left == right, declared))
    if not facts:
        raise ValueError("the catalog has no edges")
    spark = tables[catalog.edges[0].source].sparkSession
    declared = spark.createDataFrame(
        facts, "tag int, edge string, source_type string, target_type string, same_type boolean, declared string"
    )
    needed = F.col("needed")
    sufficient = reduce(
        lambda x, y: x & y, [~needed.contains(m) | F.col("declared").contains(m) for m in "~?"]
    )
    return declared.join(_fused(tables, uses), "tag", "left").select(
        "edge", "source_type", "target_type", "same_type", "declared",
        F.coalesce(_modifier(), F.lit("")).alias("needed"),
    ).withColumn("sufficient", sufficient)


def validate_catalog(catalog: Catalog) -> DataFrame:
    """Everything a catalog declares against its data: one row per broken promise.

    Rows ``(dataset, check, subject, violations)`` for values that do not fit
    their type, repeated grain or alternate keys, nulls in columns not declared
    nullable, values outside a domain, and references that need a flag the edge
    does not have (counting rows for ``?`` and unused keys for ``~``).  Every table is
    scanned once for all of these.
    """
    tables = {name: d.df for name, d in catalog.datasets.items()}
    uses, breaches, promises = [], [], []

    def promise(dataset: str, check: str, subject: str, count: str, tag: int | None = None) -> int:
        tag = len(promises) if tag is None else tag
        promises.append((tag, dataset, check, subject, count))
        return tag

    for name, dataset in catalog.datasets.items():
        actual = {f.name: f.dataType.simpleString() for f in dataset.df.schema.fields}
        for column, kind in dataset.types.items():
            present = column in actual
            if present and actual[column] != kind:
                misfit = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
                breaches.append((name, Breach(promise(name, "type", column, "fact_rows"), misfit)))
            if column not in dataset.nullable:
                missing = F.col(column).isNull() if present else F.lit(True)
                breaches.append((name, Breach(promise(name, "not null", column, "fact_rows"), missing)))
        for check, keys in [("grain", dataset.grain), *[("alternate key", (k,)) for k in dataset.alternate_keys]]:
            tag = promise(name, check, ",".join(keys), "repeated")
            uses.append((name, KeyUse(tag, DIM, tuple(keys), types_of(dataset.df, keys))))
        for column, values in dataset.domains.items():
            outside = F.col(column).isNotNull() & ~F.col(column).isin(*values)
            breaches.append((name, Breach(promise(name, "domain", column, "fact_rows"), outside)))
    for edge in catalog.edges:
        if edge.nullable and edge.partial:
            continue
        tag = len(promises)
        if not edge.nullable:
            promise(edge.source, "reference", edge.name, "loose_rows", tag)
        if not edge.partial:
            promise(edge.source, "coverage", edge.name, "unused_keys", tag)
        uses += edge_uses(tag, edge.source, edge.target, edge.on, tables)
    spark = next(iter(tables.values())).sparkSession
    declared = spark.createDataFrame(promises, "tag int, dataset string, check string, subject string, count string")
    found = _fused(tables, uses, breaches).withColumn("loose_rows", F.col("null_rows") + F.col("dangling_rows"))
    kinds = ("fact_rows", "repeated", "loose_rows", "unused_keys")
    violations = reduce(lambda rest, k: F.when(F.col("count") == k, F.col(k)).otherwise(rest), kinds, F.lit(0).cast("long"))
    return (
        declared.join(found, "tag")
        .select("dataset", "check", "subject", violations.alias("violations"))
        .filter("violations > 0")
    )


#: Registers of a distinct sketch (a power of two) and how many standard errors count as certain.
SKETCH_BITS, SURE = 12, 10


def _distinct_counts(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> list[int]:
    """Distinct combinations without nulls of each column set, in one pass over ``df``."""
    uses = [KeyUse(i, DIM, names, types_of(df, names)) for i, names in enumerate(sets)]
    counts = counts_by_tag([tagged_keys(df, uses)]).select("tag", "dim_keys")
    found = {r["tag"]: r["dim_keys"] for r in counts.collect()}
    return [found.get(i, 0) for i in range(len(sets))]


def _sketched(df: DataFrame, sets: Sequence[tuple[str, ...]], *more: Column) -> Row:
    """Estimated distinct combinations ``e0, e1, ...`` of the sets, with ``more`` aggregates.

    Sketches are merged across tasks; a row leaves one hash a set and is not copied.
    """
    sketches = [
        F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(*names), SKETCH_BITS)).alias(f"e{i}")
        for i, names in enumerate(sets)
    ]
    return df.agg(*sketches, *more).first()


def _column_facts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int], dict[str, int]]:
    """Row count, nulls and estimated distinct values of each column, in one pass."""
    counts = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    found = _sketched(df, [(c,) for c in columns], F.count(F.lit(1)).alias("rows"), *counts)
    nulls = {c: found.rows - found[f"n{i}"] for i, c in enumerate(columns)}
    return found.rows, nulls, {c: found[f"e{i}"] or 0 for i, c in enumerate(columns)}


def _exact_keys(df: DataFrame, sets: Sequence[tuple[str, ...]], rows: int, per_pass: int) -> list[tuple[str, ...]]:
    """Those sets that have as many combinations as the table has rows."""
    found = []
    for low in range(0, len(sets), per_pass):
        block = sets[low : low + per_pass]
        found += [names for names, n in zip(block, _distinct_counts(df, block)) if n == rows]
    return found


def _enough(estimate: float, rows: int) -> bool:
    """Whether an estimate leaves room for ``rows`` distinct combinations."""
    return estimate * (1 + SURE * 1.04 / 2 ** (SKETCH_BITS / 2)) >= rows


def candidate_keys(
    df: DataFrame, columns: Sequence[str], max_columns: int = 2, sets_per_pass: int = 100
) -> DataFrame:
    """Smallest column sets that identify a row: ``(key_columns, rows)``.

    Distinct combinations are first estimated by sketches, up to ``sets_per_pass`` sets
    in one pass.  Counted exactly are the sets within ten standard errors of the row
    count.  Left out are only those that cannot be an answer: sets with a column that
    holds nulls, sets that contain a key, and sets with too few combinations.  In a
    table without rows every single column is a key.
    """
    spark = df.sparkSession
    rows, nulls, single = _column_facts(df, columns)
    found, full = [], [c for c in columns if not nulls[c]]
    for size in range(1, max_columns + 1):
        likely = [
            names
            for names in combinations(full, size)
            if not any(set(key) <= set(names) for key in found)
            and _enough(prod(single[c] * (1 + SURE * 1.04 / 2 ** (SKETCH_BITS / 2)) for c in names), rows)
        ]
        if size > 1:
            blocks = [likely[low : low + sets_per_pass] for low in range(0, len(likely), sets_per_pass)]
            guessed = {names: e for block in blocks for names, e in zip(block, _sketched(df, block))}
            likely = [names for names in likely if _enough(guessed[names] or 0, rows)]
        found += _exact_keys(df, likely, rows, sets_per_pass)
    report = [(",".join(names), rows) for names in found]
    return spark.createDataFrame(report, "key_columns string, rows long")


def suggest_binding(df: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per column: null count, whether it is a key, and the modifier it needs.

    ``references`` maps a column to ``(dimension, key)`` where it points to one.  The
    table is scanned once for nulls and sketches and once for all exact counts, of
    likely keys and of references together; each dimension is scanned once.
    """
    rows, nulls, single = _column_facts(df, df.columns)
    likely = [c for c in df.columns if not nulls[c] and _enough(single[c], rows)]
    uses = [KeyUse(i, DIM, (c,), types_of(df, (c,))) for i, c in enumerate(df.columns) if c in likely]
    passes, marked = [], {}
    for tag, (column, (dim, key)) in enumerate(references.items(), start=len(df.columns)):
        tables = {"fact": df, "dim": dim}
        (_, use), (_, end) = edge_uses(tag, "fact", "dim", {column: key}, tables)
        uses.append(use)
        passes.append(tagged_keys(dim, [end]))
        marked[tag] = column
    found = {}
    if uses:
        counted = counts_by_tag([tagged_keys(df, uses), *passes]).withColumn("modifier", _modifier())
        found = {r.tag: r for r in counted.collect()}
    marks = {column: found[tag].modifier if tag in found else "" for tag, column in marked.items()}
    report = [
        (
            c,
            nulls[c],
            rows,
            c in likely and (found[i].dim_keys if i in found else 0) == rows,
            marks.get(c, "?" if nulls[c] else ""),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.sparkSession.createDataFrame(
        report, "column string, nulls long, rows long, is_key boolean, modifier string"
    )


def run_pack(
    spark: SparkSession, pack: Mapping[str, Callable[[SparkSession, str], DataFrame]], folder: str
) -> DataFrame:
    """Run every query of a pack and report rows or the error, without stopping at one."""
    report = []
    for name, query in pack.items():
        try:
            df = query(spark, folder)
            seen = Observation(f"pack-{name}")
            counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            counted.write.format("noop").mode("overwrite").save()  # every column is computed
            report.append((name, True, seen.get["rows"], len(df.columns), None))
        except Exception as error:  # the report is the point: every failure is listed
            text = str(error).strip().splitlines()
            report.append((name, False, None, None, text[0] if text else type(error).__name__))
    return spark.createDataFrame(
        report, "query string, passed boolean, rows long, columns int, error string"
    )

"""Declared tables and references, and queries that join only what they use.

A ``Dataset`` names the columns of a table and those that identify a row.  An
``Edge`` says how one dataset points to another and in which role.  A column is
named by its path of roles from the root fact: ``supplier.nation.name``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainframe.functions.conditions import ratio
from grainframe.functions.traits import combined_unit
from grainframe.operators.joins import align
from grainframe.operators.ordering import Order, sort_columns


@dataclass(frozen=True)
class Dataset:
    """A table under logical column names.

    ``types`` holds declared types, ``nullable`` the columns that may be null,
    ``alternate_keys`` other unique columns, ``domains`` the allowed values,
    ``traits`` units.  ``root`` is false for rollups.
    """

    name: str
    df: DataFrame
    grain: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)
    nullable: frozenset[str] = frozenset()
    alternate_keys: tuple[str, ...] = ()
    domains: Mapping[str, tuple] = field(default_factory=dict)
    traits: Mapping[str, str] = field(default_factory=dict)
    root: bool = True


@dataclass(frozen=True)
class Edge:
    """``source`` points to ``target`` through ``on`` (source column to target column).

    ``partial``: the source need not hold every target key.  ``nullable``: the
    reference may be null or dangling.
    """

    source: str
    target: str
    on: Mapping[str, str]
    role: str | None = None
    partial: bool = False
    nullable: bool = False

    @property
    def name(self) -> str:
        return self.role or self.target


@dataclass(frozen=True)
class Measure:
    """An aggregate over columns given by path.

    ``build`` gets one ``Column`` per path.  All paths must lie on one dataset,
    whose grain is the native grain of the measure: attributes of a dimension
    are taken once per dimension key within each group of the result.
    ``empty`` is the value for groups without facts.  ``unit`` names the rule by which
    the units of the columns combine (see ``functions.combined_unit``); without one the
    result has no unit.
    """

    paths: tuple[str, ...]
    build: Callable[..., Column]
    empty: int | None = None
    unit: str | None = None

    @staticmethod
    def sum(path: str) -> "Measure":
        return Measure((path,), F.sum, unit="sum")

    @staticmethod
    def avg(path: str) -> "Measure":
        return Measure((path,), F.avg, unit="sum")

    @staticmethod
    def min(path: str) -> "Measure":
        return Measure((path,), F.min, unit="sum")

    @staticmethod
    def max(path: str) -> "Measure":
        return Measure((path,), F.max, unit="sum")

    @staticmethod
    def count_keys(path: str) -> "Measure":
        return Measure((path,), F.count_distinct, empty=0, unit="count")

    @staticmethod
    def ratio(over: str, under: str) -> "Measure":
        """Sum over sum; null where the lower sum is zero."""
        return Measure((over, under), lambda a, b: ratio(F.sum(a), F.sum(b)), unit="ratio")

    @staticmethod
    def product(left: str, right: str) -> "Measure":
        """Sum of products."""
        return Measure((left, right), lambda a, b: F.sum(a * b), unit="product")


Filter = tuple[str | Sequence[str], Callable[..., Column]]


class Catalog:
    """Datasets by name and the edges between them."""

    def __init__(self) -> None:
        self.datasets: dict[str, Dataset] = {}
        self.edges: list[Edge] = []

    def register(self, dataset: Dataset, view: bool = False) -> "Catalog":
        self.datasets[dataset.name] = dataset
        if view:
            dataset.df.createOrReplaceTempView(dataset.name)
        return self

    def link(self, edge: Edge) -> "Catalog":
        for name in (edge.source, edge.target):
            if name not in self.datasets:
                raise KeyError(f"unknown dataset {name!r}")
        self.edges.append(edge)
        return self

    def _routes(self, root: str) -> dict[tuple[str, ...], tuple[Edge, ...]]:
        """Every path of roles from ``root``, with the edges it takes."""
        routes: dict[tuple[str, ...], tuple[Edge, ...]] = {(): ()}
        todo = [((), (), root, frozenset({root}))]
        while todo:
            path, edges, at, seen = todo.pop()
            for edge in self.edges:
                if edge.source == at and edge.target not in seen:
                    step = (*path, edge.name)
                    routes[step] = (*edges, edge)
                    todo.append((step, routes[step], edge.target, seen | {edge.target}))
        return routes

    def resolve(self, root: str, path: str) -> tuple[tuple[str, ...], str]:
        """Roles and column of ``path``; a shortened path must have one reading only."""
        *roles, column = path.split(".")
        roles = tuple(roles)
        found = []
        for route, edges in self._routes(root).items():
            target = edges[-1].target if edges else root
            if column not in self.datasets[target].df.columns:
                continue
            if route == roles:
                return route, column
            if roles and (route[-len(roles):] == roles):
                found.append(route)
        if len(found) > 1:
            ways = ", ".join(".".join(f) for f in sorted(found))
            raise ValueError(f"{path!r} is ambiguous from {root!r}: {ways}")
        if not found:
            raise KeyError(f"no column {path!r} from {root!r}")
        return found[0], column

    def wide(
        self, root: str, needed: Sequence[tuple[tuple[str, ...], str]], distinct: bool = False
    ) -> DataFrame:
        """The root joined to exactly the datasets ``needed`` columns come from.

        Columns are named by their full path (dots included).  With
        ``distinct`` the root is reduced to distinct rows before any join.

        Joins follow the declared edges outwards from the root, the same for
        every size of table; which side is broadcast is left to Catalyst and
        adaptive execution.
        """
        routes = self._routes(root)
        columns: dict[tuple[str, ...], set[str]] = {(): set()}
        for route, column in needed:
            for i in range(1, len(route) + 1):
                edge = routes[route[:i]][-1]
                columns.setdefault(route[: i - 1], set()).update(edge.on)
                columns.setdefault(route[:i], set()).update(edge.on.values())
            columns[route].add(column)

        def table(route: tuple[str, ...]) -> DataFrame:
            target = routes[route][-1].target if route else root
            side = self.datasets[target].df.select(
                *[F.col(c).alias(".".join((*route, c))) for c in sorted(columns[route])]
            )
            return side.distinct() if distinct and not route else side

        def children(route: tuple[str, ...]) -> list[tuple[str, ...]]:
            return sorted(r for r in columns if len(r) == len(route) + 1 and r[:-1] == route)

        def attach(frame: DataFrame, route: tuple[str, ...], side: DataFrame) -> DataFrame:
            edge = routes[route][-1]
            pairs = [
                named((*route[:-1], s)) == named((*route, t)) for s, t in edge.on.items()
            ]
            condition = reduce(lambda a, b: a & b, pairs)
            return frame.join(side, condition, "left" if edge.nullable else "inner")

        def extend(frame: DataFrame, route: tuple[str, ...]) -> DataFrame:
            for child in children(route):
                frame = extend(attach(frame, child, table(child)), child)
            return frame

        return extend(table(()), ())


def named(path: Sequence[str]) -> Column:
    """Column of a wide frame by its path."""
    return F.col("`" + ".".join(path) + "`")


def star_select(
    catalog: Catalog,
    root: str,
    dims: Mapping[str, str],
    measures: Mapping[str, Measure],
    where: Sequence[Filter] = (),
    having: Column | None = None,
    order: Order = (),
    limit: int | None = None,
) -> DataFrame:
    """Group facts of ``root`` by attributes found along declared edges.

    Only datasets whose columns are used are joined.  Measures are grouped by
    native grain: one pass over facts for fact measures, one over distinct
    (group, dimension key) pairs for each dimension measured; the passes are
    aligned on the output columns.

    ``where`` holds ``(path or paths, condition)`` and filters inputs of every
    measure.  When all output columns hang on a chain with partial edges, members
    without facts stay, with ``empty`` values: those behind the last partial edge
    that every filter is behind too, so no hop of the chain loses any.
    """

    def find(path: str) -> tuple[tuple[str, ...], str]:
        return catalog.resolve(root, path)

    def test(item: Filter) -> tuple[list, Callable[..., Column]]:
        paths, condition = item
        return [find(p) for p in ([paths] if isinstance(paths, str) else paths)], condition

    groups = {out: find(path) for out, path in dims.items()}
    filters = [test(item) for item in where]
    sources: dict[tuple[str, ...], dict[str, tuple[Measure, list]]] = {}
    for out, measure in measures.items():
        places = [find(p) for p in measure.paths]
        routes = {route for route, _ in places}
        if len(routes) != 1:
            raise ValueError(f"measure {out!r} mixes datasets {sorted(routes)}")
        sources.setdefault(routes.pop(), {})[out] = (measure, places)

    def filtered(needed: list, tests: list, distinct: bool) -> DataFrame:
        frame = catalog.wide(root, [*needed, *[c for cs, _ in tests for c in cs]], distinct)
        for places, condition in tests:
            frame = frame.filter(condition(*[named((*r, c)) for r, c in places]))
        return frame

    group_columns = [named((*r, c)).alias(out) for out, (r, c) in groups.items()]
    frames = []
    for route, wanted in sources.items():
        columns = [place for _, places in wanted.values() for place in places]
        if route:
            edges = catalog._routes(root)[route]
            keys = [(route, k) for k in catalog.datasets[edges[-1].target].grain]
            columns = [*keys, *columns]
        columns = list(dict.fromkeys(columns))
        frame = filtered([*groups.values(), *columns], filters, distinct=bool(route))
        values = {place: f"__v{i}" for i, place in enumerate(columns)}
        frame = frame.select(
            *group_columns, *[named((*r, c)).alias(values[(r, c)]) for r, c in columns]
        )
        if route:
            frame = frame.distinct()
        aggregates = [
            measure.build(*[F.col(values[p]) for p in places]).alias(out)
            for out, (measure, places) in wanted.items()
        ]
        frames.append(frame.groupBy(*groups).agg(*aggregates))

    frames += [_members(catalog, root, at, groups, filters) for at in _kept(catalog, root, groups, filters)]
    out = align(frames, list(groups)) if groups and len(frames) > 1 else frames[0]
    if not groups and len(frames) > 1:
        out = align([f.withColumn("__one", F.lit(1)) for f in frames], ["__one"]).drop("__one")
    zeros = {n: m.empty for n, m in measures.items() if m.empty is not None}
    out = out.fillna(zeros) if zeros else out
    out = out.select(*_with_units(catalog, root, groups, sources))
    out = out.select(*groups, *measures)
    if having is not None:
        out = out.filter(having)
    if order:
        out = out.orderBy(*sort_columns(order))
    return out.limit(limit) if limit is not None else out


def _with_units(catalog: Catalog, root: str, groups: Mapping, sources: Mapping) -> list[Column]:
    """Output columns with their unit as a trait: that of the column, or what its measure's rule gives."""
    routes = catalog._routes(root)

    def unit_of(place: tuple[tuple[str, ...], str]) -> str | None:
        route, column = place
        return catalog.datasets[routes[route][-1].target if route else root].traits.get(column)

    units = {out: unit_of(place) for out, place in groups.items()}
    for wanted in sources.values():
        for out, (measure, places) in wanted.items():
            units[out] = combined_unit(measure.unit, *map(unit_of, places)) if measure.unit else None
    return [F.col(out).alias(out, metadata={"trait": unit}) if unit else F.col(out) for out, unit in units.items()]


def _kept(catalog: Catalog, root: str, groups: Mapping, filters: Sequence) -> list[tuple[str, ...]]:
    """Routes of the datasets whose members stay without facts.

    The last partial edge that all output columns and filters are behind: its
    dataset holds whatever earlier ones lead to, except the rows of an earlier
    one that lead nowhere over a nullable edge.
    """
    routes = [route for route, _ in groups.values()]
    routes += [route for places, _ in filters for route, _ in places]
    if not groups:
        return []
    chain = tuple(steps[0] for steps in takewhile(lambda s: len(set(s)) == 1, zip(*routes)))
    if not chain:
        return []
    edges = catalog._routes(root)[chain]
    partial = [i for i, edge in enumerate(edges) if edge.partial]
    loose = [i for i in partial[:-1] if any(edge.nullable for edge in edges[i + 1 : partial[-1] + 1])]
    return [chain[: i + 1] for i in [*loose, *partial[-1:]]]


def _members(
    catalog: Catalog, root: str, at: tuple[str, ...], groups: Mapping, filters: Sequence
) -> DataFrame:
    """Distinct output columns of the dimension at ``at``, facts or not."""
    skip = len(at)
    inner_groups = {out: (route[skip:], column) for out, (route, column) in groups.items()}
    tests = [([(r[skip:], c) for r, c in places], condition) for places, condition in filters]
    needed = [*inner_groups.values(), *[p for places, _ in tests for p in places]]
    frame = catalog.wide(catalog._routes(root)[at][-1].target, needed)
    for places, condition in tests:
        frame = frame.filter(condition(*[named((*r, c)) for r, c in places]))
    return frame.select(
        *[named((*r, c)).alias(out) for out, (r, c) in inner_groups.items()]
    ).distinct()

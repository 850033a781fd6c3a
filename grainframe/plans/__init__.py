"""Query packs over the test tables, with equivalent SQL for checking."""

from grainframe.plans import (  # noqa: F401  (importing a pack registers its queries)
    aggregates,
    dashboard,
    examples,
    joins,
    prep,
    projection,
    quality,
    scalars,
    sources,
    windows,
)
from grainframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

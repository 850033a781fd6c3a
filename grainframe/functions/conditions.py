"""Conditional values, bands and ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def only_if(value: Column, condition: Column) -> Column:
    """``value`` where ``condition`` is true, else null (so aggregates skip it)."""
    return F.when(condition, value)


def band(value: Column, bands: Sequence[tuple[Any, Any, str]], default: str | None = None) -> Column:
    """Label of the first band ``(low, high, label)`` holding ``value``.

    Bounds are inclusive; ``None`` leaves a side open.
    """
    out = None
    for low, high, label in bands:
        test = F.lit(True)
        if low is not None:
            test = value >= F.lit(low)
        if high is not None:
            upper = value <= F.lit(high)
            test = upper if low is None else test & upper
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


# Age bands, and generations by first and last birth year.
AGE_BANDS = (
    (None, 12, "child"),
    (13, 19, "teenager"),
    (20, 35, "young adult"),
    (36, 59, "adult"),
    (60, None, "elderly"),
)
GENERATIONS = (
    (1883, 1900, "Lost Generation"),
    (1901, 1927, "G.I. Generation"),
    (1928, 1945, "Silent Generation"),
    (1946, 1964, "Baby Boomers"),
    (1965, 1980, "Generation X"),
    (1981, 1996, "Millenials"),
    (1997, 2012, "Generation Z"),
)


def age_bucket(age: Column) -> Column:
    return band(age, AGE_BANDS, "unknown")


def generation(birth_year: Column) -> Column:
    return band(birth_year, GENERATIONS, "Other")


def case_map(value: Column, labels: Mapping[Any, Any], default: Any = None) -> Column:
    """Simple CASE over a short list of values; see ``decode`` for long lists."""
    out = None
    for key, label in labels.items():
        test = value == F.lit(key)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null where ``whole`` is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def calc_percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded share of ``whole`` as a ratio (callers multiply by 100 to show it)."""
    return F.round(ratio(part, whole), digits)


def unless_sentinel(value: Column, *sentinels: str) -> Column:
    """Null where ``value`` is one of the text sentinels."""
    return F.when(~value.isin(*sentinels), value)

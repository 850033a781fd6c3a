"""Unit and meaning tags carried in column metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

# The traits the models use.
TRAITS = {
    "usd", "percent", "year", "month", "day", "latitude", "longitude", "country", "city",
    "us_state_short", "hex", "url_image", "kn", "kg", "m", "tonne", "second", "seconds",
    "flag", "grade",
}


def register_trait(name: str) -> str:
    """Add a trait of your own, such as ``letter_grade``."""
    TRAITS.add(name)
    return name


def tag(column: Column, name: str, trait: str) -> Column:
    """``column`` under ``name`` with its trait in the metadata."""
    if trait not in TRAITS:
        raise ValueError(f"unknown trait {trait!r}")
    return column.alias(name, metadata={"trait": trait})


def traits(df: DataFrame) -> dict[str, str]:
    """Column name to trait, for columns that carry one."""
    return {f.name: f.metadata["trait"] for f in df.schema.fields if "trait" in f.metadata}


def combined_unit(rule: str, *units: str | None) -> str | None:
    """Unit of what comes out of values with ``units``; None is a value without a unit.

    ``sum`` stands for sums, means and extremes: the units must agree and stay.
    ``count`` gives ``count``.  ``ratio`` divides the first unit by the second, agreeing
    ones cancel.  ``product`` multiplies them; a percentage or a number leaves the other.
    """
    if rule == "count":
        return "count"
    if rule == "sum":
        if len(set(units)) > 1:
            named = ", ".join(sorted(str(u) for u in set(units)))
            raise ValueError(f"values of different units cannot be added: {named}")
        return units[0] if units else None
    if rule == "ratio":
        over, under = units
        if over == under:
            return None
        return over if under is None else f"{over or 1}/{under}"
    if rule == "product":
        parts = sorted(u for u in units if u not in (None, "percent"))
        return "*".join(parts) or ("percent" if "percent" in units else None)
    raise ValueError(f"unknown rule {rule!r}")

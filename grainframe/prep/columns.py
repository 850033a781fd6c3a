"""Column names and nested schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def fix_headers(names: Sequence[str]) -> list[str]:
    """Trimmed names; blanks become ``column_<position>``, repeats get ``_2``, ``_3``, ...

    Numbers that would repeat another name, given or made, are passed over.
    """
    given = {name.strip() for name in names} - {""}
    fixed: list[str] = []
    for position, name in enumerate(names, start=1):
        base = name.strip() or f"column_{position}"
        taken = given.union(fixed) if not name.strip() else set(fixed)
        if base in taken:
            numbered = (f"{base}_{n}" for n in count(2))
            base = next(new for new in numbered if new not in given.union(fixed))
        fixed.append(base)
    return fixed


def snake_case(name: str) -> str:
    """``unitPriceUSD`` to ``unit_price_usd``."""
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+[a-z]*|[^A-Za-z\d]+", name)
    out = ""
    for word in words:
        glued = not out or out.endswith("_") or word[0] == "_" or word[0].isdigit()
        out += word.lower() if glued else "_" + word.lower()
    return out


def snake_columns(df: DataFrame) -> DataFrame:
    """All columns under snake-case names."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Fields of (nested) structs as columns named by their path."""

    def leaves(schema: StructType, path: tuple[str, ...], base: Column | None) -> list[Column]:
        out = []
        for item in schema.fields:
            here = F.col(f"`{item.name}`") if base is None else base.getField(item.name)
            name = (*path, item.name)
            if isinstance(item.dataType, StructType):
                out.extend(leaves(item.dataType, name, here))
            else:
                out.append(here.alias(separator.join(name)))
        return out

    return df.select(*leaves(df.schema, (), None))

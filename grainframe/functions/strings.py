"""Text helpers with one null rule: no match and out of range give null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def capital_first(value: Column) -> Column:
    """Upper-case the first letter, keep the rest."""
    return F.concat(F.upper(F.substring(value, 1, 1)), value.substr(F.lit(2), F.length(value)))


def split_part(value: Column, separator: str, position: int) -> Column:
    """Part number ``position`` (1-based, negative from the end), null if absent."""
    return F.try_element_at(F.split(value, re.escape(separator)), F.lit(position))


def regexp_group(value: Column, pattern: str, group: int = 1) -> Column:
    """Regular-expression group, null when the pattern does not match."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


# Patterns that results depend on.
URL_HOST = r"http(?:s)?://([^/]+)/"
ROOT_OF_HOST = r"([^\.]+\.[^\.]+(?:\.[a-zA-Z].)?)$"


def root_domain(url: Column) -> Column:
    """Root domain of a URL, such as ``example.com`` for ``https://m.example.com/x``."""
    return regexp_group(regexp_group(url, URL_HOST), ROOT_OF_HOST)


def strip_flag(value: Column, flag: str = "?", missing: str = "NA", blank: str = "-") -> Column:
    """Drop trailing uncertainty flags and turn the missing marker into the blank one."""
    bare = F.rtrim(value, F.lit(flag))
    return F.when(bare == F.lit(missing), F.lit(blank)).otherwise(bare)


def hash_color(value: Column, low: int = 48, span: int = 200, shift: int = 97) -> Column:
    """A stable ``#rrggbb`` colour for a label that has no assigned one."""
    code = F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")
    base = (F.pmod(code, F.lit(span)) + low).cast("int")
    other = (F.pmod(F.pmod(code, F.lit(span)) + shift, F.lit(span)) + low).cast("int")
    return F.format_string("#%02x%02x%02x", base, base, other)

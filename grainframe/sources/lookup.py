"""Code-to-label dimensions out of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_from_json(df: DataFrame, json: Column, code: str = "code", label: str = "label") -> DataFrame:
    """Distinct (code, label) pairs of a JSON object ``{code: label, ...}`` per row."""
    entries = F.from_json(json, "map<string,string>")
    return df.select(F.explode(entries).alias(code, label)).distinct()

"""Data preparation jobs."""

from grainframe.prep.columns import fix_headers, flatten, snake_columns
from grainframe.prep.files import check_delimited, read_commented_tsv
from grainframe.prep.text import (
    apply_fix,
    clean_strings,
    decode_text,
    minimise_text,
    normalise_flags,
    null_sentinels,
    strip_citations,
)

__all__ = [
    "apply_fix",
    "check_delimited",
    "clean_strings",
    "decode_text",
    "fix_headers",
    "flatten",
    "minimise_text",
    "normalise_flags",
    "null_sentinels",
    "read_commented_tsv",
    "snake_columns",
    "strip_citations",
]

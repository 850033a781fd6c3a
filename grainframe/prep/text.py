"""Cleaning of text columns with built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Control characters that are removed (tab and newline stay).
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"

# What is cut from encyclopedia summaries, in this order.  Patterns
# stay apart because a fixed beginning is found much faster than alternatives.
SYNONYMY = r"(?s)Species brought into synonymy.*"
SPECIES_SECTION = r"(?s)== Species ==.*?(?===|$)"
REFERENCES_SECTION = r"(?s)== References ==.*"
LINKS_SECTION = r"(?s)== External links ==.*"
CITATION = r"\([^)]*\d{4}[^)]*\)"
COMMA_YEAR = r",\s*\d{4}"
AUTHOR_YEAR = r"\b[A-Z][a-z]+\s*,\s*\d{4}"
ARTICLE_IN_PARENS = r"\(Art\.\s*\d*\)"
ARTICLE = r"Art\.\s*\d+"
# Sections that are kept and put at the end.
DISTRIBUTION_SECTION = r"(?s)== Distribution ==(.*?)(?===|$)"
TAXONOMY_SECTION = r"(?s)== Taxonomy ==(.*?)(?===|$)"
# Shorter summaries fall back to the first sentence, if that is longer.
SHORT = 20

_CUT_SECTIONS = (SYNONYMY, SPECIES_SECTION, REFERENCES_SECTION, LINKS_SECTION)
_CUT_CITATIONS = (CITATION, COMMA_YEAR, AUTHOR_YEAR, ARTICLE_IN_PARENS, ARTICLE)


def _text_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    if columns is not None:
        return list(columns)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def clean_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Remove control characters and turn all line ends into ``\\n`` in text columns."""
    return df.withColumns(
        {
            c: F.regexp_replace(F.regexp_replace(c, CONTROL_CHARACTERS, ""), r"\r\n?", "\n")
            for c in _text_columns(df, columns)
        }
    )


def decode_text(df: DataFrame, column: str, mode: str = "ignore") -> DataFrame:
    """Bytes to text: invalid UTF-8 is dropped, replaced by U+FFFD, or an error."""
    text = F.col(column).cast("string")
    if mode == "strict":
        value = F.validate_utf8(text)
    elif mode == "replace":
        value = F.make_valid_utf8(text)
    elif mode == "ignore":
        # U+FDD0 is never exchanged as text; it keeps genuine U+FFFD apart from replacements.
        kept = F.replace(text, F.lit("\ufffd"), F.lit("\ufdd0"))
        repaired = F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit(""))
        value = F.replace(repaired, F.lit("\ufdd0"), F.lit("\ufffd"))
    else:
        raise ValueError(f"mode must be ignore, replace or strict, not {mode!r}")
    return df.withColumn(column, value)


_DIGITS = r"\d+(_\d+)*"
_FINITE = rf"({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?"
#: Numbers with digit groups, ``nan`` and ``inf`` included.
NUMBER = rf"^\s*[+-]?({_FINITE}|(?i:inf(inity)?|nan))\s*$"


def null_sentinels(df: DataFrame, sentinel: str = "-", columns: Sequence[str] | None = None) -> DataFrame:
    """Null for the sentinel in text columns whose other values are all numbers.

    The verdict per column comes from one aggregate pass, used as a scalar
    subquery; columns with real text keep the sentinel.
    """
    names = _text_columns(df, columns)
    real = {c: F.when((F.col(c) != sentinel) & (F.col(c) != ""), F.col(c)) for c in names}
    verdicts = [
        F.coalesce(F.bool_and(real[c].rlike(NUMBER)), F.lit(False)).alias(c) for c in names
    ]
    numeric = df.agg(F.struct(*verdicts)).scalar()
    marked = df.withColumn("__numeric", numeric)
    fixed = {
        c: F.when(~(F.col("__numeric").getField(c) & (F.col(c) == sentinel)), F.col(c))
        for c in names
    }
    return marked.withColumns(fixed).drop("__numeric")


def apply_fix(df: DataFrame, condition: Column, column: str, value) -> DataFrame:
    """Set ``column`` to ``value`` where ``condition`` holds, such as to repair a key."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, new).otherwise(F.col(column)))


def normalise_flags(
    df: DataFrame,
    columns: Sequence[str],
    flag: str = "?",
    missing: str = "NA",
    blank: str = "-",
    overrides: Mapping[str, tuple[str, Mapping]] | None = None,
) -> DataFrame:
    """Strip uncertainty flags, map the missing marker, override known bad values.

    ``overrides`` maps a column to ``(column to match, {value: replacement})``.
    """
    from grainframe.functions import case_map, strip_flag

    fixed = {c: strip_flag(F.coalesce(F.col(c), F.lit(blank)), flag, missing, blank) for c in columns}
    for column, (match, values) in (overrides or {}).items():
        fixed[column] = case_map(F.col(match), values, F.col(column))
    return df.withColumns(fixed)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_citations(text: Column) -> Column:
    """Drop citations, years and article numbers; collapse blanks."""
    for pattern in _CUT_CITATIONS:
        text = F.regexp_replace(text, "(?U)" + pattern, "")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def minimise_text(df: DataFrame, column: str) -> DataFrame:
    """Cut encyclopedia texts to short summaries.

    Lists, references and links go, then citations.  If hardly anything is
    left, the first sentence stands in.  The distribution and taxonomy sections
    are appended.  Works in two steps, so each long chain of replacements is
    evaluated once per row.
    """
    text = F.col(column)
    short = text
    for pattern in _CUT_SECTIONS:
        short = F.regexp_replace(short, pattern, "")
    parts = {
        "__short": strip_citations(short),
        "__sentence": F.regexp_extract(text, r"^[^.!?]*", 0),
        "__distribution": _strip(F.regexp_extract(text, DISTRIBUTION_SECTION, 1)),
        "__taxonomy": _strip(F.regexp_extract(text, TAXONOMY_SECTION, 1)),
    }
    staged = df.withColumns(parts)
    meagre = (F.length("__short") < SHORT) & (F.length("__sentence") > SHORT)
    summary = F.concat_ws(
        " ",
        F.when(meagre, _strip(F.col("__sentence"))).otherwise(F.col("__short")),
        F.nullif("__distribution", F.lit("")),
        F.nullif("__taxonomy", F.lit("")),
    )
    return staged.withColumn(column, F.when(text != "", summary).otherwise(text)).drop(*parts)

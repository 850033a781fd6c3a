"""Data-quality jobs."""

from grainframe.quality.checks import (
    candidate_keys,
    check_domain,
    check_edges,
    check_fk,
    check_grain,
    check_not_null,
    check_schema,
    run_pack,
    suggest_binding,
    validate_catalog,
)

__all__ = [
    "candidate_keys",
    "check_domain",
    "check_edges",
    "check_fk",
    "check_grain",
    "check_not_null",
    "check_schema",
    "run_pack",
    "suggest_binding",
    "validate_catalog",
]

"""Column-level building blocks; all of them are built-in expressions."""

from wardbook.functions.columns import (
    any_present,
    backfill,
    clean_text,
    differs_any,
    is_kind,
    map_values,
    meets,
    month_of,
    percent_text,
    safe_ratio,
    same_all,
    sentinel_fill,
    since_month,
    since_year,
    surrogate_key,
    valid_key,
)

__all__ = [
    "any_present",
    "backfill",
    "clean_text",
    "differs_any",
    "is_kind",
    "map_values",
    "meets",
    "month_of",
    "percent_text",
    "safe_ratio",
    "same_all",
    "sentinel_fill",
    "since_month",
    "since_year",
    "surrogate_key",
    "valid_key",
]

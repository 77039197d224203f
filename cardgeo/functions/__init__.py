"""Column-level building blocks (built-in expressions only)."""

from .columns import (
    STRICT_BIN_PATTERN,
    STRICT_COUNTRY_PATTERN,
    bin_length_ok,
    country_present,
    in_month,
    in_month_dates,
    is_discrepant,
    month_index,
    month_key,
    month_key_text,
    month_of,
    not_fraud,
    row_hash,
    share,
    strict_bin_ok,
    strict_country_ok,
    wilson_bound,
    within_coverage,
)

__all__ = [
    "STRICT_BIN_PATTERN",
    "STRICT_COUNTRY_PATTERN",
    "bin_length_ok",
    "country_present",
    "in_month",
    "in_month_dates",
    "is_discrepant",
    "month_index",
    "month_key",
    "month_key_text",
    "month_of",
    "not_fraud",
    "row_hash",
    "share",
    "strict_bin_ok",
    "strict_country_ok",
    "wilson_bound",
    "within_coverage",
]

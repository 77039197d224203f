"""Run parameters and month handling.

Every threshold is an explicit argument (never a module global that callers
patch), so one session can run several parameter sets side by side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

# Fixed values that must equal the reference's defaults:
#   coverage target 0.95, minimum support 100 transactions,
#   valid BIN length 6 to 8 characters, month format YYYY-MM.
DEFAULT_COVERAGE = Decimal("0.95")
DEFAULT_MIN_TXNS = 100
BIN_MIN_LEN = 6
BIN_MAX_LEN = 8

_MONTH_RE = re.compile(r"^(\d{4})-(0[1-9]|1[0-2])$")


def validate_month(month: str) -> str:
    """Return ``month`` if it is ``YYYY-MM`` with a real month, else raise."""
    if not isinstance(month, str) or not _MONTH_RE.match(month):
        raise ValueError(f"Invalid month {month!r}; expected YYYY-MM with month 01..12")
    return month


def month_bounds(month: str) -> tuple[str, str]:
    """Half-open ``[first instant, first instant of next month)`` as literals."""
    m = _MONTH_RE.match(validate_month(month))
    year, mon = int(m.group(1)), int(m.group(2))
    nyear, nmon = (year + 1, 1) if mon == 12 else (year, mon + 1)
    return f"{year:04d}-{mon:02d}-01 00:00:00", f"{nyear:04d}-{nmon:02d}-01 00:00:00"


def as_decimal(value) -> Decimal:
    """Exact decimal for a coverage share given as str, float or Decimal."""
    return value if isinstance(value, Decimal) else Decimal(str(value))


@dataclass(frozen=True)
class Params:
    """Thresholds of one run.

    ``coverage`` is kept as a ``Decimal`` so the coverage cut is exact
    (no summed doubles); ``min_txns`` is the minimum number of kept
    transactions per BIN.
    """

    coverage: Decimal = DEFAULT_COVERAGE
    min_txns: int = DEFAULT_MIN_TXNS

    def __post_init__(self):
        cov = as_decimal(self.coverage)
        if not (Decimal(0) < cov <= Decimal(1)):
            raise ValueError(f"coverage must be in (0, 1], got {self.coverage}")
        if int(self.min_txns) < 0:
            raise ValueError(f"min_txns must be >= 0, got {self.min_txns}")
        object.__setattr__(self, "coverage", cov)
        object.__setattr__(self, "min_txns", int(self.min_txns))


def month_intervals(months) -> list[tuple[str, str]]:
    """Months merged into maximal contiguous half-open ranges
    ``[first instant, end)``: 2024-01, 2024-02, 2024-04 -> two ranges."""
    out: list[list[str]] = []
    for lo, hi in sorted(month_bounds(m) for m in set(months)):
        if out and out[-1][1] == lo:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def prev_month(month: str) -> str:
    y, m = map(int, validate_month(month).split("-"))
    y, m = (y - 1, 12) if m == 1 else (y, m - 1)
    return f"{y:04d}-{m:02d}"

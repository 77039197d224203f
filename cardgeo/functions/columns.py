"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen and comparisons on plain columns reach the Parquet
reader as pushed filters.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, MapType, StringType, StructType, TimestampNTZType

from ..params import BIN_MAX_LEN, BIN_MIN_LEN, as_decimal, month_intervals

# Strict formats asked for by the spec (digits-only BIN of
# 6 to 8 characters, upper-case two-letter country code).
STRICT_BIN_PATTERN = "^[0-9]{6,8}$"
STRICT_COUNTRY_PATTERN = "^[A-Z]{2}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def not_fraud(col="fraud_label") -> Column:
    """``fraud_label = false``; a null label is dropped like fraud."""
    return _c(col) == F.lit(False)


def country_present(col="billing_address_country") -> Column:
    return _c(col).isNotNull()


def bin_length_ok(col="BIN", lo: int = BIN_MIN_LEN, hi: int = BIN_MAX_LEN) -> Column:
    """BIN has ``lo``..``hi`` characters; never null (a null BIN is not ok)."""
    n = F.length(_c(col))
    return F.coalesce((n >= lo) & (n <= hi), F.lit(False))


def strict_bin_ok(col="BIN") -> Column:
    return F.coalesce(_c(col).rlike(STRICT_BIN_PATTERN), F.lit(False))


def strict_country_ok(col, allow_null: bool = False) -> Column:
    ok = F.coalesce(_c(col).rlike(STRICT_COUNTRY_PATTERN), F.lit(False))
    return (ok | _c(col).isNull()) if allow_null else ok


def _any_interval(months, one) -> Column:
    """OR over the maximal contiguous month ranges (a 7-year backfill is one
    range: two comparisons per row, not two per month)."""
    ranges = month_intervals([months] if isinstance(months, str) else months)
    if not ranges:
        raise ValueError("empty month list")
    cond = one(*ranges[0])
    for lo, hi in ranges[1:]:
        cond = cond | one(lo, hi)
    return cond


def in_month(ts_col, months, ts_type: DataType = TimestampNTZType()) -> Column:
    """Half-open range(s) of one month or a list of months on a timestamp
    column.

    The bounds are literals of the column's own type, so the predicate is a
    plain comparison that Parquet can push down and skip row groups with
    (never ``date_format(ts) = month``, which reads every row).
    """
    c = _c(ts_col)
    return _any_interval(
        months, lambda lo, hi: (c >= F.lit(lo).cast(ts_type)) & (c < F.lit(hi).cast(ts_type)))


def in_month_dates(date_col, months, col_type: DataType) -> Column:
    """The same half-open range(s) on a date-like *partition* column
    (``date``, ISO ``yyyy-MM-dd`` string, or timestamp), so the scan prunes
    whole partitions (``PartitionFilters``) before reading any file."""
    c = _c(date_col)

    def one(lo, hi):
        if isinstance(col_type, StringType):
            return (c >= F.lit(lo[:10])) & (c < F.lit(hi[:10]))
        if isinstance(col_type, DateType):
            return (c >= F.lit(lo[:10]).cast("date")) & (c < F.lit(hi[:10]).cast("date"))
        return (c >= F.lit(lo).cast(col_type)) & (c < F.lit(hi).cast(col_type))
    return _any_interval(months, one)


def month_of(ts_col) -> Column:
    return F.date_format(_c(ts_col), "yyyy-MM")


def month_key(ts_col) -> Column:
    """Integer ``yyyymm`` of a timestamp: a cheap per-row grouping key (about
    2x faster than formatting text on every raw row)."""
    c = _c(ts_col)
    return F.year(c) * 100 + F.month(c)


def month_key_text(key) -> Column:
    """``yyyymm`` integer -> ``YYYY-MM`` (applied after aggregation)."""
    k = _c(key)
    return F.concat(F.lpad(F.floor(k / 100).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad((k % 100).cast("string"), 2, "0"))


def month_index(month) -> Column:
    """``YYYY-MM`` text -> months since year 0, for ranges over calendar months
    (null if malformed)."""
    m = _c(month)
    ok = m.rlike("^[0-9]{4}-(0[1-9]|1[0-2])$")
    return F.when(ok, F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 6, 2).cast("int"))


def within_coverage(prior_count, bin_total, coverage) -> Column:
    """Exact coverage cut: keep a row while the share *before* it is below
    ``coverage``. ``bigint * decimal`` is exact, so 95 of 100 stops at the
    boundary instead of drifting on summed doubles."""
    cov = as_decimal(coverage)
    return _c(prior_count) < _c(bin_total) * F.lit(Decimal(cov))


def share(num, den) -> Column:
    """``num / den`` as double (null when ``den`` is 0)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def is_discrepant(inferred="inferred_top_country", vendor="vendor_country") -> Column:
    """True iff the vendor has a country and it differs (case-sensitively)."""
    return F.coalesce(_c(inferred) != _c(vendor), F.lit(False))


def row_hash(schema: StructType, salt: int = 0) -> Column:
    """64-bit hash of a row's columns by name, so that column order does not
    matter; another one for each ``salt``. A hash skips nulls, so each column's
    null flag is hashed too; maps count as their sorted entries."""
    parts = [F.lit(salt)]
    for f in sorted(schema.fields, key=lambda f: f.name):
        c = F.col(f"`{f.name}`")
        parts += [c.isNull(), F.array_sort(F.map_entries(c)) if isinstance(f.dataType, MapType) else c]
    return F.xxhash64(*parts)


def wilson_bound(successes, trials, z: float, sign: int) -> Column:
    """A bound (``sign`` -1 lower, 1 upper) of Wilson's score interval for the
    share ``successes / trials`` (null without trials)."""
    k, n, zz = _c(successes).cast("double"), _c(trials).cast("double"), F.lit(z * z)
    p = F.try_divide(k, n)
    half = F.lit(z) * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(zz, 4 * n * n))
    return F.try_divide(p + F.try_divide(zz, 2 * n) + F.lit(sign) * half, 1 + F.try_divide(zz, n))

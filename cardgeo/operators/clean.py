"""Load filter (fraud, missing country, BIN length, month slice) and its
reject accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    bin_length_ok,
    country_present,
    in_month,
    in_month_dates,
    month_of,
    not_fraud,
    strict_bin_ok,
    strict_country_ok,
)
from ..schemas import require_columns
from .codes import known_codes, with_known

_TXN_COLS = {"BIN", "billing_address_country", "fraud_label"}


def slice_month(tx: DataFrame, month, ts_col: str = "timestamp",
                date_col: str | None = None, *, with_null: bool = False) -> DataFrame:
    """Rows of ``month`` -- one ``YYYY-MM`` or a list of them -- (``None`` =
    all history). Half-open timestamp ranges, so Parquet row groups outside
    them are skipped; several months are one OR of ranges, one scan.

    ``date_col`` names a date partition column of the table (e.g.
    ``txn_date``); the same range on it prunes whole partitions. ``with_null``
    keeps rows without a timestamp, so that a run can account for them (with
    ``date_col``: those in the partitions that it reads, and in the null one).
    """
    if month is None:
        return tx
    require_columns(tx.columns, {ts_col} | ({date_col} if date_col else set()), "transactions")
    months = [month] if isinstance(month, str) else list(month)
    if not months:
        raise ValueError("empty month list")
    def ok(cond, c):
        return cond | F.col(c).isNull() if with_null else cond

    out = tx.where(ok(in_month(ts_col, months, tx.schema[ts_col].dataType), ts_col))
    if date_col:
        out = out.where(ok(in_month_dates(date_col, months, tx.schema[date_col].dataType), date_col))
    return out


def filter_fraud(tx: DataFrame) -> DataFrame:
    return tx.where(not_fraud())


def filter_null_country(tx: DataFrame) -> DataFrame:
    return tx.where(country_present())


def filter_bin_length(tx: DataFrame) -> DataFrame:
    return tx.where(bin_length_ok())


def load_filtered(
    tx: DataFrame,
    month=None,
    *,
    strict: bool = False,
    codes: DataFrame | None = None,
    ts_col: str = "timestamp",
    date_col: str | None = None,
) -> DataFrame:
    """Clean transactions: not fraud (null label dropped), country present,
    BIN of 6..8 characters, optionally a month (or list of months), strict
    formats and countries of a list (``codes``, see ``codes.py``).

    One ``where`` so Catalyst sees the whole conjunction; the comparisons on
    stored columns become Parquet pushed filters.
    """
    require_columns(tx.columns, _TXN_COLS, "transactions")
    cond = not_fraud() & country_present() & bin_length_ok()
    if strict:
        cond = cond & strict_bin_ok() & strict_country_ok("billing_address_country")
    out = slice_month(tx, month, ts_col, date_col).where(cond)
    return out if codes is None else known_codes(out, codes)


# Reject reasons in first-match order; "kept" means the row passes.
# "null_timestamp" applies to monthly runs: such a row belongs to no month;
# "unknown_country" is found after counting, against a list of codes.
REASONS = ("null_timestamp", "null_label", "fraud", "null_country", "bad_bin_length",
           "bad_bin_format", "bad_country_format", "unknown_country", "kept")


def reject_reason_code(strict: bool = False, monthly: bool = False):
    """First-match reason a row is dropped by :func:`load_filtered`, as an
    index into ``REASONS`` (an integer is a cheaper per-row grouping key
    than text; :func:`reason_text` names it after aggregation). ``monthly``:
    a row without a timestamp is dropped too."""
    code = {r: i for i, r in enumerate(REASONS)}
    no_time = F.col("timestamp").isNull() if monthly else F.lit(False)
    r = (F.when(no_time, code["null_timestamp"])
         .when(F.col("fraud_label").isNull(), code["null_label"])
         .when(F.col("fraud_label"), code["fraud"])
         .when(F.col("billing_address_country").isNull(), code["null_country"])
         .when(~bin_length_ok(), code["bad_bin_length"]))
    if strict:
        r = (r.when(~strict_bin_ok(), code["bad_bin_format"])
             .when(~strict_country_ok("billing_address_country"), code["bad_country_format"]))
    return r.otherwise(code["kept"])


def reason_text(code_col):
    return F.element_at(F.array(*[F.lit(r) for r in REASONS]), code_col + F.lit(1))


def reject_unknown(counted: DataFrame, codes: DataFrame, country: str) -> DataFrame:
    """Counted rows (``_code``, ``country`` and others) with the kept ones of
    unknown countries rejected. The list meets counts, not raw rows."""
    kept, unknown = REASONS.index("kept"), REASONS.index("unknown_country")
    judged = with_known(counted, codes, {"_known": country})
    return judged.withColumn("_code", F.when((F.col("_code") == kept) & ~F.col("_known"), unknown)
                             .otherwise(F.col("_code"))).drop("_known")


def reject_reasons(
    tx: DataFrame, month=None, *, strict: bool = False, by=(), monthly: bool = False,
    codes: DataFrame | None = None
) -> DataFrame:
    """Rows per reason (``kept`` included) in one partial/final aggregate;
    ``monthly`` as in :func:`reject_reason_code`. With a list of ``codes`` the
    rows are counted per country first and judged by it after."""
    from .counts import group_keys, months_as_text
    require_columns(tx.columns, _TXN_COLS, "transactions")
    sliced = slice_month(tx, month)
    code = reject_reason_code(strict, monthly)
    if codes is None:
        counted = (sliced.groupBy(*group_keys(sliced, by), code.alias("_code"))
                   .agg(F.count(F.lit(1)).alias("n_rows")))
    else:
        kept = F.when(F.col("_code") == REASONS.index("kept"), F.col("billing_address_country"))
        per = (sliced.withColumn("_code", code).groupBy(*group_keys(sliced, by), "_code", kept.alias("_country"))
               .agg(F.count(F.lit(1)).alias("n")))
        counted = reject_unknown(per, codes, "_country").groupBy(*by, "_code").agg(F.sum("n").alias("n_rows"))
    return months_as_text(counted.select(*by, reason_text(F.col("_code")).alias("reason"), "n_rows"))


def strict_bin_rejects(tx: DataFrame) -> DataFrame:
    """BINs that are not 6..8 digits, with their row counts."""
    return (tx.where(~strict_bin_ok())
            .groupBy("BIN").agg(F.count(F.lit(1)).alias("n_rows")))


def strict_country_rejects(vendor: DataFrame) -> DataFrame:
    """Vendor rows whose country is not an upper-case two-letter code
    (a null vendor country is allowed)."""
    return vendor.where(~strict_country_ok("country", allow_null=True)).select("BIN", "country")

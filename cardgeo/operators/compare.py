"""Comparison of the inferred top country with the vendor's mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_discrepant, share, wilson_bound, within_coverage
from ..params import DEFAULT_COVERAGE
from ..schemas import require_columns
from .coverage import rank_window, running_count

_INFERRED_COLS = {"BIN", "country", "txn_count", "bin_total"}
_VENDOR_COLS = {"BIN", "country"}


def top1_country(inferred: DataFrame, by=()) -> DataFrame:
    """Leading country per BIN: ``row_number() = 1`` over the ranking order
    (planned as a ``WindowGroupLimit``, so only one row per BIN survives
    the sort)."""
    require_columns(inferred.columns, _INFERRED_COLS | set(by), "inferred frame")
    return (inferred.withColumn("_rn", F.row_number().over(rank_window(by)))
            .where(F.col("_rn") == 1)
            .select(*by, "BIN", F.col("country").alias("inferred_top_country"), "bin_total"))


def vendor_dedup(vendor: DataFrame) -> DataFrame:
    """One vendor row per BIN (smallest non-null country), so the join
    cannot multiply a BIN's output rows."""
    require_columns(vendor.columns, _VENDOR_COLS, "vendor frame")
    return vendor.groupBy("BIN").agg(F.min("country").alias("country"))


def vendor_conflicts(vendor: DataFrame) -> DataFrame:
    """Vendor BINs mapped to more than one distinct country."""
    require_columns(vendor.columns, _VENDOR_COLS, "vendor frame")
    return (vendor.groupBy("BIN")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("country").alias("n_countries"),
                 F.min("country").alias("min_country"),
                 F.max("country").alias("max_country"))
            .where(F.col("n_countries") > 1))


def _vendor_side(vendor: DataFrame, dedup: bool) -> DataFrame:
    require_columns(vendor.columns, _VENDOR_COLS, "vendor frame")
    v = vendor_dedup(vendor) if dedup else vendor.select("BIN", "country")
    return v.select("BIN", F.col("country").alias("vendor_country"))


def flag_discrepancies(
    inferred: DataFrame, vendor: DataFrame, by=(), *, dedup: bool = True
) -> DataFrame:
    """One row per BIN: inferred top country, vendor country (null when
    the vendor has no row), ``is_discrepant`` and ``bin_total``.

    Left equi-join on BIN; no hint: the inferred side is already hash
    partitioned by BIN, and Catalyst/AQE broadcast the vendor side only
    when its measured size is under the broadcast threshold.
    ``dedup=False`` reproduces the unguarded join (duplicates multiply).
    """
    top = top1_country(inferred, by)
    joined = top.join(_vendor_side(vendor, dedup), "BIN", "left")
    return joined.select(*by, "BIN", "inferred_top_country", "vendor_country",
                         is_discrepant().alias("is_discrepant"), "bin_total")


def discrepant_bins(flags: DataFrame) -> DataFrame:
    return flags.where(F.col("is_discrepant"))


def discrepancy_severity(
    counts: DataFrame, vendor: DataFrame, coverage=DEFAULT_COVERAGE, by=()
) -> DataFrame:
    """How strongly the vendor's country is contradicted inside each BIN.

    ``counts`` are (supported) country counts. The vendor country is joined
    on every count row, the ranking window runs once, and one aggregate per
    BIN (no further shuffle: all three steps share the BIN partitioning)
    yields the top country's share, the vendor country's share, whether the
    vendor country is among the countries reaching ``coverage``, and
    ``is_significant`` = discrepant and not among them.
    """
    require_columns(counts.columns, _INFERRED_COLS | set(by), "country counts")
    j = counts.join(_vendor_side(vendor, True), "BIN", "left")
    ranked = (j.withColumn("_rn", F.row_number().over(rank_window(by)))
              .withColumn("_cum", running_count(by)))
    kept = within_coverage(F.col("_cum") - F.col("txn_count"), "bin_total", coverage)
    is_vendor = F.col("country") == F.col("vendor_country")
    agg = (ranked.groupBy(*by, "BIN")
           .agg(F.max(F.when(F.col("_rn") == 1, F.col("country"))).alias("inferred_top_country"),
                F.max("vendor_country").alias("vendor_country"),
                F.max("bin_total").alias("bin_total"),
                F.max(F.when(F.col("_rn") == 1, F.col("txn_count"))).alias("top_country_txns"),
                F.sum(F.when(is_vendor, F.col("txn_count")).otherwise(F.lit(0)))
                 .alias("vendor_country_txns"),
                F.max(F.when(is_vendor & kept, F.lit(1)).otherwise(F.lit(0)))
                 .alias("_vendor_kept")))
    disc = is_discrepant()
    return agg.select(
        *by, "BIN", "inferred_top_country", "vendor_country",
        disc.alias("is_discrepant"), "bin_total", "top_country_txns",
        share("top_country_txns", "bin_total").alias("top_country_pct"),
        F.col("vendor_country_txns").cast("long").alias("vendor_country_txns"),
        share("vendor_country_txns", "bin_total").alias("vendor_country_pct"),
        (F.col("_vendor_kept") == 1).alias("vendor_in_top"),
        (disc & (F.col("_vendor_kept") == 0)).alias("is_significant"),
    )


#: Two-sided 95 %.
Z_95 = 1.959963984540054


def discrepancy_significance(counts: DataFrame, vendor: DataFrame, z: float = Z_95, coverage=DEFAULT_COVERAGE,
                             by=()) -> DataFrame:
    """Whether a disagreement with the vendor is more than chance: the counts of
    :func:`discrepancy_severity` with Wilson's interval of the vendor country's
    share (``vendor_pct_low`` / ``_high``) and the lower bound of the leading
    country's share among the two (``lead_low``).

    ``is_significant``: the countries differ and the leading one is ahead beyond
    the interval (``lead_low`` over one half). Three rows of three are not
    enough at 95 % (lower bound 0.44). Bounds are rounded to nine places."""
    s = discrepancy_severity(counts, vendor, coverage, by)
    both = F.col("top_country_txns") + F.col("vendor_country_txns")
    bound = lambda k, n, sign: F.round(wilson_bound(k, n, z, sign), 9)
    lead = bound("top_country_txns", both, -1)
    known = F.col("vendor_country").isNotNull()
    return s.select(*by, "BIN", "inferred_top_country", "vendor_country", "is_discrepant", "bin_total",
                    "top_country_txns", "vendor_country_txns",
                    F.when(known, bound("vendor_country_txns", "bin_total", -1)).alias("vendor_pct_low"),
                    F.when(known, bound("vendor_country_txns", "bin_total", 1)).alias("vendor_pct_high"),
                    F.when(F.col("is_discrepant"), lead).alias("lead_low"),
                    F.coalesce(F.col("is_discrepant") & (lead > 0.5), F.lit(False)).alias("is_significant"))

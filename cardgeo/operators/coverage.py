"""Coverage cut (top countries reaching a share of a BIN's traffic) and the
minimum-support threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share, within_coverage
from ..params import DEFAULT_COVERAGE, DEFAULT_MIN_TXNS
from ..schemas import require_columns

_COUNT_COLS = {"BIN", "country", "txn_count", "bin_total"}


def rank_window(by=()):
    """Countries of a BIN by ``txn_count`` desc, ties by country asc.

    (txn_count, country) is unique within a BIN after the count, so the
    order is total and ROWS and RANGE frames agree.
    """
    return (Window.partitionBy(*by, "BIN")
            .orderBy(F.col("txn_count").desc(), F.col("country").asc_nulls_first()))


def running_count(by=()):
    w = rank_window(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum("txn_count").over(w)


def country_share(counts: DataFrame) -> DataFrame:
    require_columns(counts.columns, _COUNT_COLS, "country counts")
    return counts.withColumn("country_pct", share("txn_count", "bin_total"))


def cumulative_share(counts: DataFrame, by=()) -> DataFrame:
    """Every row with ``country_pct`` and ``cumulative_pct`` (no cut)."""
    require_columns(counts.columns, _COUNT_COLS | set(by), "country counts")
    return (counts.withColumn("_cum", running_count(by))
            .select(*by, "BIN", "country", "txn_count", "bin_total",
                    share("txn_count", "bin_total").alias("country_pct"),
                    share("_cum", "bin_total").alias("cumulative_pct")))


def select_top_countries(counts: DataFrame, coverage=DEFAULT_COVERAGE, by=()) -> DataFrame:
    """Smallest prefix of a BIN's ranked countries whose share reaches
    ``coverage``: a row is kept while the count *before* it is below
    ``coverage * bin_total`` (so the row that crosses the target is kept).

    The cut is exact (integer count against a decimal product), never a
    comparison of summed doubles.
    """
    require_columns(counts.columns, _COUNT_COLS | set(by), "country counts")
    return (counts.withColumn("_cum", running_count(by))
            .where(within_coverage(F.col("_cum") - F.col("txn_count"), "bin_total", coverage))
            .select(*by, "BIN", "country", "txn_count", "bin_total",
                    share("txn_count", "bin_total").alias("country_pct"),
                    share("_cum", "bin_total").alias("cumulative_pct")))


def filter_supported_bins(df: DataFrame, min_txns: int = DEFAULT_MIN_TXNS) -> DataFrame:
    """Keep BINs with ``bin_total >= min_txns`` (all rows of a BIN together).

    ``bin_total`` is constant within a BIN, so this may run before or after
    the coverage cut with the same result; running it before spares the
    ranking window the low-support BINs.
    """
    require_columns(df.columns, {"bin_total"}, "country rows")
    return df.where(F.col("bin_total") >= F.lit(int(min_txns)))


def support_flag(df: DataFrame, min_txns: int = DEFAULT_MIN_TXNS) -> DataFrame:
    """Keep every BIN, flag low support instead of excluding it."""
    require_columns(df.columns, {"bin_total"}, "country rows")
    return df.withColumn("is_supported", F.col("bin_total") >= F.lit(int(min_txns)))

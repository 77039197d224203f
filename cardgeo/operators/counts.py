"""Transactions per (BIN, country) and per BIN."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_key, month_key_text
from ..schemas import require_columns


def group_keys(df: DataFrame, by, ts_col: str = "timestamp"):
    """Grouping expressions for ``by``. ``snapshot_month`` absent from the
    frame is derived from ``ts_col`` as the integer ``yyyymm`` key (cheap
    per raw row); :func:`months_as_text` renders it after aggregation."""
    out = []
    for c in by:
        if c == "snapshot_month" and c not in df.columns:
            require_columns(df.columns, {ts_col}, "transactions")
            out.append(month_key(ts_col).alias(c))
        else:
            require_columns(df.columns, {c}, "frame")
            out.append(F.col(c))
    return out


def months_as_text(df: DataFrame) -> DataFrame:
    """Integer ``snapshot_month`` keys -> ``YYYY-MM`` (no-op for text)."""
    if "snapshot_month" in df.columns and df.schema["snapshot_month"].dataType.typeName() in (
            "integer", "long"):
        return df.withColumn("snapshot_month", month_key_text("snapshot_month"))
    return df


def country_counts(clean: DataFrame, by=()) -> DataFrame:
    """``(BIN, country, txn_count, bin_total)`` from clean transactions.

    The group-by is a partial + final hash aggregate, so a hot BIN sends at
    most one row per (BIN, country) per input task through the shuffle. The
    per-BIN total is a window over the *aggregated* rows (a few per BIN),
    partitioned by BIN, so downstream windows and the vendor join on BIN
    reuse that partitioning.
    """
    require_columns(clean.columns, {"BIN", "billing_address_country"}, "transactions")
    counts = months_as_text(
        clean.groupBy(*group_keys(clean, by), "BIN",
                      F.col("billing_address_country").alias("country"))
        .agg(F.count(F.lit(1)).alias("txn_count")))
    total = F.sum("txn_count").over(Window.partitionBy(*by, "BIN"))
    return counts.select(*by, "BIN", "country", "txn_count", total.alias("bin_total"))


def counts_from_partials(partials: DataFrame, by=()) -> DataFrame:
    """Country counts from pre-aggregated rows ``(by…, BIN, country, n)``
    (several rows per key allowed: micro-batch partials, staged counts)."""
    require_columns(partials.columns, {"BIN", "country", "n", *by}, "partial counts")
    counts = (partials.groupBy(*by, "BIN", "country")
              .agg(F.sum("n").cast("long").alias("txn_count")))
    total = F.sum("txn_count").over(Window.partitionBy(*by, "BIN"))
    return counts.select(*by, "BIN", "country", "txn_count", total.alias("bin_total"))


def distinct_support(clean: DataFrame, min_txns: int, by=(), *,
                     rsd: float | None = None) -> DataFrame:
    """Rows vs distinct transaction ids per BIN, and support on distinct ids.

    Exact by default: ``count_distinct`` is planned as an aggregate on
    (BIN, id), then a count per BIN, so a hot BIN is spread over the id hash
    first -- but that first shuffle carries about one row per distinct id.
    ``rsd`` (e.g. 0.01) opts into Spark's HyperLogLog++ sketch aggregate
    instead: a fixed-size sketch per BIN per task is all that is shuffled.
    """
    require_columns(clean.columns, {"BIN", "transaction_id"}, "transactions")
    distinct = (F.count_distinct("transaction_id") if rsd is None
                else F.approx_count_distinct("transaction_id", rsd))
    return (months_as_text(clean.groupBy(*group_keys(clean, by), "BIN")
                           .agg(F.count(F.lit(1)).alias("bin_total"),
                                distinct.alias("distinct_txns")))
            .withColumn("is_supported_distinct", F.col("distinct_txns") >= F.lit(int(min_txns))))


def distinct_support_from_partials(partials: DataFrame, min_txns: int, by=()) -> DataFrame:
    """Support on distinct transaction ids from the sketches of partial counts
    (``ids``, see ``reason_counts``), without the raw rows: sketches of a BIN's
    countries, batches and (unless in ``by``) months are merged, so an id seen
    in several of them counts once. The relative standard error of
    ``distinct_txns`` is about 1.04 / sqrt(2^lg_k); small counts are exact."""
    require_columns(partials.columns, {"BIN", "n", "ids", *by}, "partial counts")
    return (partials.where(F.col("ids").isNotNull()).groupBy(*by, "BIN")
            .agg(F.sum("n").cast("long").alias("bin_total"),
                 F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("distinct_txns"))
            .withColumn("is_supported_distinct", F.col("distinct_txns") >= F.lit(int(min_txns))))


def distinct_bins(df: DataFrame) -> DataFrame:
    return df.select("BIN").distinct()

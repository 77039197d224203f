"""Data-quality checks and stage metrics as DataFrames.

Each ``dq_*`` returns the violating rows (empty = pass), so checks run on
the cluster next to the data and can gate a publication; nothing but the
(small) result is collected. Metrics come back in long form
``(stage, metric, value)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bin_length_ok, share, strict_country_ok, within_coverage
from ..params import DEFAULT_COVERAGE, DEFAULT_MIN_TXNS
from ..schemas import require_columns
from .clean import REASONS, reason_text, reject_reason_code, reject_unknown, slice_month
from .codes import with_known
from .counts import group_keys, months_as_text
from .coverage import rank_window, running_count

_MONTH_PATTERN = "^[0-9]{4}-(0[1-9]|1[0-2])$"
CRITICAL_COLUMNS = ("BIN", "inferred_top_country", "is_discrepant", "snapshot_month")


def dq_nulls(df: DataFrame, cols=CRITICAL_COLUMNS) -> DataFrame:
    """Null count per column in one aggregate: ``(column_name, null_count)``
    for the columns that have nulls."""
    require_columns(df.columns, cols, "checked frame")
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                   for c in cols])
    long = agg.unpivot([], list(cols), "column_name", "null_count")
    return long.where(F.col("null_count") > 0)


def dq_unique_bin(snap: DataFrame, by=("snapshot_month",)) -> DataFrame:
    """BINs with more than one row per snapshot (null BIN excluded)."""
    return (snap.where(F.col("BIN").isNotNull())
            .groupBy(*by, "BIN").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def dq_country_code(snap: DataFrame, *, strict: bool = False, codes: DataFrame | None = None) -> DataFrame:
    """Rows whose inferred or (non-null) vendor country is not a two-letter
    code; ``strict`` also demands upper-case letters, ``codes`` a country of
    that list (``unknown_...`` where only the list is broken)."""
    def bad(c):
        ok = strict_country_ok(c) if strict else (F.length(F.col(c)) == 2)
        return F.col(c).isNotNull() & ~ok

    reason = (F.when(bad("inferred_top_country"), "bad_inferred_country")
              .when(bad("vendor_country"), "bad_vendor_country"))
    if codes is not None:
        snap = with_known(snap, codes, {"_inferred_known": "inferred_top_country", "_vendor_known": "vendor_country"})
        reason = (reason.when(F.col("inferred_top_country").isNotNull() & ~F.col("_inferred_known"), "unknown_inferred_country")
                  .when(F.col("vendor_country").isNotNull() & ~F.col("_vendor_known"), "unknown_vendor_country"))
    keep = [c for c in ("snapshot_month",) if c in snap.columns]
    return (snap.select(*keep, "BIN", "inferred_top_country", "vendor_country",
                        reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def dq_bin_length(df: DataFrame) -> DataFrame:
    """Rows whose (non-null) BIN is not 6..8 characters long."""
    keep = [c for c in ("snapshot_month",) if c in df.columns]
    return (df.where(F.col("BIN").isNotNull() & ~bin_length_ok())
            .select(*keep, "BIN", F.length("BIN").alias("bin_length")))


def dq_snapshot_month(snap: DataFrame) -> DataFrame:
    """Rows per snapshot_month value with a format check (null or malformed
    months are violations)."""
    return (snap.groupBy("snapshot_month").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("is_valid", F.coalesce(F.col("snapshot_month").rlike(_MONTH_PATTERN),
                                               F.lit(False))))


def dq_total_matches(counts: DataFrame, by=()) -> DataFrame:
    """BINs whose ``bin_total`` differs from the sum of their counts."""
    require_columns(counts.columns, {"BIN", "txn_count", "bin_total"}, "country counts")
    return (counts.groupBy(*by, "BIN")
            .agg(F.sum("txn_count").cast("long").alias("sum_txn_count"),
                 F.min("bin_total").alias("min_bin_total"),
                 F.max("bin_total").alias("max_bin_total"))
            .where((F.col("sum_txn_count") != F.col("max_bin_total"))
                   | (F.col("min_bin_total") != F.col("max_bin_total"))))


def dq_unique_bin_country(df: DataFrame, by=()) -> DataFrame:
    """(BIN, country) pairs that occur more than once."""
    return (df.groupBy(*by, "BIN", "country").agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def dq_coverage_reached(top: DataFrame, coverage=DEFAULT_COVERAGE, by=()) -> DataFrame:
    """Per BIN of a top-country map: ``not_reached`` if the kept countries
    cover less than ``coverage``; ``not_minimal`` if the map still reaches
    it without its last (smallest) country. Exact integer arithmetic."""
    require_columns(top.columns, {"BIN", "txn_count", "bin_total"}, "top countries")
    agg = (top.groupBy(*by, "BIN")
           .agg(F.sum("txn_count").cast("long").alias("kept_txns"),
                F.min("txn_count").alias("last_txns"),
                F.max("bin_total").alias("bin_total"),
                F.count(F.lit(1)).alias("n_countries")))
    reached = ~within_coverage(F.col("kept_txns"), "bin_total", coverage)
    minimal = within_coverage(F.col("kept_txns") - F.col("last_txns"), "bin_total", coverage)
    reason = F.when(~reached, "not_reached").when(~minimal, "not_minimal")
    return (agg.select(*by, "BIN", "kept_txns", "bin_total", "n_countries",
                       share("kept_txns", "bin_total").alias("kept_pct"), reason.alias("reason"))
            .where(F.col("reason").isNotNull()))


def dq_row_count(snap: DataFrame, lo: float = 0.5, hi: float = 2.0, months=None) -> DataFrame:
    """Rows per month against the previous calendar month: anomalous when a
    month is empty or its row count moved outside ``[lo, hi]`` times the
    previous one.

    Months without rows count as empty: those of ``months`` (a frame with
    ``snapshot_month``, e.g. a ledger) or, by default, every month between the
    first and the last one found. The windows and the sequence run over one
    row per month (a few hundred rows at most), after the per-month aggregate.
    """
    counted = snap.where(F.col("snapshot_month").isNotNull()).groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("n_rows"))
    if months is None:
        day = lambda f: F.to_date(F.concat(f("snapshot_month"), F.lit("-01")))
        every = F.sequence(day(F.min), day(F.max), F.expr("interval 1 month"))
        months = (counted.where(F.col("snapshot_month").rlike(_MONTH_PATTERN))
                  .agg(every.alias("d")).select(F.explode("d").alias("d"))
                  .select(F.date_format("d", "yyyy-MM").alias("snapshot_month")))
    listed = months.select("snapshot_month").unionByName(counted.select("snapshot_month")).distinct()
    per_month = listed.join(counted, "snapshot_month", "left").select(
        "snapshot_month", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))
    prev = F.lag("n_rows").over(Window.orderBy("snapshot_month"))
    ratio = F.when(F.col("prev_n_rows") > 0, share("n_rows", "prev_n_rows"))
    return (per_month.withColumn("prev_n_rows", prev)
            .withColumn("ratio", ratio)
            .withColumn("is_anomalous",
                        (F.col("n_rows") == 0)
                        | F.coalesce((F.col("ratio") < lo) | (F.col("ratio") > hi), F.lit(False))))


# ------------------------------------------------------------ metrics


def _metrics(one_row: DataFrame, spec) -> DataFrame:
    """One aggregate row -> ``(stage, metric, value)`` rows (single pass)."""
    arr = F.array(*[F.struct(F.lit(stage).alias("stage"), F.lit(metric).alias("metric"),
                             F.col(col).cast("long").alias("value"))
                    for stage, metric, col in spec])
    return one_row.select(F.inline(arr))


def count_metrics(counts: DataFrame, coverage=DEFAULT_COVERAGE,
                  min_txns: int = DEFAULT_MIN_TXNS) -> DataFrame:
    """Aggregate, coverage and support metrics from the country counts in
    one pass (reference order: coverage cut, then support)."""
    kept = within_coverage(F.col("_cum") - F.col("txn_count"), "bin_total", coverage)
    sup = F.col("bin_total") >= F.lit(int(min_txns))
    first = F.col("_rn") == 1
    ranked = (counts.withColumn("_cum", running_count())
              .withColumn("_rn", F.row_number().over(rank_window())))
    one = ranked.agg(
        F.sum("txn_count").alias("clean_rows"),
        F.count(F.lit(1)).alias("count_rows"),
        F.sum(F.when(kept, 1).otherwise(0)).alias("top_rows"),
        F.sum(F.when(kept & sup, 1).otherwise(0)).alias("supported_rows"),
        F.sum(F.when(first, 1).otherwise(0)).alias("bins"),
        F.sum(F.when(first & sup, 1).otherwise(0)).alias("supported_bins"))
    return _metrics(one, [
        ("aggregate", "rows_in", "clean_rows"), ("aggregate", "rows_out", "count_rows"),
        ("coverage", "rows_in", "count_rows"), ("coverage", "rows_out", "top_rows"),
        ("support", "rows_in", "top_rows"), ("support", "rows_out", "supported_rows"),
        ("support", "bins_in", "bins"), ("support", "bins_out", "supported_bins")])


def support_metrics(counts: DataFrame, coverage=DEFAULT_COVERAGE,
                    min_txns: int = DEFAULT_MIN_TXNS) -> DataFrame:
    return count_metrics(counts, coverage, min_txns).where(F.col("stage") == "support")


def discrepancy_metrics(flags: DataFrame, vendor: DataFrame) -> DataFrame:
    f = flags.agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.sum(F.when(F.col("is_discrepant"), 1).otherwise(0)).alias("discrepant"),
        F.sum(F.when(F.col("vendor_country").isNull(), 1).otherwise(0)).alias("vendor_missing"))
    v = vendor.agg(F.count(F.lit(1)).alias("vendor_rows"))
    return (_metrics(f, [("compare", m, m) for m in ("rows_out", "discrepant", "vendor_missing")])
            .unionByName(_metrics(v, [("compare", "vendor_rows", "vendor_rows")])))


def reason_counts(tx: DataFrame, month=None, by=(), *, strict: bool = False, codes: DataFrame | None = None,
                  lg_k: int | None = None) -> DataFrame:
    """Rows per (reject reason, BIN, country): one scan and one partial/final
    aggregate from which every stage metric can be derived. Rejected rows are
    counted by reason only: malformed BINs have no bound on their number, and
    nothing downstream needs (or should keep) their values. By month, a row
    without a timestamp is rejected as ``null_timestamp``.

    ``codes`` rejects countries that are not in the list, after counting.
    ``lg_k`` adds ``ids``, a sketch of the kept rows' distinct transaction ids
    (HLL of 2^lg_k buckets) that can be merged over months, countries and
    batches (see ``distinct_support_from_partials``)."""
    sliced = slice_month(tx, month)
    keys = group_keys(sliced, by)
    code = reject_reason_code(strict, monthly="snapshot_month" in by)
    kept = F.col("_code") == REASONS.index("kept")
    id_sketch = [] if lg_k is None else [F.hll_sketch_agg(F.when(kept, F.col("transaction_id")), F.lit(int(lg_k))).alias("ids")]
    agg = (sliced.withColumn("_code", code)
           .groupBy(*keys, "_code", F.when(kept, F.col("BIN")).alias("BIN"),
                    F.when(kept, F.col("billing_address_country")).alias("country"))
           .agg(F.count(F.lit(1)).alias("n"), *id_sketch))
    ids = [] if lg_k is None else ["ids"]
    if codes is not None:
        merged = [F.first("ids").alias("ids")] if ids else []  # a kept row is alone in its group
        agg = (reject_unknown(agg, codes, "country")
               .groupBy(*by, "_code", F.when(kept, F.col("BIN")).alias("BIN"), F.when(kept, F.col("country")).alias("country"))
               .agg(F.sum("n").alias("n"), *merged))
    return months_as_text(agg.select(*by, reason_text(F.col("_code")).alias("reason"),
                                     "BIN", "country", "n", *(F.when(kept, F.col(c)).alias(c) for c in ids)))


def stage_metrics(tx: DataFrame, vendor: DataFrame, month=None, coverage=DEFAULT_COVERAGE,
                  min_txns: int = DEFAULT_MIN_TXNS) -> DataFrame:
    """All stage metrics (load, aggregate, coverage, support, compare) from
    ONE scan of ``tx`` in a single branch of the plan: aggregate by
    (reason, BIN, country); rank each BIN's kept rows in one window (kept
    rows sort first); join the vendor country; one global aggregate.
    (Separate branches would each rescan: Catalyst pushes each branch's own
    filters below the shared aggregate, so its shuffle cannot be reused.)"""
    from .compare import vendor_dedup

    # Rejected rows have no BIN, so they meet in the null BIN: one row per
    # reason. Both windows share one sort: the columns they order by exist
    # before them, and the unordered sum comes after the ordered ones.
    k, kn = F.col("_kept"), F.col("_kn")
    part = Window.partitionBy("BIN")
    order = part.orderBy(k.desc(), F.col("n").desc(), F.col("country").asc_nulls_first())
    ranked = (reason_counts(tx, month)
              .withColumn("_kept", F.col("reason") == "kept")
              .withColumn("_kn", F.when(k, F.col("n")).otherwise(F.lit(0)))
              .withColumns({"_cum": F.sum(kn).over(
                                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                            "_rn": F.row_number().over(order)})
              .withColumn("bin_total", F.sum(kn).over(part)))
    v = vendor_dedup(vendor).select("BIN", F.col("country").alias("vendor_country"))
    j = ranked.join(v, "BIN", "left")
    cov = k & within_coverage(F.col("_cum") - F.col("n"), "bin_total", coverage)
    sup = F.col("bin_total") >= F.lit(int(min_txns))
    first = k & (F.col("_rn") == 1)
    flag = first & sup

    def cnt(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    one = j.agg(
        F.sum("n").alias("rows_in"), F.sum(kn).alias("clean_rows"),
        cnt(k).alias("count_rows"), cnt(cov).alias("top_rows"),
        cnt(cov & sup).alias("supported_rows"), cnt(first).alias("bins"),
        cnt(flag).alias("flag_rows"),
        cnt(flag & F.coalesce(F.col("country") != F.col("vendor_country"), F.lit(False)))
         .alias("discrepant"),
        cnt(flag & F.col("vendor_country").isNull()).alias("vendor_missing"))
    tx_metrics = _metrics(one, [
        ("load", "rows_in", "rows_in"), ("load", "rows_out", "clean_rows"),
        ("aggregate", "rows_in", "clean_rows"), ("aggregate", "rows_out", "count_rows"),
        ("coverage", "rows_in", "count_rows"), ("coverage", "rows_out", "top_rows"),
        ("support", "rows_in", "top_rows"), ("support", "rows_out", "supported_rows"),
        ("support", "bins_in", "bins"), ("support", "bins_out", "flag_rows"),
        ("compare", "rows_out", "flag_rows"), ("compare", "discrepant", "discrepant"),
        ("compare", "vendor_missing", "vendor_missing")])
    vendor_rows = _metrics(vendor.agg(F.count(F.lit(1)).alias("vendor_rows")),
                           [("compare", "vendor_rows", "vendor_rows")])
    return tx_metrics.unionByName(vendor_rows)

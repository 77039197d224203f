"""Month-to-month drift of the published BIN mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import require_columns

_COLS = {"BIN", "inferred_top_country", "bin_total"}


def snapshot_drift(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """Full outer join on BIN of two snapshots (one row per BIN each).

    ``change`` is ``added`` / ``removed`` / ``country_changed`` / ``same``
    (null-safe comparison of the top country); ``volume_change`` is the
    difference of ``bin_total`` where both sides have the BIN.
    """
    require_columns(prev.columns, _COLS, "previous snapshot")
    require_columns(curr.columns, _COLS, "current snapshot")
    p = prev.select("BIN", F.col("inferred_top_country").alias("prev_country"),
                    F.col("bin_total").alias("prev_bin_total"), F.lit(True).alias("_in_prev"))
    c = curr.select("BIN", F.col("inferred_top_country").alias("curr_country"),
                    F.col("bin_total").alias("curr_bin_total"), F.lit(True).alias("_in_curr"))
    j = p.join(c, "BIN", "full_outer")
    change = (F.when(F.col("_in_prev").isNull(), "added")
              .when(F.col("_in_curr").isNull(), "removed")
              .when(F.col("prev_country").eqNullSafe(F.col("curr_country")), "same")
              .otherwise("country_changed"))
    return j.select("BIN", "prev_country", "curr_country", "prev_bin_total", "curr_bin_total",
                    (F.col("curr_bin_total") - F.col("prev_bin_total")).alias("volume_change"),
                    change.alias("change"))


def next_month(month_col):
    """``YYYY-MM`` -> the following ``YYYY-MM`` (on small, aggregated data)."""
    first = F.to_date(F.concat(F.col(month_col) if isinstance(month_col, str) else month_col,
                               F.lit("-01")))
    return F.date_format(F.add_months(first, 1), "yyyy-MM")


def drift_summary(flags: DataFrame) -> DataFrame:
    """Per month of a multi-month flags frame, BINs ``added`` / ``removed`` /
    ``country_changed`` / ``same`` against the previous calendar month, for
    months whose previous month is in the frame.

    One full outer join on (month, BIN) of the flags with the same flags
    shifted one month forward -- no per-month loop, no driver round trip.
    """
    require_columns(flags.columns, _COLS | {"snapshot_month"}, "flags")
    cur = flags.select("snapshot_month", "BIN", F.col("inferred_top_country").alias("curr"),
                       F.lit(True).alias("_in_curr"))
    prev = flags.select(next_month("snapshot_month").alias("snapshot_month"), "BIN",
                        F.col("inferred_top_country").alias("prev"), F.lit(True).alias("_in_prev"))
    months = flags.select("snapshot_month").distinct()
    has_prev = months.join(
        months.select(next_month("snapshot_month").alias("snapshot_month")), "snapshot_month",
        "left_semi")
    j = cur.join(prev, ["snapshot_month", "BIN"], "full_outer").join(
        has_prev, "snapshot_month", "left_semi")
    change = (F.when(F.col("_in_prev").isNull(), "added")
              .when(F.col("_in_curr").isNull(), "removed")
              .when(F.col("prev").eqNullSafe(F.col("curr")), "same")
              .otherwise("country_changed"))
    return j.groupBy("snapshot_month", change.alias("change")).agg(
        F.count(F.lit(1)).alias("n_bins"))


#: Jensen-Shannon divergence (bits, 0 to 1) from which a BIN's mix has moved.
SHIFTED = 0.1


def _plogp(p):
    return F.when(p > 0, p * F.log2(p)).otherwise(0.0)


def country_drift(top: DataFrame, shifted: float = SHIFTED) -> DataFrame:
    """How far each BIN's distribution over countries moved since the previous
    calendar month, from a stored top-country map of several months:
    ``snapshot_month, BIN, prev_total, bin_total, js_divergence, is_shifted``
    for BINs that both months have.

    The classes are the countries that either month's map keeps, and one class
    for the rest of a BIN's transactions (``bin_total`` less the kept ones); a
    country that only one of the maps keeps is in the other's rest. Divergence
    is Jensen-Shannon's in bits, rounded to nine places: 0 for equal
    distributions, 1 for distributions without a common class.

    One exchange: rows go by (month, BIN) once, each also to the month after
    it, and both aggregates keep that partitioning. No raw rows, no self-join.
    """
    require_columns(top.columns, {"snapshot_month", "BIN", "country", "txn_count", "bin_total"}, "top-country map")
    month = F.col("snapshot_month")
    n = F.col("txn_count")
    none = F.lit(0).cast("long")
    both = (top.select(month, "BIN", "country", none.alias("p_n"), n.alias("q_n"), none.alias("p_t"),
                       F.col("bin_total").alias("q_t"))
            .unionByName(top.select(next_month("snapshot_month").alias("snapshot_month"), "BIN", "country",
                                    n.alias("p_n"), none.alias("q_n"), F.col("bin_total").alias("p_t"), none.alias("q_t"))))
    classes = (both.repartition("snapshot_month", "BIN").groupBy("snapshot_month", "BIN", "country")
               .agg(F.sum("p_n").alias("p_n"), F.sum("q_n").alias("q_n"), F.max("p_t").alias("p_t"), F.max("q_t").alias("q_t")))
    # 2 JSD = sum p log p + sum q log q - 2 sum m log m over the classes; shares
    # need the totals, so each class sums x log x of its counts' shares after.
    totals = classes.groupBy("snapshot_month", "BIN").agg(
        F.max("p_t").alias("prev_total"), F.max("q_t").alias("bin_total"),
        F.collect_list(F.struct("p_n", "q_n")).alias("kept"), F.sum("p_n").alias("p_kept"), F.sum("q_n").alias("q_kept"))
    totals = totals.where((F.col("prev_total") > 0) & (F.col("bin_total") > 0))
    rest = F.struct((F.col("prev_total") - F.col("p_kept")).alias("p_n"), (F.col("bin_total") - F.col("q_kept")).alias("q_n"))

    def term(x):
        p, q = x["p_n"] / F.col("prev_total"), x["q_n"] / F.col("bin_total")
        m = (p + q) / 2
        return (_plogp(p) + _plogp(q)) / 2 - _plogp(m)

    each = F.array_sort(F.transform(F.array_append("kept", rest), term))  # a fixed order of summation
    js = F.round(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), 9)
    return (totals.withColumn("js_divergence", F.greatest(js, F.lit(0.0)))
            .select("snapshot_month", "BIN", "prev_total", "bin_total", "js_divergence",
                    (F.col("js_divergence") >= shifted).alias("is_shifted")))

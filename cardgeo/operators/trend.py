"""Anomalies of a monthly series against the months before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import month_index
from ..schemas import require_columns

#: Months looked back on, and how many of them must have a value.
BASELINE_MONTHS, LEAST_MONTHS = 6, 3
#: Robust score, and share of the baseline, that a value must both exceed.
SCORE, SHARE = 3.5, 0.2
#: Scale of a median absolute deviation to a standard deviation.
MAD_SCALE = 0.6745


def _median(sorted_list: Column) -> Column:
    n = F.size(sorted_list)
    at = lambda i: F.get(sorted_list, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def trend_anomalies(series: DataFrame, value: str, by=("BIN",), *, months: int = BASELINE_MONTHS,
                    least: int = LEAST_MONTHS, score: float = SCORE, floor: float = SHARE) -> DataFrame:
    """Each month's ``value`` against the median of the ``months`` calendar
    months before it (those that have a row), per ``by``.

    Adds ``n_before``, ``baseline`` (median), ``mad`` (median absolute deviation
    from it), ``score`` (0.6745 * distance / mad, to nine places; null without a
    spread) and ``is_anomalous``: at least ``least`` months before, and the
    distance exceeds both ``score`` such deviations and ``floor`` of the
    baseline. A median ignores one earlier jump; a steady trend moves baseline
    and deviation along, so only its breaks stand out.

    ``series`` has one row per (``by``, ``snapshot_month``), so a window frame
    holds ``months`` rows at most; rows without a month are left out.
    """
    require_columns(series.columns, {*by, "snapshot_month", value}, "series")
    at = month_index("snapshot_month")
    frame = Window.partitionBy(*by).orderBy("_at").rangeBetween(-months, -1)
    before = F.collect_list(F.col(value).cast("double")).over(frame)
    out = (series.withColumn("_at", at).where(F.col("_at").isNotNull()).withColumn("_before", F.array_sort(before))
           .withColumn("baseline", _median(F.col("_before"))))
    spread = F.array_sort(F.transform("_before", lambda x: F.abs(x - F.col("baseline"))))
    out = out.withColumn("mad", _median(spread)).withColumn("n_before", F.size("_before").cast("long"))
    far = F.abs(F.col(value).cast("double") - F.col("baseline"))
    beyond = (far * MAD_SCALE > F.col("mad") * score) & (far > F.abs(F.col("baseline")) * floor)
    return out.select(*series.columns, "n_before", "baseline", "mad",
                      F.when(F.col("mad") > 0, F.round(far * MAD_SCALE / F.col("mad"), 9)).alias("score"),
                      F.coalesce((F.col("n_before") >= least) & beyond, F.lit(False)).alias("is_anomalous"))

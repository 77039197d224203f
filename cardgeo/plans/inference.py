"""The whole inference as one lazy plan.

``infer`` chains the operators so that Catalyst sees a single plan per
output: scan -> filter -> partial/final count -> per-BIN windows -> vendor
join. Shuffles: one on (BIN, country) after the partial aggregate, one on
BIN for the windows (reused by the vendor join); nothing is collected and
no inner sort is placed (sorting is a presentation step, see ``report``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    country_counts,
    filter_supported_bins,
    flag_discrepancies,
    load_filtered,
    select_top_countries,
)
from ..params import Params


@dataclass(frozen=True)
class Inference:
    clean: DataFrame
    counts: DataFrame
    supported: DataFrame
    top_countries: DataFrame
    flags: DataFrame


def infer(
    tx: DataFrame,
    vendor: DataFrame,
    month=None,
    params: Params = Params(),
    *,
    by=(),
    strict: bool = False,
    date_col: str | None = None,
) -> Inference:
    """All stages for one month (``None`` = all history) or, with
    ``by=("snapshot_month",)``, for many months in a single pass (``month``
    may then list the months; ``snapshot_month`` is derived from the
    timestamp at aggregation time when the frame lacks it)."""
    clean = load_filtered(tx, month, strict=strict, date_col=date_col)
    counts = country_counts(clean, by=by)
    # Support before the coverage window: bin_total is constant per BIN,
    # and Catalyst does not push this filter through the window by itself.
    supported = filter_supported_bins(counts, params.min_txns)
    top = select_top_countries(supported, params.coverage, by=by)
    flags = flag_discrepancies(top, vendor, by=by)
    return Inference(clean, counts, supported, top, flags)


def report(df: DataFrame, kind: str) -> DataFrame:
    """Presentation order (one global sort at the edge of the plan)."""
    orders = {
        "counts": [F.col("BIN").asc(), F.col("txn_count").desc(), F.col("country").asc()],
        "coverage": [F.col("BIN").asc(), F.col("txn_count").desc(), F.col("country").asc()],
        "flags": [F.col("BIN").asc()],
    }
    return df.orderBy(*orders[kind])

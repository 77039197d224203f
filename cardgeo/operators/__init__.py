"""DataFrame -> DataFrame operators of the BIN country inference."""

from .changes import apply_changes, row_changes
from .clean import (
    filter_bin_length,
    filter_fraud,
    filter_null_country,
    load_filtered,
    REASONS,
    reason_text,
    reject_reason_code,
    reject_reasons,
    slice_month,
    strict_bin_rejects,
    strict_country_rejects,
)
from .codes import MAX_BROADCAST_CODES, code_list, known_codes, unknown_codes, with_known
from .compare import (
    Z_95,
    discrepancy_significance,
    discrepancy_severity,
    discrepant_bins,
    flag_discrepancies,
    top1_country,
    vendor_conflicts,
    vendor_dedup,
)
from .counts import (
    country_counts,
    counts_from_partials,
    distinct_bins,
    distinct_support,
    distinct_support_from_partials,
    group_keys,
    months_as_text,
)
from .drift import SHIFTED, country_drift, drift_summary, next_month, snapshot_drift
from .quality import (
    count_metrics,
    discrepancy_metrics,
    dq_bin_length,
    dq_country_code,
    dq_coverage_reached,
    dq_nulls,
    dq_row_count,
    dq_snapshot_month,
    dq_total_matches,
    dq_unique_bin,
    dq_unique_bin_country,
    reason_counts,
    stage_metrics,
    support_metrics,
)
from .coverage import (
    country_share,
    cumulative_share,
    filter_supported_bins,
    rank_window,
    select_top_countries,
    support_flag,
)
from .trend import trend_anomalies

__all__ = [
    "Z_95",
    "discrepancy_significance",
    "trend_anomalies",
    "apply_changes",
    "row_changes",
    "SHIFTED",
    "country_drift",
    "MAX_BROADCAST_CODES",
    "code_list",
    "known_codes",
    "unknown_codes",
    "with_known",
    "distinct_support_from_partials",
    "count_metrics",
    "discrepancy_metrics",
    "dq_bin_length",
    "dq_country_code",
    "dq_coverage_reached",
    "dq_nulls",
    "dq_row_count",
    "dq_snapshot_month",
    "dq_total_matches",
    "dq_unique_bin",
    "dq_unique_bin_country",
    "reason_counts",
    "snapshot_drift",
    "drift_summary",
    "next_month",
    "stage_metrics",
    "support_metrics",
    "country_counts",
    "counts_from_partials",
    "country_share",
    "cumulative_share",
    "discrepancy_severity",
    "discrepant_bins",
    "distinct_bins",
    "distinct_support",
    "group_keys",
    "months_as_text",
    "filter_bin_length",
    "filter_fraud",
    "filter_null_country",
    "filter_supported_bins",
    "flag_discrepancies",
    "load_filtered",
    "rank_window",
    "REASONS",
    "reason_text",
    "reject_reason_code",
    "reject_reasons",
    "select_top_countries",
    "slice_month",
    "strict_bin_rejects",
    "strict_country_rejects",
    "support_flag",
    "top1_country",
    "vendor_conflicts",
    "vendor_dedup",
]

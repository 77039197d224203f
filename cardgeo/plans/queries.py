"""Registered queries: one per operator of the inventory.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` over the
whole test tables, paired (where SQL can express it) with DuckDB SQL that
computes the same rows. Column names match exactly on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..params import Params
from ..sinks import SnapshotTable, shared_dir
from ..sources import (
    read_transactions,
    read_vendor,
    tx_from_tables,
    vendor_dup_from_tables,
    vendor_from_tables,
)
from ..streaming import counts_from_partials, read_partials, start_count_stream
from . import oracle as o
from .inference import infer, report
from .publish import publish_month, publish_months, publish_months_from_counts

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed query parameters: all-history runs use coverage 0.95 and
# min_txns 100; monthly runs use 1998-03 / 1998-04 with min_txns 3.
ALL = Params(Decimal("0.95"), 100)
MONTHLY = Params(Decimal("0.95"), 3)
MONTH_A, MONTH_B = "1998-03", "1998-04"


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tx(spark, sf):
    return tx_from_tables(spark, sf)


def _vendor(spark, sf):
    return vendor_from_tables(spark, sf)


def _run(spark, sf, month=None, params=ALL, **kw):
    return infer(_tx(spark, sf), _vendor(spark, sf), month, params, **kw)


ALL_CTES = o.stage_ctes(None, ALL.min_txns, ALL.coverage)
A_CTES = o.stage_ctes(MONTH_A, MONTHLY.min_txns, MONTHLY.coverage)

TX_COLS = 'transaction_id, "timestamp", "BIN", billing_address_country, fraud_label'
COUNT_COLS = '"BIN", country, txn_count, bin_total'
TOP_COLS = COUNT_COLS + ", country_pct, cumulative_pct"
FLAG_COLS = '"BIN", inferred_top_country, vendor_country, is_discrepant, bin_total'

# --------------------------------------------------------------- scans


@query("tx_scan", o.with_(o.BASE) + f"SELECT {TX_COLS} FROM tx")
def q_tx_scan(spark, sf):
    return _tx(spark, sf)


@query("vendor_scan", o.with_(o.BASE) + 'SELECT "BIN", country FROM vendor')
def q_vendor_scan(spark, sf):
    return _vendor(spark, sf)


@query("vendor_read", """SELECT CAST(s_suppkey AS VARCHAR) AS "BIN", CAST(s_nationkey AS VARCHAR) AS country
FROM supplier""")
def q_vendor_read(spark, sf):
    """The vendor reader on a given table, its columns named by parameters."""
    return read_vendor(spark, f"{sf}/supplier.parquet", bin_col="s_suppkey", country_col="s_nationkey")


# ------------------------------------------------------------- filters


@query("filter_fraud", o.with_(o.BASE) + f"SELECT {TX_COLS} FROM tx WHERE fraud_label = FALSE")
def q_filter_fraud(spark, sf):
    return ops.filter_fraud(_tx(spark, sf))


@query("filter_null_country", o.with_(o.BASE)
       + f"SELECT {TX_COLS} FROM tx WHERE billing_address_country IS NOT NULL")
def q_filter_null_country(spark, sf):
    return ops.filter_null_country(_tx(spark, sf))


@query("filter_bin_length", o.with_(o.BASE)
       + f'SELECT {TX_COLS} FROM tx WHERE length("BIN") BETWEEN 6 AND 8')
def q_filter_bin_length(spark, sf):
    return ops.filter_bin_length(_tx(spark, sf))


@query("load_filtered", o.with_(o.BASE, ALL_CTES) + f"SELECT {TX_COLS} FROM clean")
def q_load_filtered(spark, sf):
    return ops.load_filtered(_tx(spark, sf))


@query("load_filtered_month", o.with_(o.BASE, A_CTES) + f"SELECT {TX_COLS} FROM clean")
def q_load_filtered_month(spark, sf):
    return ops.load_filtered(_tx(spark, sf), MONTH_A)


# -------------------------------------------------------- aggregations


@query("country_counts", o.with_(o.BASE, ALL_CTES) + f"SELECT {COUNT_COLS} FROM counts")
def q_country_counts(spark, sf):
    return _run(spark, sf).counts


@query("country_share", o.with_(o.BASE, ALL_CTES)
       + f"SELECT {COUNT_COLS}, txn_count / CAST(bin_total AS DOUBLE) AS country_pct FROM counts")
def q_country_share(spark, sf):
    return ops.country_share(_run(spark, sf).counts)


@query("cumulative_share", o.with_(o.BASE, ALL_CTES) + f"""
SELECT {COUNT_COLS}, txn_count / CAST(bin_total AS DOUBLE) AS country_pct,
  CAST(sum(txn_count) OVER (PARTITION BY "BIN" {o.RANK} {o.ROWS}) AS BIGINT)
    / CAST(bin_total AS DOUBLE) AS cumulative_pct
FROM counts""")
def q_cumulative_share(spark, sf):
    return ops.cumulative_share(_run(spark, sf).counts)


@query("select_top_countries", o.with_(o.BASE, o.stage_ctes(None, 0, ALL.coverage))
       + f"SELECT {TOP_COLS} FROM top")
def q_select_top_countries(spark, sf):
    counts = _run(spark, sf).counts
    return ops.select_top_countries(counts, ALL.coverage)


@query("filter_supported_bins", o.with_(o.BASE, ALL_CTES) + f"SELECT {TOP_COLS} FROM top")
def q_filter_supported_bins(spark, sf):
    return _run(spark, sf).top_countries


@query("support_flag", o.with_(o.BASE, o.stage_ctes(None, 0, ALL.coverage))
       + f"SELECT {TOP_COLS}, bin_total >= {ALL.min_txns} AS is_supported FROM top")
def q_support_flag(spark, sf):
    counts = _run(spark, sf).counts
    return ops.support_flag(ops.select_top_countries(counts, ALL.coverage), ALL.min_txns)


@query("distinct_support", o.with_(o.BASE, ALL_CTES) + f"""
SELECT "BIN", count(*) AS bin_total, count(DISTINCT transaction_id) AS distinct_txns,
  count(DISTINCT transaction_id) >= {ALL.min_txns} AS is_supported_distinct
FROM clean GROUP BY "BIN" """)
def q_distinct_support(spark, sf):
    return ops.distinct_support(_run(spark, sf).clean, ALL.min_txns)


@query("distinct_bins", o.with_(o.BASE, ALL_CTES) + 'SELECT DISTINCT "BIN" FROM clean')
def q_distinct_bins(spark, sf):
    return ops.distinct_bins(_run(spark, sf).clean)


# ------------------------------------------------- ranking and compare


@query("top1_country", o.with_(o.BASE, ALL_CTES)
       + 'SELECT "BIN", country AS inferred_top_country, bin_total FROM top WHERE rn = 1')
def q_top1_country(spark, sf):
    return ops.top1_country(_run(spark, sf).top_countries)


@query("flag_discrepancies", o.with_(o.BASE, ALL_CTES) + f"SELECT {FLAG_COLS} FROM flags")
def q_flag_discrepancies(spark, sf):
    return _run(spark, sf).flags


@query("discrepant_bins", o.with_(o.BASE, ALL_CTES)
       + f"SELECT {FLAG_COLS} FROM flags WHERE is_discrepant")
def q_discrepant_bins(spark, sf):
    return ops.discrepant_bins(_run(spark, sf).flags)


# ----------------------------------------------------------- reports


@query("report_sorted_counts", o.with_(o.BASE, ALL_CTES) + f"SELECT {COUNT_COLS} FROM counts")
def q_report_sorted_counts(spark, sf):
    return report(_run(spark, sf).counts, "counts")


@query("report_sorted_coverage", o.with_(o.BASE, ALL_CTES) + f"SELECT {TOP_COLS} FROM top")
def q_report_sorted_coverage(spark, sf):
    return report(_run(spark, sf).top_countries, "coverage")


@query("report_sorted_flags", o.with_(o.BASE, ALL_CTES) + f"SELECT {FLAG_COLS} FROM flags")
def q_report_sorted_flags(spark, sf):
    return report(_run(spark, sf).flags, "flags")


# ------------------------------------------------- load accounting, formats

REASON_SQL = """CASE WHEN "timestamp" IS NULL THEN 'null_timestamp' WHEN fraud_label IS NULL THEN 'null_label' WHEN fraud_label THEN 'fraud'
  WHEN billing_address_country IS NULL THEN 'null_country'
  WHEN NOT coalesce(length("BIN") BETWEEN 6 AND 8, FALSE) THEN 'bad_bin_length'
  ELSE 'kept' END"""


@query("filter_reject_reasons", o.with_(o.BASE)
       + f"SELECT {REASON_SQL} AS reason, count(*) AS n_rows FROM tx GROUP BY ALL")
def q_filter_reject_reasons(spark, sf):
    return ops.reject_reasons(_tx(spark, sf), monthly=True)


@query("load_filtered_strict", o.with_(o.BASE) + f"""SELECT {TX_COLS} FROM tx
WHERE fraud_label = FALSE AND billing_address_country IS NOT NULL AND length("BIN") BETWEEN 6 AND 8
  AND regexp_matches("BIN", '^[0-9]{{6,8}}$') AND regexp_matches(billing_address_country, '^[A-Z]{{2}}$')""")
def q_load_filtered_strict(spark, sf):
    return ops.load_filtered(_tx(spark, sf), strict=True)


@query("strict_bin_rejects", o.with_(o.BASE) + """SELECT "BIN", count(*) AS n_rows FROM tx
WHERE NOT coalesce(regexp_matches("BIN", '^[0-9]{6,8}$'), FALSE) GROUP BY "BIN" """)
def q_strict_bin_rejects(spark, sf):
    return ops.strict_bin_rejects(_tx(spark, sf))


@query("strict_vendor_rejects", o.with_(o.BASE) + """SELECT "BIN", country FROM vendor
WHERE country IS NOT NULL AND NOT regexp_matches(country, '^[A-Z]{2}$')""")
def q_strict_vendor_rejects(spark, sf):
    return ops.strict_country_rejects(_vendor(spark, sf))


# ----------------------------------------------------------- vendor side

VDUP = o.BASE + [o.VENDOR_DUP_CTE]


@query("vendor_dedup", o.with_(VDUP)
       + 'SELECT "BIN", min(country) AS country FROM vendor_dup GROUP BY "BIN"')
def q_vendor_dedup(spark, sf):
    return ops.vendor_dedup(vendor_dup_from_tables(spark, sf))


@query("vendor_conflicts", o.with_(VDUP) + """SELECT "BIN", count(*) AS n_rows,
  count(DISTINCT country) AS n_countries, min(country) AS min_country, max(country) AS max_country
FROM vendor_dup GROUP BY "BIN" HAVING count(DISTINCT country) > 1""")
def q_vendor_conflicts(spark, sf):
    return ops.vendor_conflicts(vendor_dup_from_tables(spark, sf))


@query("flag_discrepancies_vendor_dup",
       o.with_(VDUP, o.stage_ctes(None, ALL.min_txns, ALL.coverage, vendor="vendor_dup"))
       + f"SELECT {FLAG_COLS} FROM flags")
def q_flag_discrepancies_vendor_dup(spark, sf):
    r = _run(spark, sf)
    return ops.flag_discrepancies(r.top_countries, vendor_dup_from_tables(spark, sf))


@query("flag_discrepancies_unguarded",
       o.with_(VDUP, o.stage_ctes(None, ALL.min_txns, ALL.coverage, vendor="vendor_dup",
                                  dedup=False))
       + f"SELECT {FLAG_COLS} FROM flags")
def q_flag_discrepancies_unguarded(spark, sf):
    r = _run(spark, sf)
    return ops.flag_discrepancies(r.top_countries, vendor_dup_from_tables(spark, sf), dedup=False)


SEVERITY_SQL = f"""j AS (SELECT s.*, v.vendor_country FROM supported s LEFT JOIN vend v ON s."BIN" = v."BIN"),
r AS (SELECT *, row_number() OVER (PARTITION BY "BIN" {o.RANK}) AS rn2,
        CAST(sum(txn_count) OVER (PARTITION BY "BIN" {o.RANK} {o.ROWS}) AS BIGINT) AS cum2 FROM j),
a AS (SELECT "BIN", max(CASE WHEN rn2 = 1 THEN country END) AS inferred_top_country,
        max(vendor_country) AS vendor_country, max(bin_total) AS bin_total,
        max(CASE WHEN rn2 = 1 THEN txn_count END) AS top_country_txns,
        CAST(sum(CASE WHEN country = vendor_country THEN txn_count ELSE 0 END) AS BIGINT) AS vendor_country_txns,
        max(CASE WHEN country = vendor_country
                  AND {o.coverage_pred('cum2 - txn_count', 'bin_total', ALL.coverage)} THEN 1 ELSE 0 END) AS vk
      FROM r GROUP BY "BIN")
SELECT "BIN", inferred_top_country, vendor_country,
  coalesce(inferred_top_country <> vendor_country, FALSE) AS is_discrepant, bin_total,
  top_country_txns, top_country_txns / CAST(bin_total AS DOUBLE) AS top_country_pct,
  vendor_country_txns, vendor_country_txns / CAST(bin_total AS DOUBLE) AS vendor_country_pct,
  vk = 1 AS vendor_in_top,
  coalesce(inferred_top_country <> vendor_country, FALSE) AND vk = 0 AS is_significant
FROM a"""


@query("discrepancy_severity", o.with_(o.BASE, ALL_CTES, [SEVERITY_SQL.split("\nSELECT")[0]])
       + "SELECT" + SEVERITY_SQL.split("\nSELECT", 1)[1])
def q_discrepancy_severity(spark, sf):
    r = _run(spark, sf)
    return ops.discrepancy_severity(r.supported, _vendor(spark, sf), ALL.coverage)


# ---------------------------------------------------------------- metrics

ALL0 = o.stage_ctes(None, 0, ALL.coverage, prefix="all_")

METRIC_SQL = f"""
SELECT 'load' AS stage, 'rows_in' AS metric, count(*) AS value FROM tx
UNION ALL SELECT 'load', 'rows_out', count(*) FROM clean
UNION ALL SELECT 'aggregate', 'rows_in', CAST(sum(txn_count) AS BIGINT) FROM counts
UNION ALL SELECT 'aggregate', 'rows_out', count(*) FROM counts
UNION ALL SELECT 'coverage', 'rows_in', count(*) FROM counts
UNION ALL SELECT 'coverage', 'rows_out', count(*) FROM all_top
UNION ALL SELECT 'support', 'rows_in', count(*) FROM all_top
UNION ALL SELECT 'support', 'rows_out', count(*) FROM top
UNION ALL SELECT 'support', 'bins_in', count(DISTINCT "BIN") FROM counts
UNION ALL SELECT 'support', 'bins_out', count(DISTINCT "BIN") FROM supported
UNION ALL SELECT 'compare', 'rows_out', count(*) FROM flags
UNION ALL SELECT 'compare', 'discrepant', count(*) FILTER (WHERE is_discrepant) FROM flags
UNION ALL SELECT 'compare', 'vendor_missing', count(*) FILTER (WHERE vendor_country IS NULL) FROM flags
UNION ALL SELECT 'compare', 'vendor_rows', count(*) FROM vendor"""


@query("stage_metrics", o.with_(o.BASE, ALL_CTES, ALL0) + METRIC_SQL)
def q_stage_metrics(spark, sf):
    return ops.stage_metrics(_tx(spark, sf), _vendor(spark, sf), None,
                             ALL.coverage, ALL.min_txns)


@query("support_metrics", o.with_(o.BASE, ALL_CTES, ALL0)
       + "SELECT * FROM (" + METRIC_SQL + ") WHERE stage = 'support'")
def q_support_metrics(spark, sf):
    return ops.support_metrics(_run(spark, sf).counts, ALL.coverage, ALL.min_txns)


@query("discrepancy_metrics", o.with_(o.BASE, ALL_CTES, ALL0)
       + "SELECT * FROM (" + METRIC_SQL + ") WHERE stage = 'compare'")
def q_discrepancy_metrics(spark, sf):
    return ops.discrepancy_metrics(_run(spark, sf).flags, _vendor(spark, sf))


# ------------------------------------------------------ count-level checks

PLANTED_COUNTS = """counts_planted AS (SELECT * FROM counts
  UNION ALL SELECT * FROM counts WHERE "BIN" LIKE '40%3%')"""


def _counts_planted(spark, sf):
    counts = _run(spark, sf).counts
    return counts.unionByName(counts.where(F.col("BIN").like("40%3%")))


@query("dq_total_matches", o.with_(o.BASE, ALL_CTES, [PLANTED_COUNTS]) + """
SELECT "BIN", CAST(sum(txn_count) AS BIGINT) AS sum_txn_count, min(bin_total) AS min_bin_total,
  max(bin_total) AS max_bin_total
FROM counts_planted GROUP BY "BIN"
HAVING sum(txn_count) <> max(bin_total) OR min(bin_total) <> max(bin_total)""")
def q_dq_total_matches(spark, sf):
    return ops.dq_total_matches(_counts_planted(spark, sf))


@query("dq_unique_bin_country", o.with_(o.BASE, ALL_CTES, [PLANTED_COUNTS]) + """
SELECT "BIN", country, count(*) AS n_rows FROM counts_planted GROUP BY "BIN", country
HAVING count(*) > 1""")
def q_dq_unique_bin_country(spark, sf):
    return ops.dq_unique_bin_country(_counts_planted(spark, sf))


def _coverage_check_sql(map_coverage):
    ctes = o.stage_ctes(None, ALL.min_txns, map_coverage)
    cov = ALL.coverage
    return o.with_(o.BASE, ctes) + f"""
SELECT "BIN", kept_txns, bin_total, n_countries, kept_txns / CAST(bin_total AS DOUBLE) AS kept_pct,
  CASE WHEN NOT ({o.coverage_pred('kept_txns', 'bin_total', cov)}) THEN NULL
       ELSE 'not_reached' END AS reason
FROM (SELECT "BIN", CAST(sum(txn_count) AS BIGINT) AS kept_txns, min(txn_count) AS last_txns,
        max(bin_total) AS bin_total, count(*) AS n_countries FROM top GROUP BY "BIN") a
WHERE {o.coverage_pred('kept_txns', 'bin_total', cov)}
UNION ALL
SELECT "BIN", kept_txns, bin_total, n_countries, kept_txns / CAST(bin_total AS DOUBLE) AS kept_pct,
  'not_minimal' AS reason
FROM (SELECT "BIN", CAST(sum(txn_count) AS BIGINT) AS kept_txns, min(txn_count) AS last_txns,
        max(bin_total) AS bin_total, count(*) AS n_countries FROM top GROUP BY "BIN") a
WHERE NOT ({o.coverage_pred('kept_txns', 'bin_total', cov)})
  AND NOT ({o.coverage_pred('kept_txns - last_txns', 'bin_total', cov)})"""


@query("dq_coverage_reached", _coverage_check_sql(Decimal("0.8")))
def q_dq_coverage_reached(spark, sf):
    top = _run(spark, sf, params=Params(Decimal("0.8"), ALL.min_txns)).top_countries
    return ops.dq_coverage_reached(top, ALL.coverage)


@query("dq_coverage_minimal", _coverage_check_sql(Decimal("1")))
def q_dq_coverage_minimal(spark, sf):
    top = _run(spark, sf, params=Params(Decimal("1"), ALL.min_txns)).top_countries
    return ops.dq_coverage_reached(top, ALL.coverage)


@query("empty_input_month", o.with_(o.BASE, o.stage_ctes("1990-01", 3, ALL.coverage))
       + f"SELECT {FLAG_COLS} FROM flags")
def q_empty_input_month(spark, sf):
    """A month without transactions: every stage yields typed empty output."""
    return _run(spark, sf, "1990-01", MONTHLY).flags


# ------------------------------------------------------------- snapshots
#
# Each query publishes runs into a fresh table under the shared
# spark.checkpoint.dir and returns what a reader sees afterwards.


MONTH_C = "1998-05"
RERUN = Params(Decimal("0.95"), 5)
NONE_KEPT = Params(Decimal("0.95"), 10 ** 12)


def _table(spark, name, versioned=True) -> SnapshotTable:
    return SnapshotTable(shared_dir(spark, "cardgeo", "queries", name), versioned=versioned)


def _flags(spark, sf, month, params=MONTHLY, vendor=None, dedup=True):
    tx = _tx(spark, sf)
    v = vendor if vendor is not None else _vendor(spark, sf)
    r = infer(tx, v, month, params)
    return r.flags if dedup else ops.flag_discrepancies(r.top_countries, v, dedup=False)


A5_CTES = o.stage_ctes(MONTH_A, RERUN.min_txns, RERUN.coverage, prefix="a5_")
AB_CTES = (o.stage_ctes(MONTH_A, MONTHLY.min_txns, MONTHLY.coverage, prefix="a_")
           + o.stage_ctes(MONTH_B, MONTHLY.min_txns, MONTHLY.coverage, prefix="b_"))


def _snap_sql(prefix, month, extra=""):
    return f"SELECT {FLAG_COLS}{extra}, '{month}' AS snapshot_month FROM {prefix}flags"


SNAP_AB = _snap_sql("a_", MONTH_A) + "\nUNION ALL " + _snap_sql("b_", MONTH_B)


def _publish_ab(spark, sf, t: SnapshotTable):
    """Months A and B computed in one scan and published in one job."""
    flags = infer(_tx(spark, sf), _vendor(spark, sf), [MONTH_A, MONTH_B], MONTHLY,
                  by=("snapshot_month",)).flags
    return t.write_months(flags, [MONTH_A, MONTH_B])


@query("snapshot_two_months", o.with_(o.BASE, AB_CTES) + SNAP_AB)
def q_snapshot_two_months(spark, sf):
    t = _table(spark, "two_months")
    _publish_ab(spark, sf, t)
    return t.read(spark)


@query("snapshot_two_runs", o.with_(o.BASE, AB_CTES) + SNAP_AB)
def q_snapshot_two_runs(spark, sf):
    """One month per run: creates the table, then adds a month."""
    t = _table(spark, "two_runs")
    t.write(_flags(spark, sf, MONTH_A), MONTH_A)
    t.write(_flags(spark, sf, MONTH_B), MONTH_B)
    return t.read(spark)


@query("snapshot_read_month", o.with_(o.BASE, AB_CTES) + _snap_sql("a_", MONTH_A))
def q_snapshot_read_month(spark, sf):
    t = _table(spark, "read_month")
    _publish_ab(spark, sf, t)
    return t.read_month(spark, MONTH_A)


@query("snapshot_read_all",
       o.with_(o.BASE, o.stage_ctes(None, MONTHLY.min_txns, MONTHLY.coverage, by="snapshot_month"))
       + f"SELECT {FLAG_COLS}, snapshot_month FROM flags")
def q_snapshot_read_all(spark, sf):
    """Backfill: every month of history computed and published in one job."""
    t = _table(spark, "read_all")
    flags = infer(_tx(spark, sf), _vendor(spark, sf), None, MONTHLY, by=("snapshot_month",)).flags
    t.write_months(flags)
    return t.read(spark)


def _rerun_sequence(spark, sf, t: SnapshotTable):
    first = t.write(_flags(spark, sf, MONTH_A), MONTH_A)
    second = t.write(_flags(spark, sf, MONTH_B), MONTH_B)
    t.write(_flags(spark, sf, MONTH_A, RERUN), MONTH_A)
    return first, second


SNAP_RERUN = (o.with_(o.BASE, AB_CTES, A5_CTES)
              + _snap_sql("a5_", MONTH_A) + "\nUNION ALL " + _snap_sql("b_", MONTH_B))


@query("snapshot_overwrite_month", SNAP_RERUN)
def q_snapshot_overwrite_month(spark, sf):
    """Dynamic partition overwrite (no history): the re-run replaces A."""
    t = _table(spark, "overwrite", versioned=False)
    _rerun_sequence(spark, sf, t)
    return t.read(spark)


@query("snapshot_latest", SNAP_RERUN)
def q_snapshot_latest(spark, sf):
    t = _table(spark, "latest")
    _rerun_sequence(spark, sf, t)
    return t.read(spark)


@query("snapshot_as_of", o.with_(o.BASE, AB_CTES) + SNAP_AB)
def q_snapshot_as_of(spark, sf):
    """Read as of the second run: A's later re-run is not visible."""
    t = _table(spark, "as_of")
    _, second = _rerun_sequence(spark, sf, t)
    return t.read(spark, as_of_run=second.run_id)


@query("snapshot_rerun_same_run", o.with_(o.BASE, A5_CTES) + _snap_sql("a5_", MONTH_A))
def q_snapshot_rerun_same_run(spark, sf):
    """A run repeated under its own id replaces what it wrote before."""
    t = _table(spark, "same_run")
    t.write(_flags(spark, sf, MONTH_A), MONTH_A, run_id="scheduled")
    t.write(_flags(spark, sf, MONTH_A, RERUN), MONTH_A, run_id="scheduled")
    return t.read(spark)


@query("snapshot_as_of_late_commit", o.with_(o.BASE, A5_CTES) + _snap_sql("a5_", MONTH_A))
def q_snapshot_as_of_late_commit(spark, sf):
    """A run that started first but commits last is not visible as of a run
    that committed before it."""
    t = _table(spark, "late_commit")
    early = t.stage(_flags(spark, sf, MONTH_A), MONTH_A, run_id="a-started-first")
    t.write(_flags(spark, sf, MONTH_A, RERUN), MONTH_A, run_id="b-committed-first")
    t.commit(early)
    return t.read(spark, as_of_run="b-committed-first")


@query("snapshot_sql_filter", o.with_(o.BASE, AB_CTES)
       + f"SELECT * FROM ({SNAP_AB}) WHERE is_discrepant AND bin_total >= 5 AND snapshot_month = '{MONTH_A}'")
def q_snapshot_sql_filter(spark, sf):
    """A filter given as SQL text on a stored snapshot."""
    t = _table(spark, "sql_filter")
    _publish_ab(spark, sf, t)
    return t.read(spark).where(f"is_discrepant AND bin_total >= 5 AND snapshot_month = '{MONTH_A}'")


@query("snapshot_empty_month", o.with_(o.BASE, AB_CTES) + _snap_sql("a_", MONTH_A))
def q_snapshot_empty_month(spark, sf):
    """B re-run with no surviving BIN: B reads empty, A is untouched."""
    t = _table(spark, "empty_month")
    _publish_ab(spark, sf, t)
    t.write(_flags(spark, sf, MONTH_B, NONE_KEPT), MONTH_B)
    return t.read(spark)


@query("snapshot_schema_evolution", o.with_(o.BASE, AB_CTES)
       + _snap_sql("a_", MONTH_A, ", CAST(bin_total % 7 AS INTEGER) AS new_col")
       + "\nUNION ALL " + _snap_sql("b_", MONTH_B, ", CAST(NULL AS INTEGER) AS new_col"))
def q_snapshot_schema_evolution(spark, sf):
    """A gains ``new_col``; B is written without it and reads null."""
    t = _table(spark, "schema_evolution")
    a = _flags(spark, sf, MONTH_A).withColumn("new_col", (F.col("bin_total") % 7).cast("int"))
    t.write(a, MONTH_A)
    t.write(_flags(spark, sf, MONTH_B), MONTH_B)
    return t.read(spark)


@query("top_country_map", o.with_(o.BASE, AB_CTES)
       + f"SELECT {TOP_COLS}, '{MONTH_A}' AS snapshot_month FROM a_top")
def q_top_country_map(spark, sf):
    """The kept top-N countries per BIN, published next to the flags."""
    flags_t, map_t = _table(spark, "publish_flags"), _table(spark, "publish_map")
    publish_month(_tx(spark, sf), _vendor(spark, sf), MONTH_A, flags_table=flags_t,
                  map_table=map_t, params=MONTHLY)
    return map_t.read(spark)


@query("publish_month", o.with_(o.BASE, AB_CTES) + _snap_sql("a_", MONTH_A))
def q_publish_month(spark, sf):
    """Gated monthly publication (one scan, staged map, checked flags)."""
    flags_t, map_t = _table(spark, "publish_flags"), _table(spark, "publish_map")
    publish_month(_tx(spark, sf), _vendor(spark, sf), MONTH_A, flags_table=flags_t,
                  map_table=map_t, params=MONTHLY)
    return flags_t.read(spark)


@query("publish_months", o.with_(o.BASE, AB_CTES) + SNAP_AB)
def q_publish_months(spark, sf):
    """Reprocessing of two months end to end from one scan, one run id."""
    flags_t, map_t = _table(spark, "publish_flags"), _table(spark, "publish_map")
    publish_months(_tx(spark, sf), _vendor(spark, sf), [MONTH_A, MONTH_B],
                   flags_table=flags_t, map_table=map_t, params=MONTHLY)
    return flags_t.read(spark)


DRIFT_SQL = """
SELECT coalesce(p."BIN", c."BIN") AS "BIN", p.inferred_top_country AS prev_country,
  c.inferred_top_country AS curr_country, p.bin_total AS prev_bin_total,
  c.bin_total AS curr_bin_total, c.bin_total - p.bin_total AS volume_change,
  CASE WHEN p."BIN" IS NULL THEN 'added' WHEN c."BIN" IS NULL THEN 'removed'
       WHEN p.inferred_top_country IS NOT DISTINCT FROM c.inferred_top_country THEN 'same'
       ELSE 'country_changed' END AS change
FROM a_flags p FULL OUTER JOIN b_flags c ON p."BIN" = c."BIN" """


@query("snapshot_drift", o.with_(o.BASE, AB_CTES) + DRIFT_SQL)
def q_snapshot_drift(spark, sf):
    t = _table(spark, "drift")
    _publish_ab(spark, sf, t)
    return ops.snapshot_drift(t.read_month(spark, MONTH_A), t.read_month(spark, MONTH_B))


EVERY_CTES = o.stage_ctes(None, MONTHLY.min_txns, MONTHLY.coverage, by="snapshot_month", prefix="m_")
NEXT_MONTH = "strftime(CAST(concat(snapshot_month, '-01') AS DATE) + INTERVAL 1 MONTH, '%Y-%m')"


@query("drift_summary", o.with_(o.BASE, EVERY_CTES, [
    'cur AS (SELECT snapshot_month AS m, "BIN", inferred_top_country AS c FROM m_flags)',
    f'prv AS (SELECT {NEXT_MONTH} AS m, "BIN", inferred_top_country AS p FROM m_flags)',
    "has AS (SELECT DISTINCT m FROM cur INTERSECT SELECT DISTINCT m FROM prv)"]) + """
SELECT coalesce(cur.m, prv.m) AS snapshot_month,
  CASE WHEN prv.m IS NULL THEN 'added' WHEN cur.m IS NULL THEN 'removed'
       WHEN p IS NOT DISTINCT FROM c THEN 'same' ELSE 'country_changed' END AS change,
  count(*) AS n_bins
FROM cur FULL OUTER JOIN prv ON cur.m = prv.m AND cur."BIN" = prv."BIN"
WHERE coalesce(cur.m, prv.m) IN (SELECT m FROM has) GROUP BY ALL""")
def q_drift_summary(spark, sf):
    """Per-month drift counts over all history (one pass, one join)."""
    return ops.drift_summary(
        infer(_tx(spark, sf), _vendor(spark, sf), None, MONTHLY, by=("snapshot_month",)).flags)


# ------------------------------------------------- checks on a snapshot
#
# The checked table: every month of history, published in one pass by the
# unguarded join against the duplicated vendor mapping (so BINs repeat), with
# defects that depend on each row's bin_total, and without one month.

EMPTY_MONTH = "1995-06"
DEFECTS = {
    "BIN": """CASE WHEN bin_total % 13 = 0 THEN NULL WHEN bin_total % 11 = 0 THEN substr("BIN", 1, 4)
      WHEN bin_total % 10 = 0 THEN concat("BIN", "BIN") ELSE "BIN" END""",
    "inferred_top_country": """CASE WHEN bin_total % 17 = 0 THEN NULL
      WHEN bin_total % 7 = 0 THEN substr(inferred_top_country, 1, 1) ELSE inferred_top_country END""",
    "vendor_country": """CASE WHEN bin_total % 9 = 0 AND vendor_country IS NOT NULL
      THEN concat(vendor_country, 'X') ELSE vendor_country END""",
}

DQ_CTES = (VDUP
           + o.stage_ctes(None, MONTHLY.min_txns, MONTHLY.coverage, by="snapshot_month", prefix="m_",
                          vendor="vendor_dup", dedup=False)
           + ["snap AS (SELECT " + ", ".join(f'{sql} AS "{c}"' for c, sql in DEFECTS.items())
              + f", is_discrepant, bin_total, snapshot_month FROM m_flags WHERE snapshot_month <> '{EMPTY_MONTH}')"])


def _dq_snapshot(spark, sf):
    t = _table(spark, "dq")
    vdup = vendor_dup_from_tables(spark, sf)
    r = infer(_tx(spark, sf), vdup, None, MONTHLY, by=("snapshot_month",))
    flags = ops.flag_discrepancies(r.top_countries, vdup, by=("snapshot_month",), dedup=False)
    bad = flags.withColumns({c: F.expr(sql.replace('"BIN"', "BIN")) for c, sql in DEFECTS.items()})
    t.write_months(bad.where(F.col("snapshot_month") != EMPTY_MONTH))
    return t.read(spark)


@query("dq_nulls", o.with_(DQ_CTES) + """
SELECT column_name, null_count FROM (
  SELECT 'BIN' AS column_name, count(*) FILTER (WHERE "BIN" IS NULL) AS null_count FROM snap
  UNION ALL SELECT 'inferred_top_country', count(*) FILTER (WHERE inferred_top_country IS NULL) FROM snap
  UNION ALL SELECT 'is_discrepant', count(*) FILTER (WHERE is_discrepant IS NULL) FROM snap
  UNION ALL SELECT 'snapshot_month', count(*) FILTER (WHERE snapshot_month IS NULL) FROM snap)
WHERE null_count > 0""")
def q_dq_nulls(spark, sf):
    return ops.dq_nulls(_dq_snapshot(spark, sf))


@query("dq_unique_bin", o.with_(DQ_CTES) + """
SELECT snapshot_month, "BIN", count(*) AS n_rows FROM snap WHERE "BIN" IS NOT NULL
GROUP BY snapshot_month, "BIN" HAVING count(*) > 1""")
def q_dq_unique_bin(spark, sf):
    return ops.dq_unique_bin(_dq_snapshot(spark, sf))


@query("dq_country_code", o.with_(DQ_CTES) + """
SELECT snapshot_month, "BIN", inferred_top_country, vendor_country,
  CASE WHEN inferred_top_country IS NOT NULL AND length(inferred_top_country) <> 2
         THEN 'bad_inferred_country'
       ELSE 'bad_vendor_country' END AS reason
FROM snap
WHERE (inferred_top_country IS NOT NULL AND length(inferred_top_country) <> 2)
   OR (vendor_country IS NOT NULL AND length(vendor_country) <> 2)""")
def q_dq_country_code(spark, sf):
    return ops.dq_country_code(_dq_snapshot(spark, sf))


@query("dq_bin_length", o.with_(DQ_CTES) + """
SELECT snapshot_month, "BIN", CAST(length("BIN") AS INTEGER) AS bin_length FROM snap
WHERE "BIN" IS NOT NULL AND NOT (length("BIN") BETWEEN 6 AND 8)""")
def q_dq_bin_length(spark, sf):
    return ops.dq_bin_length(_dq_snapshot(spark, sf))


@query("dq_snapshot_month", o.with_(DQ_CTES) + """
SELECT snapshot_month, count(*) AS n_rows,
  coalesce(regexp_matches(snapshot_month, '^[0-9]{4}-(0[1-9]|1[0-2])$'), FALSE) AS is_valid
FROM snap GROUP BY snapshot_month""")
def q_dq_snapshot_month(spark, sf):
    return ops.dq_snapshot_month(_dq_snapshot(spark, sf))


@query("dq_row_count", o.with_(DQ_CTES, [
    "per AS (SELECT snapshot_month, count(*) AS n FROM snap GROUP BY snapshot_month)",
    """every AS (SELECT strftime(unnest(generate_series(
      CAST(concat(min(snapshot_month), '-01') AS DATE), CAST(concat(max(snapshot_month), '-01') AS DATE),
      INTERVAL 1 MONTH)), '%Y-%m') AS snapshot_month FROM per)""",
    "filled AS (SELECT snapshot_month, coalesce(n, 0) AS n_rows FROM every LEFT JOIN per USING (snapshot_month))",
    """lagged AS (SELECT *, lag(n_rows) OVER (ORDER BY snapshot_month) AS prev_n_rows FROM filled)""",
    """rated AS (SELECT *, CASE WHEN prev_n_rows > 0 THEN n_rows / CAST(prev_n_rows AS DOUBLE) END AS ratio
      FROM lagged)"""]) + """
SELECT snapshot_month, n_rows, prev_n_rows, ratio,
  n_rows = 0 OR coalesce(ratio < 0.5 OR ratio > 2.0, FALSE) AS is_anomalous FROM rated""")
def q_dq_row_count(spark, sf):
    return ops.dq_row_count(_dq_snapshot(spark, sf))


# ------------------------------------------------------------- streaming


def _stream_all(spark, sf, **kw) -> str:
    """The line items as a file stream, joined with the dimension tables in
    each batch and folded into partial counts. Returns the counts' path."""
    root = shared_dir(spark, "cardgeo", "queries", "stream")
    # A file stream takes the path of a single file only as a pattern.
    q = start_count_stream(spark, f"{sf}/lineitem.parque[t]", f"{root}/partials", f"{root}/_checkpoint",
                           schema=read_transactions(spark, f"{sf}/lineitem.parquet").schema,
                           transform=lambda li: tx_from_tables(spark, sf, li), **kw)
    q.awaitTermination()
    return f"{root}/partials"


@query("stream_country_counts", o.with_(o.BASE, EVERY_CTES) + f"SELECT snapshot_month, {COUNT_COLS} FROM m_counts")
def q_stream_country_counts(spark, sf):
    """Counts of every month from the stream's partial counts."""
    return counts_from_partials(spark, _stream_all(spark, sf))


@query("stream_publish_months", o.with_(o.BASE, AB_CTES) + SNAP_AB)
def q_stream_publish_months(spark, sf):
    """Months A and B published from the stream's partial counts."""
    flags_t, map_t = _table(spark, "stream_flags"), _table(spark, "stream_map")
    publish_months_from_counts(read_partials(spark, _stream_all(spark, sf)), _vendor(spark, sf),
                               [MONTH_A, MONTH_B], flags_table=flags_t, map_table=map_t,
                               params=MONTHLY)
    return flags_t.read(spark)


from . import audit_queries  # noqa: E402, F401  (registers its own queries)

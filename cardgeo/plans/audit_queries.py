"""Registered queries on code lists, distinct ids, attempts, change feeds and
anomalies (registered with the others in ``queries.py``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as ops
from ..functions import month_index
from ..sinks import BucketedTable, shared_dir
from ..sources import vendor_from_tables
from ..sources.adapters import nation_code
from ..sources.transactions import read_transactions
from ..streaming import read_partials
from . import oracle as o
from . import queries as q
from .inference import infer
from .publish import DataQualityError, publish_months, publish_months_from_counts

query = q.query
BY_MONTH = ("snapshot_month",)


# ------------------------------------------------------------- code lists

CODES_CTE = f"codes AS (SELECT {o.code_sql('n_nationkey')} AS code FROM nation WHERE n_nationkey % 5 <> 3)"
KNOWN = "IN (SELECT code FROM codes)"


def _codes(spark, sf):
    """A list of country codes: those of four nations in five."""
    nation = read_transactions(spark, f"{sf.rstrip('/')}/nation.parquet")
    return nation.where(F.col("n_nationkey") % 5 != 3).select(nation_code(F.col("n_nationkey")).alias("code"))


@query("load_filtered_known", o.with_(o.BASE, [CODES_CTE], q.ALL_CTES)
       + f"SELECT {q.TX_COLS} FROM clean WHERE billing_address_country {KNOWN}")
def q_load_filtered_known(spark, sf):
    """Clean transactions whose country is in the list."""
    return ops.load_filtered(q._tx(spark, sf), codes=_codes(spark, sf))


@query("unknown_country_rejects", o.with_(o.BASE, [CODES_CTE]) + f"""
SELECT billing_address_country AS country, count(*) AS n_rows FROM tx
WHERE billing_address_country IS NOT NULL AND billing_address_country NOT {KNOWN} GROUP BY ALL""")
def q_unknown_country_rejects(spark, sf):
    return ops.unknown_codes(q._tx(spark, sf), _codes(spark, sf))


@query("filter_reject_reasons_known", o.with_(o.BASE, [CODES_CTE], [f"r AS (SELECT {q.REASON_SQL} AS reason, * FROM tx)"]) + f"""
SELECT CASE WHEN reason = 'kept' AND billing_address_country NOT {KNOWN} THEN 'unknown_country' ELSE reason END AS reason,
  count(*) AS n_rows FROM r GROUP BY ALL""")
def q_filter_reject_reasons_known(spark, sf):
    """Reject reasons with the list: rows are counted by country, then judged."""
    return ops.reject_reasons(q._tx(spark, sf), monthly=True, codes=_codes(spark, sf))


@query("dq_country_known", o.with_(q.DQ_CTES, [CODES_CTE]) + f"""
SELECT * FROM (SELECT snapshot_month, "BIN", inferred_top_country, vendor_country,
  CASE WHEN inferred_top_country IS NOT NULL AND length(inferred_top_country) <> 2 THEN 'bad_inferred_country'
       WHEN vendor_country IS NOT NULL AND length(vendor_country) <> 2 THEN 'bad_vendor_country'
       WHEN inferred_top_country IS NOT NULL AND inferred_top_country NOT {KNOWN} THEN 'unknown_inferred_country'
       WHEN vendor_country IS NOT NULL AND vendor_country NOT {KNOWN} THEN 'unknown_vendor_country' END AS reason
FROM snap) WHERE reason IS NOT NULL""")
def q_dq_country_known(spark, sf):
    return ops.dq_country_code(q._dq_snapshot(spark, sf), codes=_codes(spark, sf))


KNOWN_BASE = [o.TX_CTE.replace("tx AS (", "tx_all AS (", 1), CODES_CTE,
              f"tx AS (SELECT * FROM tx_all WHERE billing_address_country {KNOWN})", o.VENDOR_CTE,
              f"vendor_known AS (SELECT * FROM vendor WHERE country {KNOWN})"]


@query("publish_known_countries", o.with_(KNOWN_BASE, o.stage_ctes(
    None, q.MONTHLY.min_txns, q.MONTHLY.coverage, by="snapshot_month", prefix="m_", vendor="vendor_known"))
    + f"SELECT {q.FLAG_COLS}, snapshot_month FROM m_flags")
def q_publish_known_countries(spark, sf):
    """Every month published, countries outside the list rejected while
    loading, the vendor's taken out before."""
    flags_t, map_t = q._table(spark, "known_flags"), q._table(spark, "known_map")
    codes = _codes(spark, sf)
    vendor = ops.known_codes(q._vendor(spark, sf), codes, "country")
    tx = q._tx(spark, sf)
    publish_months(tx, vendor, None, flags_table=flags_t, map_table=map_t, params=q.MONTHLY,
                   codes=codes, row_bounds=None)
    return flags_t.read(spark)


# ------------------------------------------------- distinct ids by sketches

LG_K = 12
#: Five standard errors of a sketch of 2^12 buckets.
BOUND = 5 * 1.04 / 2 ** (LG_K / 2)


@query("distinct_support_sketched", o.with_(o.BASE, q.ALL_CTES) + """
SELECT "BIN", count(*) AS bin_total, count(DISTINCT transaction_id) AS distinct_txns, TRUE AS within_bound
FROM clean GROUP BY "BIN" """)
def q_distinct_support_sketched(spark, sf):
    """Distinct ids per BIN of all history from mergeable sketches (one per
    month, BIN and country, merged), held against the exact count."""
    tx = q._tx(spark, sf)
    partials = ops.reason_counts(tx, by=BY_MONTH, lg_k=LG_K).where("reason IN ('kept', 'null_timestamp')")
    # Rows without a timestamp are in no month; the exact side counts those of the months.
    sketched = ops.distinct_support_from_partials(
        ops.reason_counts(tx, lg_k=LG_K).where("reason = 'kept'"), q.ALL.min_txns)
    by_months = ops.distinct_support_from_partials(partials, 0).select(
        "BIN", F.col("bin_total").alias("m_total"), F.col("distinct_txns").alias("m_ids"))
    exact = ops.distinct_support(ops.load_filtered(tx), q.ALL.min_txns)
    near = F.abs(F.col("s_ids") - F.col("distinct_txns")) <= F.col("distinct_txns") * BOUND
    merged = F.coalesce(F.col("m_ids"), F.lit(0)) <= F.col("s_ids") * (1 + 2 * BOUND)
    return (exact.join(sketched.select("BIN", F.col("distinct_txns").alias("s_ids")), "BIN").join(by_months, "BIN", "left")
            .select("BIN", "bin_total", "distinct_txns", (near & merged).alias("within_bound")))


@query("stream_distinct_support", o.with_(o.BASE, q.EVERY_CTES) + f"""
SELECT snapshot_month, "BIN", count(*) AS bin_total, count(DISTINCT transaction_id) AS distinct_txns,
  count(DISTINCT transaction_id) >= {q.MONTHLY.min_txns} AS is_supported_distinct
FROM m_clean GROUP BY snapshot_month, "BIN" """)
def q_stream_distinct_support(spark, sf):
    """Support on distinct ids from the stream's partial counts: sketches of
    every batch merged, no second look at the transactions. Monthly counts are
    small, and small sketches are exact."""
    partials = read_partials(spark, q._stream_all(spark, sf, lg_k=LG_K)).where("reason = 'kept'")
    return ops.distinct_support_from_partials(partials, q.MONTHLY.min_txns, by=BY_MONTH)


@query("publish_distinct_support", o.with_(o.BASE, o.stage_ctes(
    None, 0, q.MONTHLY.coverage, by="snapshot_month", prefix="m_"), [
    f"""d AS (SELECT snapshot_month AS m, "BIN" AS b FROM m_clean GROUP BY ALL
      HAVING count(DISTINCT transaction_id) >= {q.MONTHLY.min_txns})"""]) + f"""
SELECT {q.FLAG_COLS}, snapshot_month FROM m_flags WHERE EXISTS (SELECT 1 FROM d WHERE m = snapshot_month AND b = "BIN")""")
def q_publish_distinct_support(spark, sf):
    """Every month published with support on distinct transaction ids, from
    the sketches stored with the counts of the one scan."""
    flags_t, map_t = q._table(spark, "ids_flags"), q._table(spark, "ids_map")
    tx = q._tx(spark, sf)
    publish_months(tx, q._vendor(spark, sf), None, flags_table=flags_t, map_table=map_t,
                   params=q.MONTHLY, lg_k=LG_K, row_bounds=None)
    return flags_t.read(spark)


@query("stream_publish_every_month", o.with_(o.BASE, q.EVERY_CTES) + f"SELECT {q.FLAG_COLS}, snapshot_month FROM m_flags")
def q_stream_publish_every_month(spark, sf):
    """Every month published from the stream's partial counts."""
    flags_t, map_t = q._table(spark, "stream_all_flags"), q._table(spark, "stream_all_map")
    partials = read_partials(spark, q._stream_all(spark, sf))
    months = sorted(r.snapshot_month for r in partials.where("reason <> 'null_timestamp'").select("snapshot_month").distinct().collect())
    publish_months_from_counts(partials, q._vendor(spark, sf), months, flags_table=flags_t, map_table=map_t,
                               params=q.MONTHLY, row_bounds=None)
    return flags_t.read(spark)


# ----------------------------------------------------- attempts and changes


@query("snapshot_refused_rerun", o.with_(o.BASE, q.EVERY_CTES) + f"SELECT {q.FLAG_COLS}, snapshot_month FROM m_flags")
def q_snapshot_refused_rerun(spark, sf):
    """Every month published under a run id, then again under the same id by a
    run that the gate refuses: readers still see the first."""
    flags_t, map_t = q._table(spark, "refused_flags"), q._table(spark, "refused_map")
    kw = dict(flags_table=flags_t, map_table=map_t, run_id="scheduled")
    tx, vendor = q._tx(spark, sf), q._vendor(spark, sf)
    first = publish_months(tx, vendor, None, params=q.MONTHLY, row_bounds=None, **kw)
    try:
        publish_months(tx, vendor, [r.month for r in first], params=q.NONE_KEPT, **kw)
    except DataQualityError:
        return flags_t.read(spark)
    raise AssertionError("a run without rows was not refused")


def _every_month(spark, sf, params):
    return infer(q._tx(spark, sf), q._vendor(spark, sf), None, params, by=BY_MONTH).flags


@query("snapshot_as_of_before_rerun", o.with_(o.BASE, q.EVERY_CTES) + f"SELECT {q.FLAG_COLS}, snapshot_month FROM m_flags")
def q_snapshot_as_of_before_rerun(spark, sf):
    """A run repeated under its id does not change what an earlier time reads."""
    t = q._table(spark, "before_rerun")
    first = t.write_months(_every_month(spark, sf, q.MONTHLY), run_id="scheduled")
    t.write_months(_every_month(spark, sf, q.RERUN), run_id="scheduled")
    return t.read(spark, as_of=max(c.committed_at for c in first))


RERUN_CTES = o.stage_ctes(None, q.RERUN.min_txns, q.RERUN.coverage, by="snapshot_month", prefix="r_")
SECOND_CTE = """second AS (SELECT "BIN", inferred_top_country, CASE WHEN "BIN" LIKE '%2%' THEN NULL ELSE vendor_country END
    AS vendor_country, is_discrepant, bin_total, snapshot_month FROM m_flags WHERE "BIN" NOT LIKE '%5')"""


def _two_versions(spark, sf):
    """A table of every month, written twice: fewer BINs at first; then more,
    without some of the first's and with some vendor countries gone."""
    t = q._table(spark, "changes")
    first = t.write_months(_every_month(spark, sf, q.RERUN))
    vendor = F.when(~F.col("BIN").like("%2%"), F.col("vendor_country"))
    t.write_months(_every_month(spark, sf, q.MONTHLY).where(~F.col("BIN").like("%5")).withColumn("vendor_country", vendor))
    return t, {"as_of": max(c.committed_at for c in first)}


@query("snapshot_changes", o.with_(o.BASE, q.EVERY_CTES, RERUN_CTES, [SECOND_CTE]) + """
SELECT coalesce(p.snapshot_month, c.snapshot_month) AS snapshot_month, coalesce(p."BIN", c."BIN") AS "BIN",
  CASE WHEN p."BIN" IS NULL THEN 'insert' WHEN c."BIN" IS NULL THEN 'delete' ELSE 'update' END AS change,
  c.inferred_top_country, c.vendor_country, c.is_discrepant, c.bin_total
FROM r_flags p FULL OUTER JOIN second c ON p.snapshot_month = c.snapshot_month AND p."BIN" = c."BIN"
WHERE p."BIN" IS NULL OR c."BIN" IS NULL OR p.inferred_top_country IS DISTINCT FROM c.inferred_top_country
  OR p.vendor_country IS DISTINCT FROM c.vendor_country OR p.is_discrepant <> c.is_discrepant OR p.bin_total <> c.bin_total""")
def q_snapshot_changes(spark, sf):
    """The rows that turn the table's first version into its second."""
    t, since = _two_versions(spark, sf)
    return t.changes(spark, since)


@query("snapshot_changes_applied", o.with_(o.BASE, q.EVERY_CTES, [SECOND_CTE]) + f"SELECT {q.FLAG_COLS}, snapshot_month FROM second")
def q_snapshot_changes_applied(spark, sf):
    """The first version with the feed applied is the second."""
    t, since = _two_versions(spark, sf)
    keys = ("snapshot_month", "BIN")
    return ops.apply_changes(t.read(spark, **since), t.changes(spark, since, keys=keys), keys)


@query("snapshot_verify", o.with_(o.BASE, q.EVERY_CTES) + f"""
SELECT snapshot_month, count(*) AS row_count, CASE WHEN snapshot_month = '{q.MONTH_A}' THEN count(*) ELSE 0 END AS found_rows,
  FALSE AS same_rows FROM m_flags WHERE snapshot_month IN ('{q.MONTH_A}', '{q.MONTH_B}') GROUP BY snapshot_month""")
def q_snapshot_verify(spark, sf):
    """Every month written, then one month's files changed and another's
    deleted: the ledger's row counts and checksums tell both."""
    from ..sinks import remove_dir
    t = q._table(spark, "verify")
    t.write_months(_every_month(spark, sf, q.MONTHLY))
    path = {r.snapshot_month: t._run_path(r) for r in t.current_runs(spark)}
    changed = spark.read.parquet(path[q.MONTH_A]).withColumn("bin_total", F.col("bin_total") + 1)
    held = shared_dir(spark, "cardgeo", "queries", "verify_rows")
    changed.write.parquet(held)
    spark.read.parquet(held).write.mode("overwrite").parquet(path[q.MONTH_A])
    remove_dir(spark, path[q.MONTH_B])
    return t.verify(spark).drop("run_id")


@query("snapshot_drift_colocated", o.with_(o.BASE, q.AB_CTES) + q.DRIFT_SQL)
def q_snapshot_drift_colocated(spark, sf):
    """Drift between two months of a table bucketed and sorted by BIN: a merge
    of bucket files, without an exchange."""
    path = shared_dir(spark, "cardgeo", "queries", "bucketed")
    t = BucketedTable(f"cardgeo_drift_{path.rsplit('/', 1)[1]}", path, buckets=8)
    for month in (q.MONTH_A, q.MONTH_B):
        t.write(q._flags(spark, sf, month), month)
    return ops.snapshot_drift(t.read(spark, q.MONTH_A), t.read(spark, q.MONTH_B))


# ---------------------------------------------- drift, trends, significance

PLOGP = "CASE WHEN {0} > 0 THEN {0} * log2({0}) ELSE 0 END".format
JS_SQL = f"""
SELECT m AS snapshot_month, "BIN", pt AS prev_total, qt AS bin_total, js AS js_divergence, js >= {ops.SHIFTED} AS is_shifted
FROM (SELECT m, "BIN", pt, qt, greatest(round(sum(({PLOGP('p')} + {PLOGP('q')}) / 2 - {PLOGP('((p + q) / 2)')}), 9), 0.0) AS js
      FROM (SELECT m, "BIN", pt, qt, pn / pt::DOUBLE AS p, qn / qt::DOUBLE AS q FROM classes) GROUP BY ALL)"""


@query("country_drift", o.with_(o.BASE, q.EVERY_CTES, [
    'cur AS (SELECT snapshot_month AS m, "BIN", country, txn_count AS n, bin_total AS t FROM m_top)',
    f'prv AS (SELECT {q.NEXT_MONTH} AS m, "BIN", country, txn_count AS n, bin_total AS t FROM m_top)',
    """tot AS (SELECT DISTINCT cur.m, cur."BIN", prv.t AS pt, cur.t AS qt FROM cur JOIN prv ON cur.m = prv.m AND cur."BIN" = prv."BIN")""",
    """mixed AS (SELECT m, "BIN", country, sum(pn) AS pn, sum(qn) AS qn FROM (SELECT m, "BIN", country, 0 AS pn, n AS qn FROM cur
        UNION ALL SELECT m, "BIN", country, n, 0 FROM prv) GROUP BY ALL)""",
    'named AS (SELECT m, "BIN", pt, qt, pn, qn FROM mixed JOIN tot USING (m, "BIN"))',
    """classes AS (SELECT * FROM named UNION ALL
        SELECT m, "BIN", pt, qt, pt - sum(pn), qt - sum(qn) FROM named GROUP BY m, "BIN", pt, qt)"""]) + JS_SQL)
def q_country_drift(spark, sf):
    """How far each BIN's mix of countries moved since the month before, from
    the stored maps of every month."""
    t = q._table(spark, "drift_maps")
    t.write_months(infer(q._tx(spark, sf), q._vendor(spark, sf), None, q.MONTHLY, by=BY_MONTH).top_countries)
    return ops.country_drift(t.read(spark))


JUMP_MONTH = "1996-07"
#: A jump in one month of some BINs, and slow growth of others, on real totals.
PLANTED = f"""CASE WHEN snapshot_month = '{JUMP_MONTH}' AND "BIN" LIKE '%3%' THEN bin_total * 6
  WHEN "BIN" LIKE '%7%' THEN bin_total + (month_at - 23904) * 2 ELSE bin_total END"""


@query("dq_trend", o.with_(o.BASE, q.EVERY_CTES, [
    """ser AS (SELECT snapshot_month, "BIN", bin_total, CAST(substr(snapshot_month, 1, 4) AS INTEGER) * 12
        + CAST(substr(snapshot_month, 6, 2) AS INTEGER) AS month_at FROM m_flags)""",
    f'val AS (SELECT snapshot_month, "BIN", month_at, CAST({PLANTED} AS BIGINT) AS volume FROM ser)',
    """win AS (SELECT *, coalesce(list(volume::DOUBLE) OVER (PARTITION BY "BIN" ORDER BY month_at
        RANGE BETWEEN 6 PRECEDING AND 1 PRECEDING), []) AS l FROM val)""",
    "med AS (SELECT *, list_aggregate(l, 'median') AS baseline FROM win)",
    "dev AS (SELECT *, list_aggregate(list_transform(l, lambda x: abs(x - baseline)), 'median') AS mad FROM med)"]) + """
SELECT snapshot_month, "BIN", volume, CAST(len(l) AS BIGINT) AS n_before, baseline, mad,
  CASE WHEN mad > 0 THEN round(abs(volume::DOUBLE - baseline) * 0.6745 / mad, 9) END AS score,
  coalesce(len(l) >= 3 AND abs(volume::DOUBLE - baseline) * 0.6745 > mad * 3.5
    AND abs(volume::DOUBLE - baseline) > abs(baseline) * 0.2, FALSE) AS is_anomalous FROM dev""")
def q_dq_trend(spark, sf):
    """Each BIN's monthly volume against the median of the six months before."""
    planted = F.expr(PLANTED.replace('"BIN"', "BIN"))
    series = (_every_month(spark, sf, q.MONTHLY).withColumn("month_at", month_index("snapshot_month"))
              .select("snapshot_month", "BIN", planted.cast("long").alias("volume")))
    return ops.trend_anomalies(series, "volume")


def _wilson(k, n, sign):
    z = ops.Z_95
    p, n = f"({k} / CAST({n} AS DOUBLE))", f"CAST({n} AS DOUBLE)"
    return (f"round(({p} + {z * z!r} / (2 * {n}) {sign} {z!r} * sqrt({p} * (1 - {p}) / {n} + {z * z!r} / (4 * {n} * {n})))"
            f" / (1 + {z * z!r} / {n}), 9)")


SEV_HEAD, SEV_TAIL = q.SEVERITY_SQL.split("\nSELECT", 1)
LEAD = _wilson("top_country_txns", "(top_country_txns + vendor_country_txns)", "-")


@query("discrepancy_significance", o.with_(o.BASE, q.ALL_CTES, [SEV_HEAD, f"sev AS (SELECT{SEV_TAIL})"]) + f"""
SELECT "BIN", inferred_top_country, vendor_country, is_discrepant, bin_total, top_country_txns, vendor_country_txns,
  CASE WHEN vendor_country IS NOT NULL THEN {_wilson('vendor_country_txns', 'bin_total', '-')} END AS vendor_pct_low,
  CASE WHEN vendor_country IS NOT NULL THEN {_wilson('vendor_country_txns', 'bin_total', '+')} END AS vendor_pct_high,
  CASE WHEN is_discrepant THEN {LEAD} END AS lead_low, is_discrepant AND {LEAD} > 0.5 AS is_significant FROM sev""")
def q_discrepancy_significance(spark, sf):
    r = infer(q._tx(spark, sf), vendor_from_tables(spark, sf), None, q.ALL)
    return ops.discrepancy_significance(r.supported, vendor_from_tables(spark, sf), coverage=q.ALL.coverage)

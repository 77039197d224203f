"""Monthly publication: the inferred country map and the vendor flags.

One pass over the transactions per run, however many months. The flow:

1. slice the month(s) (pushed range filter) and aggregate rows per
   (month, reject reason, BIN, country) -- the only pass over raw data --
   into a work folder under the shared ``spark.checkpoint.dir``, then write the
   folder's manifest. Everything after reads these small files: a lost executor
   recomputes from them, never from the raw scan, and the load accounting (rows
   in, rejects by reason) is an exact aggregate of committed files, not an
   accumulator that a re-run stage could count twice. A run that fails later
   resumes from them (``resume``): its manifest says that they are whole and
   for which parameters;
2. counts -> support (on rows, or on distinct transaction ids from sketches
   stored with the counts) -> coverage cut; stage the top-country map;
3. flags from the staged map, staged too; counts, map and flags checked on
   the written files (small aggregates), row counts against the previous
   month. Each stage's rows and an order-free checksum of them are taken while
   it writes, and what the next stage reads must agree. Drift counts against
   the previous month (from this run or the table) go into each month's ledger
   metrics;
4. commit only if the checks pass (``gate``); otherwise nothing becomes
   visible and :class:`DataQualityError` is raised. The map's ledger rows
   require the same attempt's commit of the flags, which comes second: that one
   append makes both tables visible, and a failure before it shows neither,
   whatever was committed under the run's id before. After a commit the work
   folder is deleted; a failed run keeps it. Row counts of staged runs come
   from result-stage observations (applied once per partition) on the writes.

Rows without a timestamp belong to no month; a run counts those it meets as
``null_timestamp`` of the whole run, repeated in each month's metrics.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import bin_length_ok, row_hash
from ..operators import (
    REASONS,
    counts_from_partials,
    country_drift,
    distinct_support_from_partials,
    dq_country_code,
    dq_coverage_reached,
    dq_total_matches,
    drift_summary,
    filter_supported_bins,
    flag_discrepancies,
    reason_counts,
    select_top_countries,
    slice_month,
)
from ..params import Params, prev_month, validate_month
from ..sinks import (SnapshotTable, checkpoint_dir, literal_rows, new_attempt, new_run_id, path_matches,
                     remove_dir)


#: A work folder's manifest: the parameters of its counts, and what was written.
MANIFEST_SCHEMA = "params string, rows long, checksum long"

#: Rows of a month against the previous one that the gate accepts.
ROW_BOUNDS = (0.5, 2.0)


class DataQualityError(RuntimeError):
    def __init__(self, month: str, violations: dict[str, int], run_id: str | None = None):
        super().__init__(f"data-quality checks failed for {month}: {violations}")
        self.month = month
        self.violations = violations
        self.run_id = run_id


@dataclass(frozen=True)
class PublishResult:
    month: str
    run_id: str
    map_rows: int
    flag_rows: int
    metrics: dict
    violations: dict


def flag_violations(flags: DataFrame) -> DataFrame:
    """One row: number of flag rows breaking each publication rule
    (BINs must be unique per month)."""
    n = F.count(F.lit(1))
    key = [c for c in ("snapshot_month",) if c in flags.columns] + ["BIN"]
    return flags.agg(
        F.sum(F.when(F.col("BIN").isNull() | F.col("inferred_top_country").isNull()
                     | F.col("is_discrepant").isNull(), 1).otherwise(0)).alias("null_critical"),
        (n - F.count_distinct(*key)).alias("duplicate_bins"),
        F.sum(F.when(F.col("BIN").isNotNull() & ~bin_length_ok(), 1).otherwise(0))
         .alias("bad_bin_length"),
        F.sum(F.when((F.length("inferred_top_country") != 2)
                     | (F.col("vendor_country").isNotNull()
                        & (F.length("vendor_country") != 2)), 1).otherwise(0))
         .alias("bad_country_code"),
    )


def map_violations(top: DataFrame, coverage, by=("snapshot_month",)) -> DataFrame:
    """Rows ``(check, n)``: duplicate (month, BIN, country) pairs in the
    top-country map, and BINs whose kept countries do not reach the coverage
    target or are not minimal (exact arithmetic)."""
    dup = top.groupBy(*by, "BIN", "country").count().where(F.col("count") > 1)
    cov = dq_coverage_reached(top, coverage, by=by)
    return (dup.agg(F.lit("map_duplicate_pairs").alias("check"), F.count(F.lit(1)).alias("n"))
            .unionByName(cov.agg(F.lit("map_coverage").alias("check"),
                                 F.count(F.lit(1)).alias("n"))))


def row_count_anomalies(counts: dict[str, int], before: dict[str, int], bounds) -> int:
    """How many of the run's months (``counts``) are empty, or leave
    ``bounds`` times the previous calendar month's rows -- of this run, else of
    the table (``before``). The rule of ``dq_row_count``, on ledger figures."""
    lo, hi = bounds
    bad = 0
    for month, n in counts.items():
        p = prev_month(month)
        prior = counts.get(p, before.get(p, 0))
        bad += n == 0 or (prior > 0 and not lo <= n / prior <= hi)
    return bad


def _months(months) -> list[str]:
    months = [validate_month(m) for m in ([months] if isinstance(months, str) else months)]
    if not months:
        raise ValueError("no months to publish")
    return months


def work_dir(spark, map_table: SnapshotTable, run_id: str) -> str:
    """Where a run stages its partial counts: under the cluster's shared
    ``spark.checkpoint.dir``; next to the map table only if that is unset."""
    base = checkpoint_dir(spark)
    root = f"{base.rstrip('/')}/cardgeo/publish" if base else f"{map_table.root.rstrip('/')}/_work"
    return f"{root}/run_id={run_id}"


def checksum_mismatch(df: DataFrame, name: str, rows: int, checksum: int) -> DataFrame:
    """``(check, n)``: 1 if ``df`` is not the rows that were written, else 0."""
    got = (F.count(F.lit(1)) == F.lit(rows)) & (F.coalesce(F.bit_xor(row_hash(df.schema)), F.lit(0)) == F.lit(checksum))
    return df.agg(F.lit(name).alias("check"), F.when(got, 0).otherwise(1).cast("long").alias("n"))


def _stage_counts(tx: DataFrame, months, work: str, resume: bool, *, date_col, strict, codes, lg_k):
    """The counts of a run's only pass over raw rows, read back from its work
    folder, with what was written (rows, checksum). ``resume`` takes those of
    an earlier attempt if its manifest has the same parameters."""
    spark = tx.sparkSession
    params = json.dumps({"months": None if months is None else sorted(months), "date_col": date_col, "strict": strict,
                         "codes": codes is not None, "lg_k": lg_k}, sort_keys=True)
    if resume and path_matches(spark, f"{work}/manifest") is not False:
        found = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{work}/manifest").first()
        if found is not None and found["params"] == params:
            return spark.read.parquet(f"{work}/counts"), found["rows"], found["checksum"]
    remove_dir(spark, f"{work}/manifest")  # first: half-written counts have none
    sliced = slice_month(tx, months, date_col=date_col, with_null=True)  # None: all of them
    counts = reason_counts(sliced, by=("snapshot_month",), strict=strict, codes=codes, lg_k=lg_k)
    schema = counts.schema
    obs = Observation()
    # Read back, every column is nullable; hashes take no notice of that.
    (counts.observe(obs, F.count(F.lit(1)).alias("rows"), F.bit_xor(row_hash(counts.schema)).alias("checksum"))
     .write.mode("overwrite").parquet(f"{work}/counts"))
    rows, checksum = int(obs.get["rows"] or 0), int(obs.get["checksum"] or 0)
    (literal_rows(spark, [(params, rows, checksum)], StructType.fromDDL(MANIFEST_SCHEMA))
     .write.mode("overwrite").parquet(f"{work}/manifest"))
    return spark.read.schema(schema).parquet(f"{work}/counts"), rows, checksum


def publish_months(
    tx: DataFrame,
    vendor: DataFrame,
    months,
    *,
    flags_table: SnapshotTable,
    map_table: SnapshotTable,
    params: Params = Params(),
    gate: bool = True,
    run_id: str | None = None,
    date_col: str | None = None,
    strict: bool = False,
    codes: DataFrame | None = None,
    lg_k: int | None = None,
    row_bounds: tuple[float, float] | None = ROW_BOUNDS,
    resume: bool = False,
) -> list[PublishResult]:
    """Publish ``months`` (a list of ``YYYY-MM``; ``None``: every month that the
    transactions have, found in the scan's counts) from ONE scan of ``tx``:
    the windows run per (month, BIN), each table gets one run id covering
    all months, and either every month is committed or none is. ``strict``
    also rejects non-digit BINs and non-upper-case-letter country codes,
    ``codes`` (a table of ``code``) countries that are not in the list.
    ``lg_k``: a BIN's support counts distinct transaction ids, by sketches of
    2^lg_k buckets, instead of rows.
    ``row_bounds``: the gate refuses a month without flags, or with fewer or
    more rows than these multiples of the previous month's (``None``: any).
    ``resume``: a run that failed after its scan goes on, under its ``run_id``
    and the same parameters, from the counts it had written; the caller vouches
    that its transactions are the same. A refused run is never resumed."""
    months = None if months is None else _months(months)
    if resume and run_id is None:
        raise ValueError("a run to resume needs its run_id")
    run_id = run_id or new_run_id()
    spark = tx.sparkSession
    # 1. The one pass over raw rows: counts per (month, reason, BIN, country).
    work = work_dir(spark, map_table, run_id)
    counts, rows, checksum = _stage_counts(tx, months, work, resume, date_col=date_col, strict=strict,
                                           codes=codes, lg_k=lg_k)
    if months is None:
        found = counts.select("snapshot_month").where("snapshot_month IS NOT NULL").distinct().collect()
        months = _months(sorted(str(r.snapshot_month) for r in found))
    try:
        results = _publish(counts, vendor, months, flags_table=flags_table, map_table=map_table, params=params,
                           gate=gate, run_id=run_id, row_bounds=row_bounds, codes=codes, distinct=lg_k is not None,
                           extra_checks=checksum_mismatch(counts, "counts_checksum", rows, checksum))
    except DataQualityError:
        remove_dir(spark, f"{work}/manifest")
        raise
    # Committed: nothing reads the staged counts any more. A run that fails
    # (or is gated) keeps them for inspection.
    remove_dir(spark, work)
    return results


def publish_months_from_counts(
    partials: DataFrame,
    vendor: DataFrame,
    months,
    *,
    flags_table: SnapshotTable,
    map_table: SnapshotTable,
    params: Params = Params(),
    gate: bool = True,
    run_id: str | None = None,
    distinct: bool = False,
    codes: DataFrame | None = None,
    row_bounds: tuple[float, float] | None = ROW_BOUNDS,
) -> list[PublishResult]:
    """Publish from committed partial counts ``(snapshot_month, reason, BIN,
    country, n)`` -- e.g. the incremental stream's table -- without touching
    the raw transactions (several rows per key are summed). ``distinct``:
    support counts distinct transaction ids, from the partials' sketches.
    ``codes`` adds the vendor's countries to what the gate checks; the counts
    were judged when they were made."""
    months = _months(months)
    month = F.col("snapshot_month").cast("string")
    partials = partials.where(month.isin(months) | (F.col("reason") == "null_timestamp"))
    return _publish(partials, vendor, months, flags_table=flags_table, map_table=map_table,
                    params=params, gate=gate, run_id=run_id or new_run_id(), row_bounds=row_bounds, codes=codes,
                    distinct=distinct)


def _publish(staged_counts: DataFrame, vendor: DataFrame, months: list[str], *,
             flags_table: SnapshotTable, map_table: SnapshotTable, params: Params,
             gate: bool, run_id: str, row_bounds, codes: DataFrame | None = None, distinct: bool = False,
             extra_checks: DataFrame | None = None) -> list[PublishResult]:
    spark = staged_counts.sparkSession
    attempt = new_attempt()  # of both tables: what is committed together carries one number
    by = ("snapshot_month",)
    staged_counts = staged_counts.withColumn(
        "snapshot_month", F.col("snapshot_month").cast("string"))
    load_rows = (staged_counts.groupBy("snapshot_month")
                 .agg(F.sum("n").alias("rows_in"),
                      *[F.sum(F.when(F.col("reason") == r, F.col("n")).otherwise(0)).alias(r)
                        for r in REASONS]).collect())
    per_month = {m: dict.fromkeys(("rows_in",) + REASONS, 0) for m in months}
    no_month = 0
    for r in load_rows:
        if r["snapshot_month"] in per_month:
            per_month[r["snapshot_month"]].update(
                {k: int(r[k] or 0) for k in ("rows_in",) + REASONS})
        else:
            no_month += int(r["null_timestamp"] or 0)
    for m in months:
        per_month[m]["null_timestamp"] = no_month

    # 2. Counts, support, coverage; stage the top-country map.
    kept = staged_counts.where(F.col("reason") == "kept").drop("reason")
    counts = counts_from_partials(kept, by=by)
    if distinct:
        ids = distinct_support_from_partials(kept, params.min_txns, by=by).where("is_supported_distinct")
        supported = counts.join(ids.select(*by, "BIN"), [*by, "BIN"], "left_semi")
    else:
        supported = filter_supported_bins(counts, params.min_txns)
    top = select_top_countries(supported, params.coverage, by=by)
    staged_map = map_table.stage_months(top, months, run_id=run_id, attempt=attempt)

    # 3. Flags from the staged map, staged; what was written is checked.
    staged_top = map_table.read_run(spark, staged_map)
    staged_flags = flags_table.stage_months(flag_discrepancies(staged_top, vendor, by=by), months,
                                            run_id=run_id, attempt=attempt)
    staged = flags_table.read_run(spark, staged_flags)
    same = [checksum_mismatch(df.drop("snapshot_month"), f"{name}_checksum", sum(run.counts.values()), run.checksum)
            for name, df, run in (("map", staged_top, staged_map), ("flags", staged, staged_flags))]
    same += [extra_checks] if extra_checks is not None else []
    if codes is not None:
        unknown = dq_country_code(staged, codes=codes).where(F.col("reason").startswith("unknown_"))
        same.append(unknown.agg(F.lit("unknown_country_code").alias("check"), F.count(F.lit(1)).alias("n")))
    fv = flag_violations(staged)
    totals = dq_total_matches(counts, by=by).agg(F.lit("count_totals").alias("check"),
                                                 F.count(F.lit(1)).alias("n"))
    checks = (fv.unpivot([], fv.columns, "check", "n")
              .unionByName(map_violations(staged_top, params.coverage)).unionByName(totals))
    for more in same:
        checks = checks.unionByName(more)
    found = {r["check"]: int(r["n"] or 0) for r in checks.collect()}  # one action
    # What was read between stages is a fault of the run, not of its data: named only if found.
    violations = {k: v for k, v in found.items() if v or not k.endswith(("_checksum", "unknown_country_code"))}
    if row_bounds is not None:
        before = {r.snapshot_month: r.row_count for r in flags_table.current_runs(spark)}
        violations["row_count"] = row_count_anomalies(
            {m: staged_flags.counts.get(m, 0) for m in months}, before, row_bounds)
    if gate and any(violations.values()):
        raise DataQualityError(",".join(months), violations, run_id)

    # Discrepant counts, and drift against the previous month (from this
    # run, else the table), in one action.
    earlier = sorted({prev_month(m) for m in months} - set(months))
    cols = ["snapshot_month", "BIN", "inferred_top_country", "bin_total"]
    both = staged.select(*cols)
    prior = flags_table.read(spark, earlier) if earlier else None
    if prior is not None and set(cols) <= set(prior.columns):  # table may be new
        both = both.unionByName(prior.select(*cols))
    disc_rows = (staged.groupBy("snapshot_month")
                 .agg(F.lit("discrepant").alias("change"),
                      F.sum(F.when(F.col("is_discrepant"), 1).otherwise(0)).alias("n_bins")))
    # The stored maps' counts say how far a BIN's mix of countries moved.
    map_cols = ["snapshot_month", "BIN", "country", "txn_count", "bin_total"]
    maps = staged_top.select(*map_cols)
    prior_map = map_table.read(spark, earlier) if earlier else None
    if prior_map is not None and set(map_cols) <= set(prior_map.columns):
        maps = maps.unionByName(prior_map.select(*map_cols))
    shifted_rows = (country_drift(maps).where("is_shifted").groupBy("snapshot_month")
                    .agg(F.lit("shifted").alias("change"), F.count(F.lit(1)).alias("n_bins")))
    disc, drift, shifted = {}, {}, {}
    for r in disc_rows.unionByName(drift_summary(both)).unionByName(shifted_rows).collect():
        if r["change"] == "discrepant":
            disc[r["snapshot_month"]] = int(r["n_bins"] or 0)
        elif r["change"] == "shifted":
            shifted[r["snapshot_month"]] = int(r["n_bins"])
        else:
            drift.setdefault(r["snapshot_month"], {})[f"drift_{r['change']}"] = int(r["n_bins"])

    # 4. Commit both tables; each month's ledger row carries its metrics.
    results = []
    for m in months:
        per_month[m].update(map_rows=staged_map.counts.get(m, 0),
                            flag_rows=staged_flags.counts.get(m, 0),
                            discrepant=disc.get(m, 0), shifted_bins=shifted.get(m, 0), **drift.get(m, {}))
        results.append(PublishResult(m, run_id, per_month[m]["map_rows"],
                                     per_month[m]["flag_rows"], per_month[m], violations))
    map_table.commit(staged_map, month_metrics=per_month, requires=flags_table)
    flags_table.commit(staged_flags, month_metrics=per_month)
    return results


def publish_month(tx: DataFrame, vendor: DataFrame, month: str, **kw) -> PublishResult:
    """One month: see :func:`publish_months`."""
    return publish_months(tx, vendor, [month], **kw)[0]

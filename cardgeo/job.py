"""Monthly publication as a batch job.

    spark-submit cardgeo/job.py --month 2024-05 \\
        --transactions s3://…/transactions --vendor s3://…/vendor_bin_map \\
        --flags-table s3://…/bin_country_flags --map-table s3://…/bin_country_map

``--month`` may be repeated (or given as ``--months 2024-01:2024-06``) to
reprocess several months from one scan. The session comes from
spark-submit's configuration; errors propagate (non-zero exit status).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardgeo.params import Params, validate_month  # noqa: E402


def month_range(spec: str) -> list[str]:
    """``YYYY-MM:YYYY-MM`` -> every month in between, inclusive."""
    lo, hi = (validate_month(x) for x in spec.split(":", 1))
    (y, m), (y2, m2) = (tuple(map(int, lo.split("-"))), tuple(map(int, hi.split("-"))))
    out = []
    while (y, m) <= (y2, m2):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    if not out:
        raise ValueError(f"empty month range {spec!r}")
    return out


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Publish BIN country snapshots for months.")
    p.add_argument("--month", action="append", default=[], help="YYYY-MM (repeatable)")
    p.add_argument("--months", help="inclusive range YYYY-MM:YYYY-MM")
    p.add_argument("--transactions", required=True, help="transactions table path")
    p.add_argument("--transactions-format", default="parquet")
    p.add_argument("--date-col", help="date partition column of the transactions table")
    p.add_argument("--vendor", required=True, help="vendor BIN -> country mapping path")
    p.add_argument("--vendor-format", default="parquet")
    p.add_argument("--flags-table", required=True)
    p.add_argument("--map-table", required=True)
    p.add_argument("--coverage", default="0.95")
    p.add_argument("--min-txns", type=int, default=100)
    p.add_argument("--no-gate", action="store_true", help="publish despite DQ violations")
    p.add_argument("--row-bounds", default="0.5:2.0",
                   help="LO:HI times the previous month's rows, or 'any'")
    p.add_argument("--strict", action="store_true",
                   help="also reject non-digit BINs and malformed country codes")
    p.add_argument("--country-codes", help="table of valid country codes (column code, or --country-codes-col)")
    p.add_argument("--country-codes-col", default="code")
    p.add_argument("--distinct-lg-k", type=int,
                   help="support counts distinct transaction ids, by sketches of 2^k buckets")
    p.add_argument("--run-id", help="the scheduler's own id; a repeat is another attempt of the run")
    p.add_argument("--resume", action="store_true",
                   help="go on from the counts that a failed attempt of --run-id had written")
    a = p.parse_args(argv)
    if a.resume and not a.run_id:
        p.error("--resume needs --run-id")
    a.all_months = [validate_month(m) for m in a.month] + (month_range(a.months) if a.months else [])
    if not a.all_months:
        p.error("give --month or --months")
    return a


def main(argv=None, spark=None) -> list:
    a = parse_args(argv)
    from pyspark.sql import SparkSession

    from cardgeo.plans.publish import publish_months
    from cardgeo.sinks import SnapshotTable
    from cardgeo.sources import read_transactions, read_vendor

    spark = spark or SparkSession.builder.appName("cardgeo-publish").getOrCreate()
    codes = None
    if a.country_codes:
        codes = read_transactions(spark, a.country_codes).withColumnRenamed(a.country_codes_col, "code").select("code")
    results = publish_months(
        read_transactions(spark, a.transactions, a.transactions_format),
        read_vendor(spark, a.vendor, a.vendor_format),
        sorted(set(a.all_months)),
        flags_table=SnapshotTable(a.flags_table),
        map_table=SnapshotTable(a.map_table),
        params=Params(a.coverage, a.min_txns),
        gate=not a.no_gate,
        date_col=a.date_col,
        strict=a.strict,
        codes=codes,
        lg_k=a.distinct_lg_k,
        run_id=a.run_id,
        resume=a.resume,
        row_bounds=None if a.row_bounds == "any" else tuple(map(float, a.row_bounds.split(":"))),
    )
    for r in results:
        print(json.dumps({"month": r.month, "run_id": r.run_id, **r.metrics}))
    return results


if __name__ == "__main__":
    main(sys.argv[1:])

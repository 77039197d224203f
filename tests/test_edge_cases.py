"""Edge cases: one-row, empty and several-BIN inputs, layout, the job."""

import os

from pyspark.sql import functions as F

from cardgeo.operators import (
    country_counts,
    dq_snapshot_month,
    filter_supported_bins,
    flag_discrepancies,
    load_filtered,
    select_top_countries,
)
from cardgeo.schemas import (
    COUNTRY_COUNTS_SCHEMA,
    FLAGS_SCHEMA,
    TOP_COUNTRIES_SCHEMA,
    TXN_SCHEMA,
    VENDOR_SCHEMA,
    same_shape,
)
from cardgeo.sinks import SnapshotTable
from conftest import rows


def tx(spark, pairs, fraud=False):
    return spark.createDataFrame(
        [(f"t{i}", None, b, c, fraud) for i, (b, c) in enumerate(pairs)], TXN_SCHEMA)


def test_counts_single_bin_many_countries(spark):
    out = country_counts(tx(spark, [("420117", c) for c in ("BR", "AR", "BR", "CL", "BR", "AR", "BR", "UY")]))
    assert rows(out) == [("420117", "AR", 2, 8), ("420117", "BR", 4, 8), ("420117", "CL", 1, 8),
                         ("420117", "UY", 1, 8)]


def test_counts_single_transaction_and_single_country(spark):
    assert rows(country_counts(tx(spark, [("420117", "CL")]))) == [("420117", "CL", 1, 1)]
    assert rows(country_counts(tx(spark, [("420118", "UY")] * 7))) == [("420118", "UY", 7, 7)]


def test_counts_schema_on_data(spark):
    assert same_shape(country_counts(tx(spark, [("B1", "US")])).schema, COUNTRY_COUNTS_SCHEMA)


def test_no_valid_rows(spark):
    df = tx(spark, [("420117", "CL"), ("420118", "UY"), ("420118", "AR")], fraud=True)
    assert load_filtered(df).count() == 0


def counts(spark, data):
    return spark.createDataFrame(data, COUNTRY_COUNTS_SCHEMA)


def test_coverage_several_bins(spark):
    df = counts(spark, [("420117", "BR", 19, 20), ("420117", "AR", 1, 20),
                        ("420118", "CL", 30, 50), ("420118", "PE", 15, 50), ("420118", "UY", 5, 50)])
    assert rows(select_top_countries(df), "BIN", "country") == [
        ("420117", "BR"), ("420118", "CL"), ("420118", "PE"), ("420118", "UY")]


def test_coverage_empty_and_schema(spark):
    out = select_top_countries(counts(spark, []))
    assert out.count() == 0 and same_shape(out.schema, TOP_COUNTRIES_SCHEMA)


def test_support_all_above_all_below_empty_and_schema(spark):
    top = select_top_countries(counts(spark, [("420117", "BR", 33, 33), ("420118", "CL", 48, 48)]))
    assert filter_supported_bins(top, 33).count() == 2
    assert filter_supported_bins(top, 49).count() == 0
    assert filter_supported_bins(select_top_countries(counts(spark, [])), 1).count() == 0
    assert same_shape(filter_supported_bins(top, 33).schema, TOP_COUNTRIES_SCHEMA)


def test_empty_vendor(spark):
    out = flag_discrepancies(counts(spark, [("B1", "US", 5, 5)]),
                             spark.createDataFrame([], VENDOR_SCHEMA))
    assert rows(out) == [("B1", "US", None, False, 5)]
    assert same_shape(out.schema, FLAGS_SCHEMA)


def test_table_layout_and_ledger(spark, table_root):
    t = SnapshotTable(table_root)
    c = t.write(spark.createDataFrame([("B1", "US", "US", False, 1)], FLAGS_SCHEMA), "2023-01")
    local = table_root.removeprefix("file:")
    assert os.path.isdir(f"{local}/data/snapshot_month=2023-01/run_id={c.run_id}")
    assert os.path.isdir(f"{local}/_ledger")
    led = t.ledger(spark).first()
    assert (led.snapshot_month, led.run_id, led.row_count) == ("2023-01", c.run_id, 1)


def test_snapshot_month_report(spark):
    snap = spark.createDataFrame([("B1", "US", "US", False, 1)], FLAGS_SCHEMA)
    df = (snap.withColumn("snapshot_month", F.lit("2023-01"))
          .unionByName(snap.withColumn("snapshot_month", F.lit("2023-13"))))
    assert rows(dq_snapshot_month(df)) == [("2023-01", 1, True), ("2023-13", 1, False)]


def test_job_cli(spark, capsys):
    import datetime as dt

    import pytest

    from cardgeo.job import main, month_range
    from cardgeo.sinks import shared_dir

    assert month_range("2023-11:2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    with pytest.raises(ValueError):
        month_range("2023-13:2024-01")
    root = shared_dir(spark, "cardgeo", "tests", "job")
    jan = dt.datetime(2023, 1, 3)
    spark.createDataFrame([(f"t{i}", jan, "123456", "US", False) for i in range(3)],
                          TXN_SCHEMA).write.parquet(f"{root}/tx")
    spark.createDataFrame([("123456", "CA")], VENDOR_SCHEMA).write.parquet(f"{root}/vendor")
    res = main(["--months", "2023-01:2023-02", "--transactions", f"{root}/tx",
                "--vendor", f"{root}/vendor", "--flags-table", f"{root}/flags",
                "--map-table", f"{root}/map", "--min-txns", "1", "--row-bounds", "any"], spark=spark)
    assert [(r.month, r.flag_rows) for r in res] == [("2023-01", 1), ("2023-02", 0)]
    assert '"month": "2023-01"' in capsys.readouterr().out
    assert rows(SnapshotTable(f"{root}/flags").read(spark)) == [
        ("123456", "US", "CA", True, 3, "2023-01")]

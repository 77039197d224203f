import datetime as dt

import pytest
from pyspark.sql.types import StructField, StructType, TimestampType

from cardgeo.operators import load_filtered, reject_reasons, strict_bin_rejects
from cardgeo.schemas import TXN_SCHEMA, same_shape
from cardgeo.sources import read_transactions
from conftest import rows

T = dt.datetime(2023, 1, 15, 10, 0, 0)


NULLABLE = StructType([StructField(f.name, f.dataType, True) for f in TXN_SCHEMA.fields])


def tx(spark, data, schema=TXN_SCHEMA):
    return spark.createDataFrame(
        [(f"t{i}", ts or T, b, c, f) for i, (b, c, f, ts) in
         enumerate([(r + (None,))[:4] for r in data])], schema)


def test_fraud_dropped(spark):
    df = tx(spark, [("123456", "US", True), ("654321", "CA", False)])
    assert rows(load_filtered(df), "BIN") == [("654321",)]


def test_null_fraud_label_dropped(spark):
    df = tx(spark, [("123456", "US", None)])
    assert load_filtered(df).count() == 0


def test_null_country_dropped(spark):
    df = tx(spark, [("123456", None, False), ("654321", "CA", False)])
    assert rows(load_filtered(df), "BIN") == [("654321",)]


def test_empty_country_string_passes(spark):
    df = tx(spark, [("123456", "", False)])
    assert load_filtered(df).count() == 1


def test_bin_length_bounds(spark):
    df = tx(spark, [("12345", "US", False), ("123456789", "US", False),
                    ("123456", "US", False), ("1234567", "US", False),
                    ("12345678", "US", False)])
    assert rows(load_filtered(df), "BIN") == [("123456",), ("1234567",), ("12345678",)]


def test_bin_length_counts_characters_not_digits(spark):
    df = tx(spark, [("VALIDC1", "FR", False), ("BINLENOK", "JP", False)])
    assert load_filtered(df).count() == 2
    assert load_filtered(df, strict=True).count() == 0


def test_all_filters(spark):
    df = tx(spark, [("123456", "US", False), ("7654321", "FR", False),
                    ("123456", "US", True), ("123456", None, False),
                    ("12345", "US", False), ("123456", "US", None)])
    assert rows(load_filtered(df), "BIN", "billing_address_country") == [
        ("123456", "US"), ("7654321", "FR")]


def test_empty_table_keeps_schema(spark):
    out = load_filtered(spark.createDataFrame([], TXN_SCHEMA))
    assert out.count() == 0
    assert same_shape(out.schema, TXN_SCHEMA)


def test_missing_table_only_when_allowed(spark, tmp_path):
    missing = str(tmp_path / "nope")
    df = read_transactions(spark, missing, allow_missing=True)
    assert df.count() == 0 and same_shape(df.schema, TXN_SCHEMA)
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        read_transactions(spark, missing)


def test_month_slice_is_half_open(spark):
    data = [("123456", "US", False, dt.datetime(2023, 1, 1, 0, 0, 0)),
            ("123456", "US", False, dt.datetime(2023, 1, 31, 23, 59, 59)),
            ("123456", "US", False, dt.datetime(2023, 2, 1, 0, 0, 0)),
            ("123456", "US", False, dt.datetime(2022, 12, 31, 23, 59, 59))]
    df = tx(spark, data)
    assert df.schema["timestamp"].dataType == TimestampType()
    assert load_filtered(df, "2023-01").count() == 2
    assert load_filtered(df, ["2023-01", "2023-02"]).count() == 3
    assert load_filtered(df).count() == 4


def test_bad_month_rejected(spark):
    df = tx(spark, [("123456", "US", False)])
    for bad in ["2023/01", "202301", "23-01", "2023-1", "2023-001", "2023-13", "abcd-xy"]:
        with pytest.raises(ValueError):
            load_filtered(df, bad)


def test_reject_reasons_first_match(spark):
    df = tx(spark, [("123456", "US", None), ("123456", None, True), ("123456", None, False),
                    ("12345", "US", False), (None, "US", False), ("123456", "US", False)],
            NULLABLE)
    assert rows(reject_reasons(df)) == [
        ("bad_bin_length", 2), ("fraud", 1), ("kept", 1), ("null_country", 1), ("null_label", 1)]


def test_strict_bin_rejects(spark):
    df = tx(spark, [("12a456", "US", False), ("123456", "US", False), ("12345", "US", False)])
    assert rows(strict_bin_rejects(df)) == [("12345", 1), ("12a456", 1)]


def test_reject_reasons_by_month(spark):
    data = [("123456", "US", False, dt.datetime(2023, 1, 5)),
            ("123456", "US", True, dt.datetime(2023, 2, 5)),
            ("12345", "US", False, dt.datetime(2023, 2, 6))]
    got = rows(reject_reasons(tx(spark, data), by=("snapshot_month",)))
    assert got == [("2023-01", "kept", 1), ("2023-02", "bad_bin_length", 1), ("2023-02", "fraud", 1)]

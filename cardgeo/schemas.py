"""Declared schemas of inputs and outputs.

Fixed values: the column names and types of the transactions, the vendor
mapping and the stored outputs. ``TXN_SCHEMA``, ``VENDOR_SCHEMA`` and
``LEDGER_SCHEMA`` are enforced on reads; the output schemas state what the
operators return, and tests hold them to it. Schemas are never mutated
(``StructType.add`` changes the object in place).
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TXN_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("BIN", StringType(), False),
    StructField("billing_address_country", StringType(), True),
    StructField("fraud_label", BooleanType(), True),
])

VENDOR_SCHEMA = StructType([
    StructField("BIN", StringType(), True),
    StructField("country", StringType(), True),
])

COUNTRY_COUNTS_SCHEMA = StructType([
    StructField("BIN", StringType(), True),
    StructField("country", StringType(), True),
    StructField("txn_count", LongType(), False),
    StructField("bin_total", LongType(), False),
])

TOP_COUNTRIES_SCHEMA = StructType(COUNTRY_COUNTS_SCHEMA.fields + [
    StructField("country_pct", DoubleType(), False),
    StructField("cumulative_pct", DoubleType(), False),
])

FLAGS_SCHEMA = StructType([
    StructField("BIN", StringType(), True),
    StructField("inferred_top_country", StringType(), True),
    StructField("vendor_country", StringType(), True),
    StructField("is_discrepant", BooleanType(), False),
    StructField("bin_total", LongType(), True),
])

SNAPSHOT_SCHEMA = StructType(FLAGS_SCHEMA.fields + [
    StructField("snapshot_month", StringType(), True),
])

LEDGER_SCHEMA = StructType([
    StructField("snapshot_month", StringType(), False),
    StructField("run_id", StringType(), False),
    StructField("committed_at", TimestampType(), False),
    StructField("row_count", LongType(), False),
    StructField("schema_json", StringType(), False),
    StructField("metrics", MapType(StringType(), LongType()), True),
    StructField("requires", StringType(), True),
])


def names_and_types(schema: StructType) -> list[tuple[str, DataType]]:
    """Schema without nullability: windows, division and file reads all
    return nullable columns, so only names and types are comparable."""
    return [(f.name, f.dataType) for f in schema.fields]


def same_shape(a: StructType, b: StructType) -> bool:
    return names_and_types(a) == names_and_types(b)


def require_columns(df_columns, required, what: str) -> None:
    """Raise ``ValueError`` naming the columns missing from a frame."""
    missing = sorted(set(required) - set(df_columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")

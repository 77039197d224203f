"""Scans of the transactions table and of the vendor mapping."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TXN_SCHEMA, VENDOR_SCHEMA, require_columns
from ..sinks.snapshot import path_matches

log = logging.getLogger(__name__)


def read_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    *,
    allow_missing: bool = False,
    schema=None,
) -> DataFrame:
    """Scan the transactions table at ``path`` (lazy; nothing is counted).

    With ``allow_missing=True`` a path that does not exist yields an empty
    frame of ``TXN_SCHEMA`` (first run, tests). Every other analysis error
    (bad schema, unreadable files, missing format) is raised.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if allow_missing and path_matches(spark, path) is False:
        return _missing(spark, path, schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if allow_missing and e.getCondition() == "PATH_NOT_FOUND":
            return _missing(spark, path, schema)
        raise


def _missing(spark: SparkSession, path: str, schema) -> DataFrame:
    log.warning("transactions path %s not found; using an empty table", path)
    return spark.createDataFrame([], schema or TXN_SCHEMA)


def read_vendor(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    *,
    bin_col: str = "BIN",
    country_col: str = "country",
    is_table: bool = False,
) -> DataFrame:
    """Vendor BIN -> country mapping, projected to ``(BIN, country)``.

    ``source`` is a catalog table name when ``is_table`` else a path.
    """
    df = spark.table(source) if is_table else spark.read.format(fmt).load(source)
    require_columns(df.columns, {bin_col, country_col}, "vendor table")
    return df.select(
        F.col(bin_col).cast("string").alias("BIN"),
        F.col(country_col).cast("string").alias("country"),
    )


def vendor_from_rows(spark: SparkSession, rows) -> DataFrame:
    """Small literal vendor mapping (tests and examples)."""
    return spark.createDataFrame(rows, VENDOR_SCHEMA)

"""Country codes checked against a reference list.

A pattern accepts any two letters; a list knows which of them are countries.
The list is a table (``code``), so its size is measured before it is broadcast:
up to ``MAX_BROADCAST_CODES`` codes go to every task, a longer list is joined
by Spark's own choice. Aggregates are checked after they are made: a join on
counted rows, never a shuffle of raw ones for the list's sake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import require_columns

MAX_BROADCAST_CODES = 10_000


def code_list(codes: DataFrame, col: str = "code", name: str = "code") -> DataFrame:
    """The distinct codes of a list as ``name`` (null and padding dropped),
    marked for broadcast if at most ``MAX_BROADCAST_CODES`` were counted."""
    require_columns(codes.columns, {col}, "code list")
    out = codes.select(F.trim(F.col(col).cast("string")).alias(name)).where(F.length(name) > 0).distinct()
    few = out.limit(MAX_BROADCAST_CODES + 1).count() <= MAX_BROADCAST_CODES
    return F.broadcast(out) if few else out


def known_codes(df: DataFrame, codes: DataFrame, col: str = "billing_address_country") -> DataFrame:
    """Rows of ``df`` whose ``col`` is in the list (case-sensitively)."""
    listed = code_list(codes, name="_listed")
    return df.join(listed, F.col(col) == F.col("_listed"), "left_semi")


def unknown_codes(df: DataFrame, codes: DataFrame, col: str = "billing_address_country") -> DataFrame:
    """``(country, n_rows)`` of values that are not in the list (nulls are not
    judged). Rows are counted first; only the counts meet the list."""
    listed = code_list(codes, name="_listed")
    counted = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("country"))
               .agg(F.count(F.lit(1)).alias("n_rows")))
    return counted.join(listed, F.col("country") == F.col("_listed"), "left_anti")


def with_known(df: DataFrame, codes: DataFrame, cols: dict[str, str]) -> DataFrame:
    """``df`` with a boolean per entry of ``cols`` (new name -> column): whether
    the column's value is in the list (false for null)."""
    for name, col in cols.items():
        listed = code_list(codes, name="_listed")
        df = (df.join(listed, F.col(col) == F.col("_listed"), "left")
              .withColumn(name, F.col("_listed").isNotNull()).drop("_listed"))
    return df

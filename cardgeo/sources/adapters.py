"""Transactions and vendor mapping derived from the driver's test tables.

There is no card-transactions table under the test data, so ``tx`` and
``vendor`` are views over ``lineitem ⋈ orders ⋈ customer ⋈ supplier``.
The rules below are a fixture design (they plant too-short and too-long
BINs, null labels and countries, repeated transaction ids, a dominant home
country, vendor disagreements, case mismatches and vendor nulls); they are
spelled out identically in the DuckDB oracle (``plans/oracle.py``).

Fixed values of the fixture:
  * BIN of supplier key k: first L characters of lead + k + '0000', where k is
    padded with zeros to w = max(4, its digits), lead is the digit w, and
    L = max(1 + w, by k % 10: 0 -> 5, 1 -> 9, 2..4 -> 6, 5..7 -> 7, 8..9 -> 8).
    So no key is cut and no two keys share a BIN; keys of 8 digits and more
    make BINs that are too long.
  * timestamp: NULL if orderkey % 97 = 0 and linenumber = 5.
  * country code of nation n = chr(65 + n) || chr(90 - n).
  * billing country: NULL if linenumber = 7 and quantity <= 10; else the
    supplier's nation if partkey % 10 < 7; else the customer's nation.
  * fraud label: true if returnflag = 'R'; NULL if linenumber = 6 and
    returnflag = 'A'; else false.
  * vendor: suppliers with key % 7 = 0 absent; country NULL if key % 11 = 0,
    else nation (n + 1) % 25 if key % 4 = 0, else lower-case code if
    key % 17 = 0, else the supplier's nation.
  * vendor_dup: vendor plus ('ZZ') for every BIN like '40%3%', plus the
    vendor-only BIN '499999' -> 'ZZ'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .transactions import read_transactions


#: Whose nation is a line item's billing country.
_NOBODY, _SUPPLIER, _CUSTOMER = range(3)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_transactions(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_code(n: Column) -> Column:
    n = n.cast("int")
    return F.concat(F.chr(F.lit(65) + n), F.chr(F.lit(90) - n))


def bin_of(key: Column) -> Column:
    text = key.cast("string")
    width = F.greatest(F.lit(4), F.length(text))
    full = F.concat(width.cast("string"), F.lpad(text, width, F.lit("0")), F.lit("0000"))
    m = key % 10
    length = (F.when(m == 0, 5).when(m == 1, 9).when(m <= 4, 6)
              .when(m <= 7, 7).otherwise(8))
    return full.substr(F.lit(1), F.greatest(width + 1, length))


def tx_from_tables(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """``TXN_SCHEMA``-shaped transactions (``timestamp`` is TIMESTAMP_NTZ);
    ``lineitem``: other rows of that table, e.g. a stream of them.

    BIN and nation codes depend only on the supplier / customer key, so they
    are computed once per dimension row. Orders meet their customers first:
    line items, the largest table, are then dealt once, by order, whatever
    the size of the customer table; and only with what their rules need of
    them, the supplier's texts joining after that.
    """
    li = _table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    whose = (F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") <= 10), _NOBODY)
             .when(F.col("l_partkey") % 10 < 7, _SUPPLIER).otherwise(_CUSTOMER))
    fraud = (F.when(F.col("l_returnflag") == "R", F.lit(True))
             .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A"),
                   F.lit(None).cast("boolean"))
             .otherwise(F.lit(False)))
    li = li.select(
        "l_orderkey", "l_suppkey", "l_linenumber", whose.alias("whose"), fraud.alias("fraud_label"),
        F.when((F.col("l_orderkey") % 97 != 0) | (F.col("l_linenumber") != 5),
               F.col("l_shipdate")).alias("timestamp"))
    s = _table(spark, sf_dir, "supplier")
    su = s.select("s_suppkey", bin_of(F.col("s_suppkey")).alias("BIN"),
                  nation_code(F.col("s_nationkey")).alias("s_code"))
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _table(spark, sf_dir, "customer")
    cu = c.select("c_custkey", nation_code(F.col("c_nationkey")).alias("c_code"))
    # Catalyst / AQE pick broadcast or sort-merge per join from the measured sizes.
    bought = od.join(cu, od.o_custkey == cu.c_custkey).select("o_orderkey", "c_code")
    j = li.join(bought, li.l_orderkey == bought.o_orderkey).join(su, li.l_suppkey == su.s_suppkey)
    country = (F.when(F.col("whose") == _NOBODY, F.lit(None).cast("string"))
               .when(F.col("whose") == _SUPPLIER, F.col("s_code"))
               .otherwise(F.col("c_code")))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        "timestamp",
        F.col("BIN"),
        country.alias("billing_address_country"),
        "fraud_label",
    )


def vendor_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor mapping ``(BIN, country)`` derived from the supplier table."""
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    country = (F.when(k % 11 == 0, F.lit(None).cast("string"))
               .when(k % 4 == 0, nation_code((n + 1) % 25))
               .when(k % 17 == 0, F.lower(nation_code(n)))
               .otherwise(nation_code(n)))
    return s.where(k % 7 != 0).select(bin_of(k).alias("BIN"), country.alias("country"))


def vendor_dup_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor mapping with conflicting second rows and one vendor-only BIN."""
    v = vendor_from_tables(spark, sf_dir)
    extra = v.where(F.col("BIN").like("40%3%")).select("BIN", F.lit("ZZ").alias("country"))
    only = spark.range(1).select(F.lit("499999").alias("BIN"), F.lit("ZZ").alias("country"))
    return v.unionByName(extra).unionByName(only)

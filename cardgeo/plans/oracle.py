"""DuckDB SQL that computes each registered query independently of Spark.

The driver registers the test tables as views; ``tx`` and ``vendor`` are
rebuilt here with the same fixture rules as ``sources/adapters.py``. Every
computed column is aliased exactly like the Spark side. Sums of BIGINT are
cast back to BIGINT (DuckDB widens them to HUGEINT), shares are
``count / CAST(total AS DOUBLE)`` on both sides, and the coverage cut is the
same exact integer comparison.
"""

from __future__ import annotations

from decimal import Decimal

from ..params import DEFAULT_COVERAGE, DEFAULT_MIN_TXNS, as_decimal, month_bounds


def bin_sql(k: str) -> str:
    text = f"CAST({k} AS VARCHAR)"
    w = f"greatest(4, length({text}))"
    return (f"substr(concat(CAST({w} AS VARCHAR), lpad({text}, CAST({w} AS INTEGER), '0'), '0000'), 1, greatest({w} + 1, "
            f"CASE WHEN {k} % 10 = 0 THEN 5 WHEN {k} % 10 = 1 THEN 9 "
            f"WHEN {k} % 10 <= 4 THEN 6 WHEN {k} % 10 <= 7 THEN 7 ELSE 8 END))")


def code_sql(n: str) -> str:
    return (f"concat(chr(65 + CAST({n} AS INTEGER)), chr(90 - CAST({n} AS INTEGER)))")


TX_CTE = f"""tx AS (
  SELECT concat(CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS transaction_id,
         CASE WHEN l.l_orderkey % 97 <> 0 OR l.l_linenumber <> 5 THEN l.l_shipdate END AS "timestamp",
         {bin_sql('l.l_suppkey')} AS "BIN",
         CASE WHEN l.l_linenumber = 7 AND l.l_quantity <= 10 THEN NULL
              WHEN l.l_partkey % 10 < 7 THEN {code_sql('s.s_nationkey')}
              ELSE {code_sql('c.c_nationkey')} END AS billing_address_country,
         CASE WHEN l.l_returnflag = 'R' THEN TRUE
              WHEN l.l_linenumber = 6 AND l.l_returnflag = 'A' THEN NULL
              ELSE FALSE END AS fraud_label
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey)"""

VENDOR_CTE = f"""vendor AS (
  SELECT {bin_sql('s_suppkey')} AS "BIN",
         CASE WHEN s_suppkey % 11 = 0 THEN NULL
              WHEN s_suppkey % 4 = 0 THEN {code_sql('(s_nationkey + 1) % 25')}
              WHEN s_suppkey % 17 = 0 THEN lower({code_sql('s_nationkey')})
              ELSE {code_sql('s_nationkey')} END AS country
  FROM supplier WHERE s_suppkey % 7 <> 0)"""

VENDOR_DUP_CTE = """vendor_dup AS (
  SELECT "BIN", country FROM vendor
  UNION ALL SELECT "BIN", 'ZZ' FROM vendor WHERE "BIN" LIKE '40%3%'
  UNION ALL SELECT '499999', 'ZZ')"""

RANK = 'ORDER BY txn_count DESC, country ASC NULLS FIRST'
ROWS = 'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'


def month_pred(month: str, col: str = '"timestamp"') -> str:
    lo, hi = month_bounds(month)
    return f"{col} >= TIMESTAMP '{lo}' AND {col} < TIMESTAMP '{hi}'"


def coverage_pred(prior: str, total: str, coverage) -> str:
    p, q = as_decimal(coverage).as_integer_ratio()
    return f"({prior}) * {q} < ({total}) * {p}"


def stage_ctes(
    month: str | None = None,
    min_txns: int = DEFAULT_MIN_TXNS,
    coverage: Decimal = DEFAULT_COVERAGE,
    *,
    vendor: str = "vendor",
    by: str | None = None,
    months: tuple[str, ...] | None = None,
    prefix: str = "",
    dedup: bool = True,
) -> list[str]:
    """CTEs ``{prefix}clean … {prefix}flags`` of one inference run.

    ``by`` adds a grouping column (``snapshot_month``) computed from the
    timestamp; ``months`` restricts to those months (multi-month runs).
    """
    p = prefix
    key = f"{by}, " if by else ""
    part = f'PARTITION BY {by}, "BIN"' if by else 'PARTITION BY "BIN"'
    where = ["fraud_label = FALSE", "billing_address_country IS NOT NULL",
             'length("BIN") BETWEEN 6 AND 8']
    if month is not None:
        where.append(month_pred(month))
    if months:
        where.append("(" + " OR ".join(f"({month_pred(m)})" for m in months) + ")")
    if by:
        where.append('"timestamp" IS NOT NULL')
    month_col = ", strftime(\"timestamp\", '%Y-%m') AS snapshot_month" if by else ""
    return [
        f"""{p}clean AS (SELECT *{month_col} FROM tx WHERE {' AND '.join(where)})""",
        f"""{p}cc AS (SELECT {key}"BIN", billing_address_country AS country, count(*) AS txn_count
            FROM {p}clean GROUP BY ALL)""",
        f"""{p}counts AS (SELECT {key}"BIN", country, txn_count,
            CAST(sum(txn_count) OVER ({part}) AS BIGINT) AS bin_total FROM {p}cc)""",
        f"""{p}supported AS (SELECT * FROM {p}counts WHERE bin_total >= {int(min_txns)})""",
        f"""{p}ranked AS (SELECT *, CAST(sum(txn_count) OVER ({part} {RANK} {ROWS}) AS BIGINT) AS cum,
            row_number() OVER ({part} {RANK}) AS rn FROM {p}supported)""",
        f"""{p}top AS (SELECT {key}"BIN", country, txn_count, bin_total,
            txn_count / CAST(bin_total AS DOUBLE) AS country_pct,
            cum / CAST(bin_total AS DOUBLE) AS cumulative_pct, rn
            FROM {p}ranked WHERE {coverage_pred('cum - txn_count', 'bin_total', coverage)})""",
        (f"""{p}vend AS (SELECT "BIN", min(country) AS vendor_country FROM {vendor} GROUP BY "BIN")"""
         if dedup else f"""{p}vend AS (SELECT "BIN", country AS vendor_country FROM {vendor})"""),
        f"""{p}flags AS (SELECT {('t.' + by + ', ') if by else ''}t."BIN", t.country AS inferred_top_country,
            v.vendor_country, coalesce(t.country <> v.vendor_country, FALSE) AS is_discrepant, t.bin_total
            FROM {p}top t LEFT JOIN {p}vend v ON t."BIN" = v."BIN" WHERE t.rn = 1)""",
    ]


def with_(*ctes: str | list[str]) -> str:
    flat: list[str] = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    return "WITH " + ",\n".join(flat) + "\n"


BASE = [TX_CTE, VENDOR_CTE]

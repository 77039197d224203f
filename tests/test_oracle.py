"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as entry
from cardgeo.plans.queries import ORACLE, QUERIES
from tools.oracle_check import canon, duck, norm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_registers_all(spark):
    assert set(NAMES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


# Sorted reports and the order their SQL gives the same rows in.
REPORTS = {
    "report_sorted_counts": '"BIN", txn_count DESC, country',
    "report_sorted_coverage": '"BIN", txn_count DESC, country',
    "report_sorted_flags": '"BIN"',
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_order(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in df.columns)} FROM ({ORACLE[name]}) "
                      f"ORDER BY {REPORTS[name]}")
    assert len(got) > 5 and [tuple(map(norm, r)) for r in got] == [tuple(map(norm, r)) for r in cur.fetchall()]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    sql = ORACLE.get(name)
    assert sql is not None, f"{name} has no oracle"
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert canon(df.columns, got) == canon(cols, want)

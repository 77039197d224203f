"""Steps that the registered queries share, held to what grows with the input."""

import datetime as dt
import re

from cardgeo import Params
from cardgeo.plans import publish_months
from cardgeo.schemas import TXN_SCHEMA
from cardgeo.sinks import SnapshotTable, shared_dir
from cardgeo.sources import tx_from_tables
from conftest import rows
from test_plans import plan

T = dt.datetime(2023, 1, 10)


def tables(spark):
    """A customer and an order that come twice, an order without a customer,
    a line without an order, and nulls in what the rules read."""
    path = shared_dir(spark, "cardgeo", "tests", "tables")
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    for name, data, schema in (
            ("customer", [(1, 3), (1, 4), (2, None)], "c_custkey long, c_nationkey int"),
            ("supplier", [(12, 0)], "s_suppkey long, s_nationkey int"),
            ("orders", [(7, 1), (8, 2), (9, 5), (97, 2), (97, 2)], "o_orderkey long, o_custkey long"),
            ("lineitem", [(7, 8, 12, 1, 5.0, "R", T), (7, 9, 12, 7, 5.0, None, T), (8, 19, 12, 6, 1.0, "A", T), (9, 1, 12, 1, 1.0, "N", T),
                          (97, None, 12, 5, 2.0, "N", T), (11, 1, 12, 1, 1.0, "N", T), (8, 3, 12, None, 1.0, "N", None)], line)):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_lines_are_not_dealt_by_customer(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        tx = tx_from_tables(spark, tables(spark))
        nodes = plan(tx).split("\n\n")
        dealt = [n for n in nodes if re.search(r"hashpartitioning\([oc]_custkey", n)]
        assert len(dealt) == 2 and not any("l_linenumber" in n for n in dealt)
        got = rows(tx)
    finally:
        spark.conf.set(key, before)
    b, home = "40012000"[:6], "AZ"
    assert got == sorted([
        ("7-1", T, b, "DW", True), ("7-1", T, b, "EV", True), ("7-7", T, b, None, False), ("7-7", T, b, None, False),
        ("8-6", T, b, None, None), ("97-5", None, b, None, False), ("97-5", None, b, None, False),
        (None, None, b, home, False)], key=lambda t: tuple(str(x) for x in t))


def test_every_month_is_found_in_the_counts(spark, table_root):
    """No list of months: that of the scan's counts, rejected rows' months included."""
    data = [(f"t{m}{i}", dt.datetime(2023, m, 10), "402771", "NL", m == 5) for m in (2, 3, 5) for i in range(4)]
    data.append(("none", None, "402771", "NL", False))
    tx = spark.createDataFrame(data, TXN_SCHEMA)
    vendor = spark.createDataFrame([("402771", "SE")], "BIN string, country string")
    got = {}
    for name, months in (("found", None), ("given", ["2023-02", "2023-03", "2023-05"])):
        flags, top = SnapshotTable(f"{table_root}/{name}_flags"), SnapshotTable(f"{table_root}/{name}_map")
        res = publish_months(tx, vendor, months, flags_table=flags, map_table=top, params=Params(min_txns=1), row_bounds=None, gate=False)
        got[name] = ([(r.month, r.metrics) for r in res], rows(flags.read(spark).drop("run_id")), rows(top.read(spark).drop("run_id")))
    assert got["found"] == got["given"] and [m for m, _ in got["found"][0]] == ["2023-02", "2023-03", "2023-05"]
    assert got["found"][0][0][1]["null_timestamp"] == 1

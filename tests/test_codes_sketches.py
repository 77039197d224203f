"""Country code lists, and distinct ids from mergeable sketches."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from cardgeo import Params
from cardgeo import operators as ops
from cardgeo.operators import codes as code_lists
from cardgeo.plans import DataQualityError, publish_month, publish_months_from_counts
from cardgeo.schemas import FLAGS_SCHEMA, TXN_SCHEMA
from cardgeo.sinks import SnapshotTable, shared_dir
from cardgeo.streaming import compact_partials, read_partials, start_count_stream
from conftest import rows
from test_plans import PY_NODES, plan, tx_table

T = dt.datetime(2023, 1, 10)


def codes(spark, *listed):
    return spark.createDataFrame([(c,) for c in listed], "code string")


def txns(spark, spec):
    data = [(f"t{i}", T, b, c, f) for i, (b, c, f) in enumerate(spec)]
    return spark.createDataFrame(data, TXN_SCHEMA)


def tables(spark):
    return {k: SnapshotTable(shared_dir(spark, "cardgeo", "tests")) for k in ("flags_table", "map_table")}


SPEC = [("402771", "NL", False), ("402771", "ZZ", False), ("402771", "nl", False), ("402771", None, False),
        ("402771", "ZZ", True), ("40277", "ZZ", False), ("402772", "SE", False)]


@pytest.mark.parametrize("bound", [code_lists.MAX_BROADCAST_CODES, 1])  # a small list, and one that is too long
def test_list_rejects_unknown_countries(spark, monkeypatch, bound):
    monkeypatch.setattr(code_lists, "MAX_BROADCAST_CODES", bound)
    tx, listed = txns(spark, SPEC), codes(spark, "NL", "SE", "SE", " BE ", "", None)
    assert rows(ops.load_filtered(tx, codes=listed), "BIN", "billing_address_country") == [("402771", "NL"), ("402772", "SE")]
    assert rows(ops.unknown_codes(tx, listed)) == [("ZZ", 3), ("nl", 1)]
    assert rows(ops.reject_reasons(tx, codes=listed)) == [
        ("bad_bin_length", 1), ("fraud", 1), ("kept", 2), ("null_country", 1), ("unknown_country", 2)]
    assert rows(ops.reason_counts(tx, codes=listed).where("reason IN ('kept', 'unknown_country')")) == [
        ("kept", "402771", "NL", 1), ("kept", "402772", "SE", 1), ("unknown_country", None, None, 2)]
    assert rows(ops.known_codes(tx, codes(spark))) == []


def test_broadcast_only_a_counted_list(spark, monkeypatch):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString()
    assert hinted(ops.code_list(codes(spark, "NL", "SE")))
    monkeypatch.setattr(code_lists, "MAX_BROADCAST_CODES", 1)
    assert not hinted(ops.code_list(codes(spark, "NL", "SE")))


def test_list_does_not_shuffle_raw_rows(spark):
    """What is exchanged for the list is counted before: the scan's own stage
    ends in the partial aggregate, with and without it."""
    tx, listed = tx_table(spark), codes(spark, "US")
    p = plan(ops.reason_counts(tx, by=("snapshot_month",), codes=listed))
    assert not PY_NODES.search(p)
    steps = re.findall(r"^\(\d+\) (.+?)(?: \[codegen id.*)?$", p, re.M)
    first = next(i for i, s in enumerate(steps) if s.startswith("Exchange"))
    assert any("HashAggregate" in s for s in steps[:first]) and not any("Join" in s for s in steps[:first])
    p = plan(ops.load_filtered(tx, codes=listed))
    assert "BroadcastHashJoin" in p and not re.search(r"Exchange hashpartitioning\(billing", p)


def test_dq_country_code_with_a_list(spark):
    snap = spark.createDataFrame([("B1", "NL", "SE", True, 1), ("B2", "ZZ", None, False, 1), ("B3", "NL", "QQ", True, 1),
                                  ("B4", "N", "QQ", True, 1), ("B5", None, None, False, 1)], FLAGS_SCHEMA)
    assert rows(ops.dq_country_code(snap, codes=codes(spark, "NL", "SE")), "BIN", "reason") == [
        ("B2", "unknown_inferred_country"), ("B3", "unknown_vendor_country"), ("B4", "bad_inferred_country")]


def test_publication_with_a_list(spark):
    tx, listed, t = txns(spark, SPEC), codes(spark, "NL", "SE"), tables(spark)
    kw = dict(t, params=Params(min_txns=1), codes=listed)
    bad = spark.createDataFrame([("402771", "QQ")], "BIN string, country string")
    with pytest.raises(DataQualityError) as e:
        publish_month(tx, bad, "2023-01", **kw)
    assert e.value.violations["unknown_country_code"] == 1
    res = publish_month(tx, ops.known_codes(bad, listed, "country"), "2023-01", **kw)
    assert (res.metrics["unknown_country"], res.metrics["kept"], res.metrics["rows_in"]) == (2, 2, 7)
    assert "unknown_country_code" not in res.violations
    assert rows(t["flags_table"].read(spark), "BIN", "inferred_top_country") == [("402771", "NL"), ("402772", "SE")]


# ----------------------------------------------------------------- sketches


def repeated(spark, bins=3, ids=6000):
    """Ids met three times each, in two months and two countries."""
    n = bins * ids
    return spark.range(3 * n).selectExpr(
        f"concat('id', id % {n}) as transaction_id",
        f"if(id < {n}, timestamp'2023-01-10', timestamp'2023-02-10') as timestamp",
        f"concat('40277', cast(id % {bins} as string)) as BIN",
        f"if(id < {2 * n}, 'NL', 'SE') as billing_address_country", "false as fraud_label")


def test_sketches_merge_within_their_error(spark):
    tx, lg_k, ids = repeated(spark), 12, 6000
    partials = ops.reason_counts(tx, by=("snapshot_month",), lg_k=lg_k)
    got = {r.BIN: r for r in ops.distinct_support_from_partials(partials, ids // 2).collect()}
    exact = {r.BIN: r for r in ops.distinct_support(ops.load_filtered(tx), 1).collect()}
    assert set(got) == set(exact) and {r.distinct_txns for r in exact.values()} == {ids}
    for b, r in got.items():  # merged over months and countries: an id counts once
        assert r.bin_total == exact[b].bin_total == 3 * ids and r.is_supported_distinct
        assert abs(r.distinct_txns / ids - 1) < 4 * 1.04 / math.sqrt(2 ** lg_k)
    assert all(len(r.ids) < 2 ** lg_k * 2 for r in partials.where("ids is not null").collect())


def test_small_sketches_are_exact(spark):
    tx = repeated(spark, bins=40, ids=20)
    partials = ops.reason_counts(tx, by=("snapshot_month",), lg_k=12)
    got = ops.distinct_support_from_partials(partials, 20, by=("snapshot_month",))
    want = ops.distinct_support(ops.load_filtered(tx), 20, by=("snapshot_month",))
    assert rows(got, *want.columns) == rows(want) and got.count() == 80


def test_stream_merges_sketches_of_batches(spark):
    root = shared_dir(spark, "cardgeo", "tests", "ids")
    spec = [("402771", "NL", False)] * 3 + [("402772", "SE", False)] * 2
    for _ in range(3):  # the same transactions land three times, in three batches
        txns(spark, spec).write.mode("append").parquet(f"{root}/landing")
    start_count_stream(spark, f"{root}/landing", f"{root}/partials", f"{root}/ckpt", lg_k=10,
                       max_files_per_trigger=1).awaitTermination()
    compact_partials(spark, f"{root}/partials", f"{root}/compact")
    vendor = spark.createDataFrame([], "BIN string, country string")
    for path in (f"{root}/partials", f"{root}/compact"):
        partials = read_partials(spark, path)
        got = ops.distinct_support_from_partials(partials.where("reason = 'kept'"), 3)
        assert rows(got) == [("402771", 9, 3, True), ("402772", 6, 2, False)]
        for distinct, bins in ((True, ["402771"]), (False, ["402771", "402772"])):
            t = tables(spark)
            publish_months_from_counts(partials, vendor, ["2023-01"], params=Params(min_txns=3), distinct=distinct, **t)
            assert sorted(r.BIN for r in t["flags_table"].read(spark).collect()) == bins


def test_publication_counts_distinct_ids(spark):
    tx = txns(spark, [("402771", "NL", False)] * 4).unionByName(
        spark.createDataFrame([("same", T, "402772", "SE", False)] * 9, TXN_SCHEMA))
    vendor = spark.createDataFrame([], "BIN string, country string")
    t = tables(spark)
    publish_month(tx, vendor, "2023-01", params=Params(min_txns=4), lg_k=12, **t)
    assert rows(t["flags_table"].read(spark), "BIN", "bin_total") == [("402771", 4)]
    assert rows(t["map_table"].read(spark), "BIN", "txn_count") == [("402771", 4)]


def test_job_takes_a_list_and_sketches(spark):
    from cardgeo import job
    root = shared_dir(spark, "cardgeo", "tests", "job")
    txns(spark, SPEC).write.parquet(f"{root}/tx")
    codes(spark, "NL").write.parquet(f"{root}/codes")
    spark.createDataFrame([], "BIN string, country string").write.parquet(f"{root}/vendor")
    args = ["--month", "2023-01", "--transactions", f"{root}/tx", "--vendor", f"{root}/vendor", "--flags-table", f"{root}/flags",
            "--map-table", f"{root}/map", "--min-txns", "1", "--country-codes", f"{root}/codes", "--distinct-lg-k", "12",
            "--run-id", "nightly", "--resume"]
    res = job.main(args, spark)
    assert res[0].run_id == "nightly" and res[0].metrics["unknown_country"] == 3 and res[0].flag_rows == 1
    assert rows(SnapshotTable(f"{root}/flags").read(spark).select(F.col("BIN"))) == [("402771",)]

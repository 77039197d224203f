"""Distribution drift, trends, significance and co-located snapshots."""

import math
import re
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardgeo.operators import (country_drift, discrepancy_significance, flag_discrepancies, snapshot_drift,
                               trend_anomalies)
from cardgeo.schemas import COUNTRY_COUNTS_SCHEMA, FLAGS_SCHEMA
from cardgeo.sinks import BucketedTable, shared_dir
from conftest import rows
from test_plans import plan

MAP = "snapshot_month string, BIN string, country string, txn_count long, bin_total long"


def js(p, pt, q, qt):
    """Jensen-Shannon divergence in bits of two maps' kept counts and rests."""
    names = sorted({*p, *q})
    a = [p.get(c, 0) / pt for c in names] + [(pt - sum(p.values())) / pt]
    b = [q.get(c, 0) / qt for c in names] + [(qt - sum(q.values())) / qt]
    h = lambda v: -sum(x * math.log2(x) for x in v if x > 0)
    return max(0.0, round(h([(x + y) / 2 for x, y in zip(a, b)]) - (h(a) + h(b)) / 2, 9))


def test_country_drift_by_hand(spark):
    top = spark.createDataFrame([
        ("2023-12", "B1", "NL", 90, 100), ("2024-01", "B1", "NL", 90, 100),                       # unmoved
        ("2023-12", "B2", "NL", 10, 10), ("2024-01", "B2", "SE", 10, 10),                         # nothing in common
        ("2023-12", "B3", "NL", 60, 100), ("2023-12", "B3", "SE", 30, 100), ("2024-01", "B3", "NL", 40, 80),
        ("2023-12", "B4", "NL", 5, 5), ("2024-01", "B5", "NL", 5, 5), ("2024-03", "B1", "NL", 9, 10)], MAP)
    got = {(r.snapshot_month, r.BIN): r for r in country_drift(top, 0.1).collect()}
    assert set(got) == {("2024-01", b) for b in ("B1", "B2", "B3")}  # months and BINs that both have
    assert got["2024-01", "B1"].js_divergence == 0 and got["2024-01", "B2"].js_divergence == 1
    b3 = got["2024-01", "B3"]
    assert (b3.prev_total, b3.bin_total) == (100, 80)
    assert b3.js_divergence == pytest.approx(js({"NL": 60, "SE": 30}, 100, {"NL": 40}, 80), abs=2e-9)
    assert [got["2024-01", b].is_shifted for b in ("B1", "B2", "B3")] == [False, True, b3.js_divergence >= 0.1]


counts = st.dictionaries(st.sampled_from("NL SE BE FR DE".split()), st.integers(1, 50), min_size=1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(counts, st.integers(0, 20), counts, st.integers(0, 20)), min_size=1, max_size=12))
def test_country_drift_against_brute_force(spark, bins):
    data, want = [], {}
    for i, (p, pr, q, qr) in enumerate(bins):
        pt, qt = sum(p.values()) + pr, sum(q.values()) + qr
        data += [("2024-05", f"B{i}", c, n, pt) for c, n in p.items()] + [("2024-06", f"B{i}", c, n, qt) for c, n in q.items()]
        want[f"B{i}"] = js(p, pt, q, qt)
    got = {r.BIN: r.js_divergence for r in country_drift(spark.createDataFrame(data, MAP)).collect()}
    assert got == pytest.approx(want, abs=2e-9)


def test_country_drift_exchanges_once(spark):
    path = shared_dir(spark, "cardgeo", "tests", "maps")
    spark.createDataFrame([("2023-12", "B1", "NL", 90, 100)], MAP).write.parquet(path)
    p = plan(country_drift(spark.read.parquet(path)))
    # Each half of the union is dealt by (month, BIN); both aggregates keep that.
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1 and "Join" not in p


def test_trend_jump_and_slow_growth(spark):
    months = [f"2023-{m:02d}" for m in range(1, 13)]
    jump = [100, 103, 98, 101, 99, 102, 100, 450, 101, 99, 100, 102]
    growth = [100 + 5 * i for i in range(12)]
    gaps = [10, None, 11, None, None, 9, 10, None, 40, 10, 11, 10]
    data = [(m, b, v) for b, s in (("J", jump), ("G", growth), ("H", gaps)) for m, v in zip(months, s) if v is not None]
    df = spark.createDataFrame(data + [(None, "J", 5), ("2023-1", "J", 5)], "snapshot_month string, BIN string, volume long")
    got = trend_anomalies(df, "volume").collect()
    assert len(got) == len(data)
    assert {(r.BIN, r.snapshot_month) for r in got if r.is_anomalous} == {("J", "2023-08"), ("H", "2023-09")}
    for r in got:
        at = months.index(r.snapshot_month)
        before = [v for m, b, v in data if b == r.BIN and at - 6 <= months.index(m) < at]
        assert r.n_before == len(before)
        if before:
            med = statistics.median(before)
            assert r.baseline == med and r.mad == statistics.median(abs(v - med) for v in before)
        else:
            assert r.baseline is None and r.mad is None and r.score is None


def test_trend_of_a_flat_series(spark):
    df = spark.createDataFrame([(f"2023-0{m}", "B", v) for m, v in enumerate([7, 7, 7, 7, 8, 7, 11], 1)],
                               "snapshot_month string, BIN string, volume long")
    got = {r.snapshot_month: r for r in trend_anomalies(df, "volume").collect()}
    assert got["2023-05"].score is None and not got["2023-05"].is_anomalous  # within a fifth of the baseline
    assert got["2023-07"].is_anomalous and got["2023-07"].mad == 0
    assert not trend_anomalies(df.where("false"), "volume").collect()


def wilson(k, n, z=1.959963984540054):
    p, mid = k / n, k / n + z * z / (2 * n)
    half = z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (mid - half) / (1 + z * z / n), (mid + half) / (1 + z * z / n)


def test_three_rows_are_not_significant(spark):
    data = [("B1", "NL", 3, 3), ("B2", "NL", 300, 300), ("B3", "NL", 52, 100), ("B3", "SE", 48, 100),
            ("B4", "NL", 90, 100), ("B4", "SE", 10, 100), ("B5", "NL", 9, 9)]
    vendor = spark.createDataFrame([(b, "SE") for b in ("B1", "B2", "B3", "B4")] + [("B5", "NL")], "BIN string, country string")
    got = {r.BIN: r for r in discrepancy_significance(spark.createDataFrame(data, COUNTRY_COUNTS_SCHEMA), vendor).collect()}
    assert {b: r.is_significant for b, r in got.items()} == {"B1": False, "B2": True, "B3": False, "B4": True, "B5": False}
    assert got["B1"].lead_low == pytest.approx(wilson(3, 3)[0], abs=1e-9) and got["B1"].lead_low < 0.5
    assert (got["B4"].vendor_pct_low, got["B4"].vendor_pct_high) == pytest.approx(wilson(10, 100), abs=1e-9)
    assert got["B5"].lead_low is None and got["B1"].is_discrepant


# ------------------------------------------------------- co-located snapshots


def bucketed(spark, name, **kw):
    path = shared_dir(spark, "cardgeo", "tests", name)
    return BucketedTable(f"t_{path.rsplit('/', 1)[1]}", path, buckets=4, **kw)


def flags(spark, n, country="NL"):
    return spark.createDataFrame([(f"B{i}", country, None, False, i) for i in range(n)], FLAGS_SCHEMA)


def exchanges(df):
    return re.findall(r"^\(\d+\) (\w*Exchange\w*)", plan(df), re.M)


def test_drift_of_bucketed_months_needs_no_exchange(spark, monkeypatch):
    t = bucketed(spark, "drift")
    t.write(flags(spark, 40), "2024-01")
    t.write(flags(spark, 30, "SE"), "2024-02")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        drift = snapshot_drift(t.read(spark, "2024-01"), t.read(spark, "2024-02"))
        assert exchanges(drift) == []
        assert {(r.change, r["count"]) for r in drift.groupBy("change").count().collect()} == {("removed", 10), ("country_changed", 30)}
        vendor = bucketed(spark, "vendor", by_month=False)
        vendor.write(spark.createDataFrame([(f"B{i}", "SE") for i in range(50)], "BIN string, country string"))
        top = t.read(spark, "2024-01").select("BIN", F.col("inferred_top_country").alias("country"),
                                              F.col("bin_total").alias("txn_count"), "bin_total")
        compared = flag_discrepancies(top, vendor.read(spark))
        assert exchanges(compared) == [] and compared.where("is_discrepant").count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_month_is_replaced_alone(spark):
    t = bucketed(spark, "replace")
    t.write(flags(spark, 5), "2024-01")
    t.write(flags(spark, 6), "2024-02")
    t.write(flags(spark, 2, "BE"), "2024-01")
    assert rows(t.read(spark, "2024-01"), "BIN", "inferred_top_country") == [("B0", "BE"), ("B1", "BE")]
    assert t.read(spark, "2024-02").count() == 6 and t.read(spark).count() == 8
    assert all("snapshot_month=2024-02" in f for f in t.read(spark, "2024-02").inputFiles())
    with pytest.raises(ValueError):
        t.write(flags(spark, 1), "2024-1")

import datetime as dt

from cardgeo.schemas import TXN_SCHEMA
from cardgeo.sinks import shared_dir
from cardgeo.streaming import counts_from_partials, start_count_stream
from conftest import rows


def land(spark, path, data):
    spark.createDataFrame(data, TXN_SCHEMA).write.mode("append").parquet(path)


def test_incremental_counts_exactly_once(spark):
    root = shared_dir(spark, "cardgeo", "tests", "stream")
    landing, partials, ckpt = f"{root}/landing", f"{root}/partials", f"{root}/_ckpt"
    jan, feb = dt.datetime(2023, 1, 5), dt.datetime(2023, 2, 5)
    land(spark, landing, [("t1", jan, "123456", "US", False), ("t2", jan, "123456", "CA", False),
                          ("t3", jan, "123456", "US", True), ("t4", feb, "123456", "US", False)])
    start_count_stream(spark, landing, partials, ckpt).awaitTermination()
    assert rows(counts_from_partials(spark, partials, "2023-01")) == [
        ("123456", "CA", 1, 2), ("123456", "US", 1, 2)]

    # Re-running with nothing new changes nothing; a late January file adds.
    start_count_stream(spark, landing, partials, ckpt).awaitTermination()
    land(spark, landing, [("t5", jan, "123456", "US", False)])
    start_count_stream(spark, landing, partials, ckpt).awaitTermination()
    assert rows(counts_from_partials(spark, partials, "2023-01")) == [
        ("123456", "CA", 1, 3), ("123456", "US", 2, 3)]
    assert rows(counts_from_partials(spark, partials, "2023-02")) == [("123456", "US", 1, 1)]


def test_publish_from_stream_equals_publish_from_scan(spark):
    from cardgeo import Params
    from cardgeo.plans import publish_months, publish_months_from_counts
    from cardgeo.sinks import SnapshotTable
    from cardgeo.streaming import read_partials

    root = shared_dir(spark, "cardgeo", "tests", "stream")
    landing = f"{root}/landing"
    jan = dt.datetime(2023, 1, 5)
    data = ([(f"a{i}", jan, "123456", "US", False) for i in range(5)]
            + [(f"b{i}", jan, "123456", "CA", i == 0) for i in range(3)]
            + [("c0", jan, "12345", "US", False), ("c1", jan, "654321", None, False)])
    land(spark, landing, data[:4])
    land(spark, landing, data[4:])
    start_count_stream(spark, landing, f"{root}/partials", f"{root}/_ckpt",
                       max_files_per_trigger=1).awaitTermination()
    vendor = spark.createDataFrame([("123456", "CA")], "BIN string, country string")
    kw = dict(params=Params(min_txns=1))

    def tables():
        return dict(flags_table=SnapshotTable(shared_dir(spark, "cardgeo", "tests")),
                    map_table=SnapshotTable(shared_dir(spark, "cardgeo", "tests")))

    a, b = tables(), tables()
    ra = publish_months(spark.read.parquet(landing), vendor, ["2023-01"], **a, **kw)[0]
    rb = publish_months_from_counts(read_partials(spark, f"{root}/partials"), vendor,
                                    ["2023-01"], **b, **kw)[0]
    assert rows(a["flags_table"].read(spark)) == rows(b["flags_table"].read(spark)) == [
        ("123456", "US", "CA", True, 7, "2023-01")]
    assert ra.metrics == rb.metrics
    assert (rb.metrics["rows_in"], rb.metrics["fraud"], rb.metrics["bad_bin_length"],
            rb.metrics["null_country"]) == (10, 1, 1, 1)


def test_strict_stream_and_compaction(spark):
    from cardgeo.streaming import compact_partials, read_partials

    root = shared_dir(spark, "cardgeo", "tests", "stream")
    landing, feb = f"{root}/landing", dt.datetime(2023, 2, 5)
    land(spark, landing, [("t1", feb, "402771", "NL", False), ("t2", feb, "40277x", "NL", False)])
    land(spark, landing, [("t3", feb, "402771", "NL", False), ("t4", None, "402771", "NL", False)])
    start_count_stream(spark, landing, f"{root}/partials", f"{root}/_ckpt", strict=True,
                       max_files_per_trigger=1).awaitTermination()
    want = [("2023-02", "402771", "NL", 2, 2)]
    assert rows(counts_from_partials(spark, f"{root}/partials")) == want
    compact_partials(spark, f"{root}/partials", f"{root}/compacted")
    got = read_partials(spark, f"{root}/compacted")
    assert rows(got, "snapshot_month", "reason", "BIN", "n") == [
        ("2023-02", "bad_bin_format", None, 1), ("2023-02", "kept", "402771", 2),
        (None, "null_timestamp", None, 1)]
    assert rows(counts_from_partials(spark, f"{root}/compacted")) == want

"""Attempts of a run, what readers see of them, reconciliation and resuming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardgeo import Params
from cardgeo.operators import apply_changes
from cardgeo.plans import DataQualityError, publish_month
from cardgeo.plans import publish as publishing
from cardgeo.schemas import FLAGS_SCHEMA, TXN_SCHEMA
from cardgeo.sinks import SnapshotTable, matching_paths, path_matches, remove_dir, shared_dir
from conftest import rows

T = dt.datetime(2023, 1, 10)
KEYS = ("snapshot_month", "BIN")


def flags(spark, spec):
    return spark.createDataFrame([(b, c, None, False, n) for b, c, n in spec], FLAGS_SCHEMA)


def txns(spark, spec):
    data = [(f"{b}-{c}-{i}", T, b, c, False) for b, c, n in spec for i in range(n)]
    return spark.createDataFrame(data, TXN_SCHEMA)


def tables(spark):
    return {k: SnapshotTable(shared_dir(spark, "cardgeo", "tests")) for k in ("flags_table", "map_table")}


def vendor(spark):
    return spark.createDataFrame([("402771", "BE")], "BIN string, country string")


def test_refused_rerun_under_the_same_id_changes_nothing(spark):
    t = tables(spark)
    kw = dict(t, params=Params(min_txns=1), run_id="job-1")
    publish_month(txns(spark, [("402771", "NL", 6), ("402772", "SE", 4)]), vendor(spark), "2023-01", **kw)
    before = rows(t["flags_table"].read(spark)), rows(t["map_table"].read(spark))
    bad = txns(spark, [("402771", "USA", 6), ("402772", "USA", 4)])
    with pytest.raises(DataQualityError) as e:
        publish_month(bad, vendor(spark), "2023-01", **kw)
    assert e.value.violations["bad_country_code"] == 2
    assert (rows(t["flags_table"].read(spark)), rows(t["map_table"].read(spark))) == before
    assert t["flags_table"].runs(spark).count() == 1


def test_rerun_leaves_earlier_times_as_they_were(spark, table_root):
    t = SnapshotTable(table_root)
    first = t.write(flags(spark, [("B1", "NL", 3), ("B2", "SE", 4)]), "2023-01", run_id="job-1")
    second = t.write(flags(spark, [("B1", "BE", 9)]), "2023-01", run_id="job-1")
    assert rows(t.read(spark, as_of=first.committed_at), "BIN", "bin_total") == [("B1", 3), ("B2", 4)]
    assert rows(t.read(spark), "BIN", "inferred_top_country") == [("B1", "BE")]
    assert second.attempt > first.attempt and t.runs(spark).count() == 2
    # as of the run id: its last commit
    assert rows(t.read(spark, as_of_run="job-1"), "BIN") == [("B1",)]
    assert t.prune(spark) == [("2023-01", "job-1")]
    assert rows(t.read(spark), "BIN") == [("B1",)]


def test_map_waits_for_the_same_attempt_of_the_flags(spark, monkeypatch):
    t = tables(spark)
    kw = dict(t, params=Params(min_txns=1), run_id="job-2")
    publish_month(txns(spark, [("402771", "NL", 6)]), vendor(spark), "2023-01", **kw)
    plain = SnapshotTable.commit

    def commit(self, staged, **more):
        if self == t["flags_table"]:
            raise OSError("no ledger append")
        return plain(self, staged, **more)

    monkeypatch.setattr(SnapshotTable, "commit", commit)
    with pytest.raises(OSError):
        publish_month(txns(spark, [("402771", "SE", 6)]), vendor(spark), "2023-01", **kw)
    monkeypatch.undo()
    # The map's second attempt is in its ledger, but the flags have only the first.
    assert rows(t["map_table"].read(spark), "country") == [("NL",)]
    assert rows(t["flags_table"].read(spark), "inferred_top_country") == [("NL",)]


def test_sweep_deletes_only_abandoned_attempts(spark, table_root):
    t = SnapshotTable(table_root)
    kept = t.write(flags(spark, [("B1", "NL", 3)]), "2023-01", run_id="job-1")
    staged = t.stage(flags(spark, [("B2", "NL", 3)]), "2023-01", run_id="job-1")
    assert t.sweep(spark) == []  # it may still be running
    gone = t.sweep(spark, dt.timedelta(0))
    assert len(gone) == 1 and gone[0].endswith(f"attempt={staged.attempt}")
    assert rows(t.read(spark), "BIN") == [("B1",)]
    assert len(matching_paths(spark, f"{t.data_path}/*/*/attempt={kept.attempt}")) == 1


def test_runs_of_the_earlier_layout_are_read(spark, table_root):
    """Files right under run_id=…, and ledger rows that name no attempt."""
    from cardgeo.schemas import LEDGER_SCHEMA
    from cardgeo.sinks import literal_rows
    t = SnapshotTable(table_root)
    old = flags(spark, [("B1", "NL", 3)])
    old.coalesce(1).write.parquet(f"{t.data_path}/snapshot_month=2023-01/run_id=old")
    at = dt.datetime(2023, 2, 1, tzinfo=dt.timezone.utc)
    literal_rows(spark, [("2023-01", "old", at, 1, old.schema.json(), {"rows_in": 1}, None)],
                 LEDGER_SCHEMA).write.parquet(t.ledger_path)
    assert rows(t.read(spark), "BIN", "snapshot_month") == [("B1", "2023-01")]
    t.write(flags(spark, [("B2", "NL", 3)]), "2023-02")
    assert rows(t.read(spark), "BIN", "snapshot_month") == [("B1", "2023-01"), ("B2", "2023-02")]
    t.write(flags(spark, [("B3", "NL", 3)]), "2023-01", run_id="old")
    assert rows(t.read(spark), "BIN") == [("B2",), ("B3",)] and rows(t.read(spark, as_of=at), "BIN") == [("B1",)]
    assert t.verify(spark).count() == 0 and t.verify(spark, as_of=at).count() == 0


def test_verify_finds_changed_lost_and_added_rows(spark, table_root):
    t = SnapshotTable(table_root)
    months = ["2023-01", "2023-02", "2023-03", "2023-04"]
    df = flags(spark, [(f"B{i}", None if i % 3 else "NL", i) for i in range(12)])
    t.write_months(df.withColumn("snapshot_month", F.concat(F.lit("2023-0"), (F.col("bin_total") % 4 + 1).cast("string"))), months)
    assert t.verify(spark).count() == 0
    path = {r.snapshot_month: t._run_path(r) for r in t.current_runs(spark)}
    now = {m: spark.read.parquet(p).collect() for m, p in path.items()}
    other = lambda m, rs: spark.createDataFrame(rs, FLAGS_SCHEMA).write.mode("overwrite").parquet(path[m])
    swapped = [(r.BIN, r.vendor_country, r.inferred_top_country, r.is_discrepant, r.bin_total) for r in now["2023-02"]]
    other("2023-02", swapped)  # a value in another column: nulls must not hide it
    other("2023-03", now["2023-03"] + now["2023-03"])
    remove_dir(spark, path["2023-04"])
    assert rows(t.verify(spark), "snapshot_month", "row_count", "found_rows", "same_rows") == [
        ("2023-02", 3, 3, False), ("2023-03", 3, 6, False), ("2023-04", 3, 0, False)]
    assert t.verify(spark, ["2023-01"]).count() == 0


@pytest.mark.parametrize("stage", ["counts", "map", "flags"])
def test_tampered_stage_fails_the_gate(spark, monkeypatch, stage):
    t = tables(spark)

    def tamper(path):
        held = shared_dir(spark, "cardgeo", "tests", "tampered")
        n = "n" if stage == "counts" else "bin_total"
        spark.read.parquet(path).withColumn(n, F.col(n) + 1).write.parquet(held)
        spark.read.parquet(held).write.mode("overwrite").parquet(path)

    if stage == "counts":
        plain = publishing._stage_counts

        def staged_counts(tx, months, work, *a, **kw):
            _, n, checksum = plain(tx, months, work, *a, **kw)
            tamper(f"{work}/counts")
            return spark.read.parquet(f"{work}/counts"), n, checksum

        monkeypatch.setattr(publishing, "_stage_counts", staged_counts)
    else:
        plain = SnapshotTable.stage_months

        def stage_months(self, *a, **kw):
            out = plain(self, *a, **kw)
            if self == t[f"{stage}_table"]:
                tamper(matching_paths(spark, f"{self.data_path}/*/*/attempt={out.attempt}")[0])
            return out

        monkeypatch.setattr(SnapshotTable, "stage_months", stage_months)
    with pytest.raises(DataQualityError) as e:
        publish_month(txns(spark, [("402771", "NL", 6)]), vendor(spark), "2023-01", params=Params(min_txns=1), **t)
    assert e.value.violations[f"{stage}_checksum"] == 1
    assert t["flags_table"].read(spark).count() == 0


def test_failed_run_resumes_without_a_second_scan(spark, monkeypatch):
    t = tables(spark)
    kw = dict(t, params=Params(min_txns=1), run_id="job-3")
    tx = txns(spark, [("402771", "NL", 6), ("402771", "BE", 2)])
    plain = SnapshotTable.stage_months

    def fail(self, *a, **more):
        raise OSError("no disk")

    monkeypatch.setattr(SnapshotTable, "stage_months", fail)
    with pytest.raises(OSError):
        publish_month(tx, vendor(spark), "2023-01", **kw)
    monkeypatch.setattr(SnapshotTable, "stage_months", plain)
    unreadable = tx.withColumn("BIN", F.raise_error(F.lit("a second raw scan")).cast("string"))
    with pytest.raises(Exception, match="second raw scan"):  # other parameters: its counts do not fit
        publish_month(unreadable, vendor(spark), "2023-01", resume=True, strict=True, **kw)
    with pytest.raises(OSError):
        monkeypatch.setattr(SnapshotTable, "stage_months", fail)
        publish_month(tx, vendor(spark), "2023-01", **kw)
    monkeypatch.undo()
    res = publish_month(unreadable, vendor(spark), "2023-01", resume=True, **kw)
    assert (res.flag_rows, res.metrics["kept"], res.metrics["rows_in"]) == (1, 8, 8)
    assert rows(t["map_table"].read(spark), "country", "txn_count") == [("BE", 2), ("NL", 6)]
    assert path_matches(spark, publishing.work_dir(spark, t["map_table"], "job-3")) is False
    with pytest.raises(ValueError, match="run_id"):
        publish_month(tx, vendor(spark), "2023-01", resume=True, **t)


def test_refused_run_is_not_resumed(spark):
    t = tables(spark)
    kw = dict(t, params=Params(min_txns=1), run_id="job-4")
    with pytest.raises(DataQualityError):
        publish_month(txns(spark, [("402771", "NLD", 3)]), vendor(spark), "2023-01", **kw)
    res = publish_month(txns(spark, [("402771", "NL", 3)]), vendor(spark), "2023-01", resume=True, **kw)
    assert not any(res.violations.values()) and rows(t["flags_table"].read(spark), "inferred_top_country") == [("NL",)]


def test_change_feed_between_versions(spark, table_root):
    t = SnapshotTable(table_root)
    first = t.write(flags(spark, [("B1", "NL", 3), ("B2", "SE", 4), ("B3", None, 5), (None, "NO", 6)]), "2023-01")
    same = t.write(flags(spark, [("B1", "NL", 3)]), "2023-02")
    again = flags(spark, [("B1", "NL", 3), ("B3", "NO", 5), ("B4", "SE", 4), (None, "NO", 7)])
    t.write(again.withColumn("extra", F.when(F.col("BIN") == "B1", F.lit(1))), "2023-01")
    since = {"as_of": same.committed_at}
    feed = t.changes(spark, since)
    assert rows(feed, "BIN", "change", "inferred_top_country", "bin_total", "extra") == [
        ("B1", "update", "NL", 3, 1), ("B2", "delete", None, None, None), ("B3", "update", "NO", 5, None),
        ("B4", "insert", "SE", 4, None), (None, "update", "NO", 7, None)]
    assert all("snapshot_month=2023-02" not in f for f in feed.inputFiles())  # the same attempt: not read
    applied = apply_changes(t.read(spark, **since), feed, KEYS)
    cols = t.read(spark).columns
    assert rows(applied, *cols) == rows(t.read(spark), *cols)
    assert t.changes(spark, {"as_of": first.committed_at}, {"as_of_run": same.run_id}).count() == 1
    assert t.changes(spark, {}).count() == 0

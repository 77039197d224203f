import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardgeo.schemas import FLAGS_SCHEMA, SNAPSHOT_SCHEMA, names_and_types
from cardgeo.sinks import SnapshotTable
from conftest import rows


def flags(spark, bins):
    return spark.createDataFrame([(b, "US", "US", False, 100) for b in bins], FLAGS_SCHEMA)


def bins_of(df, month):
    return sorted(r.BIN for r in df.where(F.col("snapshot_month") == month).collect())


def test_round_trip_schema(spark, table_root):
    t = SnapshotTable(table_root)
    t.write(flags(spark, ["B1"]), "2023-01")
    df = t.read(spark)
    assert names_and_types(df.schema) == names_and_types(SNAPSHOT_SCHEMA)
    assert rows(df) == [("B1", "US", "US", False, 100, "2023-01")]


@pytest.mark.parametrize("versioned", [True, False])
def test_month_overwrite_keeps_other_months(spark, table_root, versioned):
    t = SnapshotTable(table_root, versioned=versioned)
    t.write(flags(spark, ["B1", "B2"]), "2023-01")
    t.write(flags(spark, ["B3"]), "2023-02")
    t.write(flags(spark, ["B1", "B4"]), "2023-01")
    df = t.read(spark)
    assert bins_of(df, "2023-01") == ["B1", "B4"]
    assert bins_of(df, "2023-02") == ["B3"]
    assert bins_of(t.read_month(spark, "2023-01"), "2023-01") == ["B1", "B4"]


def test_history_as_of(spark, table_root):
    t = SnapshotTable(table_root)
    first = t.write(flags(spark, ["B1", "B2"]), "2023-01")
    t.write(flags(spark, ["B9"]), "2023-01")
    assert bins_of(t.read(spark), "2023-01") == ["B9"]
    assert bins_of(t.read(spark, as_of_run=first.run_id), "2023-01") == ["B1", "B2"]
    assert bins_of(t.read(spark, as_of=first.committed_at), "2023-01") == ["B1", "B2"]
    assert t.ledger(spark).count() == 2
    assert [r.row_count for r in t.runs(spark, "2023-01").collect()] == [1, 2]


def test_schema_evolution_older_month_reads_null(spark, table_root):
    t = SnapshotTable(table_root)
    t.write(flags(spark, ["B1"]).withColumn("new_col", F.lit(7)), "2023-01")
    t.write(flags(spark, ["B2"]), "2023-02")
    df = t.read(spark)
    assert "new_col" in df.columns
    assert df.where("snapshot_month = '2023-02' and new_col IS NULL").count() == 1
    assert df.where("snapshot_month = '2023-01' and new_col = 7").count() == 1


def test_empty_first_write_then_month(spark, table_root):
    t = SnapshotTable(table_root)
    t.write(flags(spark, []), "2023-01")
    assert t.read(spark).count() == 0
    t.write(flags(spark, ["B1"]), "2023-02")
    df = t.read(spark)
    assert bins_of(df, "2023-01") == [] and bins_of(df, "2023-02") == ["B1"]


@pytest.mark.parametrize("versioned", [True, False])
def test_empty_rerun_hides_old_rows(spark, table_root, versioned):
    t = SnapshotTable(table_root, versioned=versioned)
    first = t.write(flags(spark, ["B1"]), "2023-02")
    t.write(flags(spark, []), "2023-02")
    assert t.read(spark).count() == 0
    if versioned:
        assert bins_of(t.read(spark, as_of_run=first.run_id), "2023-02") == ["B1"]


def test_bad_months_rejected(spark, table_root):
    t = SnapshotTable(table_root)
    for bad in ["2023/01", "202301", "23-01", "2023-1", "2023-001", "2023-13", "abcd-xy"]:
        with pytest.raises(ValueError):
            t.write(flags(spark, ["B1"]), bad)


def test_staged_run_invisible_until_commit(spark, table_root):
    t = SnapshotTable(table_root)
    staged = t.stage(flags(spark, ["B1"]), "2023-01")
    assert t.read(spark).count() == 0
    assert t.read_run(spark, staged).count() == 1
    t.commit(staged)
    assert t.read(spark).count() == 1


def test_write_months_one_job(spark, table_root):
    t = SnapshotTable(table_root)
    df = flags(spark, ["B1", "B2"]).withColumn(
        "snapshot_month", F.when(F.col("BIN") == "B1", "2023-01").otherwise("2023-02"))
    commits = t.write_months(df, ["2023-01", "2023-02", "2023-03"])
    assert {c.snapshot_month: c.row_count for c in commits} == {
        "2023-01": 1, "2023-02": 1, "2023-03": 0}
    assert len({c.run_id for c in commits}) == 1
    assert t.read(spark).count() == 2


def test_unversioned_write_months_and_limits(spark, table_root):
    t = SnapshotTable(table_root, versioned=False)
    df = flags(spark, ["B1", "B2"]).withColumn(
        "snapshot_month", F.when(F.col("BIN") == "B1", "2023-01").otherwise("2023-02"))
    with pytest.raises(ValueError):
        t.write_months(df)  # an unversioned run must name the months it replaces
    t.write_months(df, ["2023-01", "2023-02"])
    t.write_months(df.where("BIN = 'B2'"), ["2023-01", "2023-02"])  # 2023-01 now empty
    assert bins_of(t.read(spark), "2023-01") == [] and bins_of(t.read(spark), "2023-02") == ["B2"]
    with pytest.raises(ValueError):
        t.read(spark, as_of_run="x")
    with pytest.raises(ValueError):
        t.stage(flags(spark, ["B1"]), "2023-01")


def test_read_subset_of_months_and_metrics_in_ledger(spark, table_root):
    t = SnapshotTable(table_root)
    for m, b in [("2023-01", "B1"), ("2023-02", "B2"), ("2023-03", "B3")]:
        t.write(flags(spark, [b]), m, metrics={"rows_in": 10})
    assert rows(t.read(spark, ["2023-03", "2023-01"]), "BIN") == [("B1",), ("B3",)]
    assert {r.metrics["rows_in"] for r in t.ledger(spark).collect()} == {10}


def test_path_matches_plain_and_glob(spark, table_root):
    from cardgeo.sinks import path_matches
    t = SnapshotTable(table_root)
    assert path_matches(spark, t.ledger_path) is False
    assert t.ledger(spark).count() == 0  # a new table reads as no runs
    c = t.write(flags(spark, ["B1"]), "2023-01")
    assert path_matches(spark, t.ledger_path) is True
    assert path_matches(spark, f"{t.data_path}/snapshot_month=*/run_id={c.run_id}") is True
    assert path_matches(spark, f"{t.data_path}/snapshot_month=*/run_id=none") is False


def test_literal_rows_match_declared_schema(spark):
    import datetime as dt
    from cardgeo.schemas import LEDGER_SCHEMA
    from cardgeo.sinks import literal_rows
    at = dt.datetime(2024, 2, 1, 12, 0)
    got = [("2024-01", "r1", at, 5, "{}", {"a": 1, "b": 2 ** 40}, None),
           ("2024-02", "r1", at, 0, "{}", {}, "/other/_ledger")]
    df = literal_rows(spark, got, LEDGER_SCHEMA)
    assert names_and_types(df.schema) == names_and_types(LEDGER_SCHEMA)
    assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in df.collect()] == got
    assert literal_rows(spark, [], LEDGER_SCHEMA).count() == 0
    planted = literal_rows(spark, [("B1", None, "US", True, 7)], FLAGS_SCHEMA)
    assert rows(planted) == [("B1", None, "US", True, 7)]


_text = st.text(st.characters(blacklist_categories=("Cs",)), max_size=30)
_ledger_rows = st.lists(st.tuples(
    _text, _text,
    st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1),
                 timezones=st.just(dt.timezone.utc)),
    st.integers(-2 ** 63, 2 ** 63 - 1),
    _text,
    st.one_of(st.none(), st.dictionaries(_text, st.integers(-2 ** 63, 2 ** 63 - 1), max_size=4)),
    st.one_of(st.none(), _text),
), min_size=1, max_size=5)


@settings(max_examples=20, deadline=None)
@given(_ledger_rows)
def test_literal_rows_round_trip(spark, got):
    """Any text (quotes, backslashes, unicode), full-range bigints, nulls,
    microsecond timestamps and maps come back exactly."""
    from cardgeo.schemas import LEDGER_SCHEMA
    from cardgeo.sinks import literal_rows
    back = [tuple(r) for r in literal_rows(spark, got, LEDGER_SCHEMA).collect()]
    # collected timestamps are naive local time, as createDataFrame takes them
    want = [(m, r, at.astimezone().replace(tzinfo=None), n, s, mt, q) for m, r, at, n, s, mt, q in got]
    assert back == want


def test_same_run_id_replaces_its_rows(spark, table_root):
    t = SnapshotTable(table_root)
    t.write(flags(spark, ["B1", "B2"]), "2023-01", run_id="r1")
    t.write(flags(spark, ["B3"]), "2023-02")
    t.write(flags(spark, ["B2"]), "2023-01", run_id="r1")
    assert bins_of(t.read(spark), "2023-01") == ["B2"] and bins_of(t.read(spark), "2023-02") == ["B3"]


def test_as_of_run_goes_by_commit_not_by_name(spark, table_root):
    t = SnapshotTable(table_root)
    early = t.stage(flags(spark, ["B1"]), "2023-01", run_id="a")
    t.write(flags(spark, ["B2"]), "2023-01", run_id="b")
    t.commit(early)
    assert bins_of(t.read(spark, as_of_run="b"), "2023-01") == ["B2"]
    assert bins_of(t.read(spark, as_of_run="a"), "2023-01") == ["B1"]
    with pytest.raises(ValueError, match="no committed run"):
        t.read(spark, as_of_run="c")


def test_rows_without_month_are_left_out_and_counted(spark, table_root):
    t = SnapshotTable(table_root)
    df = flags(spark, ["B1", "B2", "B3"]).withColumn(
        "snapshot_month", F.when(F.col("BIN") != "B2", F.lit("2023-01")))
    t.write_months(df)
    assert bins_of(t.read(spark), "2023-01") == ["B1", "B3"]
    assert t.ledger(spark).first().metrics["null_month_rows"] == 1
    with pytest.raises(ValueError, match="month"):
        t.write_months(flags(spark, ["B1"]).withColumn("snapshot_month", F.lit("2023-1")))
    assert t.read(spark).count() == 2


def test_changed_column_type_is_refused_and_widening_is_read(spark, table_root):
    t = SnapshotTable(table_root)
    t.write(flags(spark, ["B1"]).withColumn("x", F.lit(3).cast("int")), "2023-01")
    with pytest.raises(ValueError, match="changes type"):
        t.write(flags(spark, ["B1"]).withColumn("x", F.lit("a")), "2023-02")
    t.write(flags(spark, ["B1"]).withColumn("x", F.lit(1 << 40)), "2023-02")
    assert rows(t.read(spark), "snapshot_month", "x") == [("2023-01", 3), ("2023-02", 1 << 40)]


def test_prune_keeps_the_newest_runs(spark, table_root):
    t = SnapshotTable(table_root)
    first = t.write(flags(spark, ["B1"]), "2023-01")
    t.write(flags(spark, ["B2"]), "2023-01")
    t.write(flags(spark, ["B3"]), "2023-02")
    assert t.prune(spark, keep=2) == []
    assert t.prune(spark) == [("2023-01", first.run_id)]
    assert bins_of(t.read(spark), "2023-01") == ["B2"] and bins_of(t.read(spark), "2023-02") == ["B3"]
    with pytest.raises(ValueError):
        t.prune(spark, keep=0)

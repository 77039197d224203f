"""Monthly snapshot tables with version history, without a table format.

Layout under ``root``::

    data/snapshot_month=YYYY-MM/run_id=<run>/attempt=<n>/part-*.parquet   (versioned)
    data/snapshot_month=YYYY-MM/part-*.parquet                            (versioned=False)
    _ledger/part-*.parquet     one row per committed run and month

A run writes its files with Spark's commit protocol (task retries after a
lost executor are handled there), then appends one ledger row. Readers take,
per month, the latest committed run from the ledger and read exactly those
partition directories, so failed attempts are invisible, an empty re-run
hides the month's older rows, and earlier runs stay readable "as of" a time
or run. The ledger also stores each run's schema, so reads get a declared
schema (no footer sampling) and older months read null for newer columns.

A run id may be repeated (a scheduler retries under its own id): every attempt
writes its own files and the ledger names the attempt, so an attempt that is
refused, fails or is still running changes nothing that was committed, under
its id or any other. Two tables commit as one: the first one's ledger rows name
the second table's ledger (``requires``), and count only once the same attempt
of the run is in that ledger too. Rows without a month belong to no partition;
they are left out and counted in the ledger metric ``null_month_rows``.

The ledger keeps, per run and month, the rows written and an order-free
checksum of them (metric ``checksum``), taken while they were written;
:meth:`SnapshotTable.verify` recomputes both from the files.

The ledger grows by one row per run (months x re-runs), not with the data; it
is the only thing brought to the driver, once per operation. One writer per
month at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import random
import time
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import xor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..functions import row_hash
from ..operators import row_changes
from ..params import validate_month
from ..schemas import LEDGER_SCHEMA

PARTITION_COLS = ("snapshot_month", "run_id", "attempt")


#: Months of a run whose rows are told apart while they are written.
OBSERVED_MONTHS = 12


def new_run_id(now: dt.datetime | None = None) -> str:
    """Sortable, unique and never all digits (so it stays a string)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S%fZ") + "-" + uuid.uuid4().hex[:8]


def new_attempt() -> int:
    """A number for one attempt of a run: microseconds, then ten random bits.
    Later attempts have larger numbers, and no file system is asked."""
    return time.time_ns() // 1000 << 10 | random.getrandbits(10)


def attempt_time(attempt: int) -> dt.datetime:
    return dt.datetime.fromtimestamp((attempt >> 10) / 1e6, dt.timezone.utc)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's ``spark.checkpoint.dir`` (conf first; the context's
    setting where a classic SparkContext is available)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # e.g. Spark Connect sessions have no SparkContext
        return None


def _hadoop_path(spark: SparkSession, path: str):
    """``(FileSystem, Path)`` of ``path`` through a classic session's
    gateway; ``None`` where there is none (e.g. Spark Connect)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_matches(spark: SparkSession, pattern: str) -> bool | None:
    """Whether ``pattern`` (a path or a glob) names anything; ``None`` when
    the file system is not reachable, and callers then read and catch
    ``PATH_NOT_FOUND``. Asking first keeps an expected miss -- a table's
    first run, a run that wrote no rows -- out of the query listeners,
    which log every failed analysis once an ``Observation`` has run."""
    fsp = _hadoop_path(spark, pattern)
    if fsp is None:
        return None
    found = fsp[0].globStatus(fsp[1])
    return found is not None and len(found) > 0


def remove_dir(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` recursively; ``False`` if the file system is not
    reachable (nothing deleted)."""
    fsp = _hadoop_path(spark, path)
    return fsp is not None and bool(fsp[0].delete(fsp[1], True))


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """What ``pattern`` (a glob) names; none where the file system is not reachable."""
    fsp = _hadoop_path(spark, pattern)
    found = fsp and fsp[0].globStatus(fsp[1])
    return [f.getPath().toString() for f in found or []]


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Never a machine-local temporary folder: all executors and the driver
    must see what is written there.
    """
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    return "/".join([base.rstrip("/"), *parts, uuid.uuid4().hex])


@dataclass(frozen=True)
class Commit:
    snapshot_month: str
    run_id: str
    committed_at: dt.datetime
    row_count: int
    attempt: int | None = None


class Run(NamedTuple):
    """A visible ledger row."""

    snapshot_month: str
    run_id: str
    attempt: int | None
    committed_at: dt.datetime
    row_count: int
    schema_json: str
    metrics: dict

    @property
    def order(self):
        return self.committed_at, self.run_id, self.attempt or 0


@dataclass(frozen=True)
class StagedRun:
    table: "SnapshotTable"
    months: tuple
    run_id: str
    counts: dict
    schema_json: str
    metrics: dict
    attempt: int | None = None
    checksums: dict = field(default_factory=dict)
    spark: SparkSession = field(repr=False, compare=False, default=None)

    @property
    def checksum(self) -> int:
        """Of all months' rows."""
        return reduce(xor, self.checksums.values(), 0)


@dataclass(frozen=True)
class SnapshotTable:
    root: str
    versioned: bool = True
    fmt: str = "parquet"

    @property
    def data_path(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    @property
    def ledger_path(self) -> str:
        return f"{self.root.rstrip('/')}/_ledger"

    # ------------------------------------------------------------ write

    def write(self, df: DataFrame, month: str, *, run_id: str | None = None,
              metrics: dict[str, int] | None = None) -> Commit:
        """Publish ``df`` as the new content of ``month``."""
        validate_month(month)
        out = df.withColumn("snapshot_month", F.lit(month))
        return self._write(out, [month], run_id, metrics)[0]

    def write_months(self, df: DataFrame, months=None, *, run_id: str | None = None,
                     metrics: dict[str, int] | None = None) -> list[Commit]:
        """Publish several months in one job; ``df`` has ``snapshot_month``.

        ``months`` are the months this run replaces (a listed month with no
        rows is committed as empty); default: the months present in ``df``.
        """
        return self.commit(self.stage_months(df, months, run_id=run_id, metrics=metrics))

    def stage_months(self, df: DataFrame, months=None, *, run_id: str | None = None,
                     metrics: dict[str, int] | None = None, attempt: int | None = None) -> "StagedRun":
        """Like :meth:`write_months` but without committing (see :meth:`stage`).
        Tables that commit as one (``requires``) share an ``attempt``."""
        if "snapshot_month" not in df.columns:
            raise ValueError("write_months needs a snapshot_month column")
        if months is not None:
            months = [validate_month(m) for m in months]
            df = df.where(F.col("snapshot_month").isin(months))
        # Rebalance by month: each task writes about one month (files ~
        # months, not tasks x months); AQE coalesces small months and splits
        # an oversized one by the advisory partition size, so no month ends
        # up whole in one task. No sampling job either (a range partitioner
        # re-runs its input stage once to sample the bounds).
        return self._stage(df.hint("rebalance", "snapshot_month"), months, run_id, metrics, attempt)

    def prune(self, spark: SparkSession, keep: int = 1) -> list[tuple[str, str]]:
        """Delete the files of all but each month's ``keep`` newest runs and
        return ``(month, run id)`` of those deleted. Their ledger rows stay as
        history; a read as of a deleted run fails on its missing path."""
        if keep < 1:
            raise ValueError("keep at least one run per month")
        by_month: dict[str, list[Run]] = {}
        for r in sorted(self._entries(spark), key=lambda r: r.order, reverse=True):
            by_month.setdefault(r.snapshot_month, []).append(r)
        gone = [r for runs in by_month.values() for r in runs[keep:]]
        deleted = []
        for r in gone:
            found = matching_paths(spark, self._run_path(r))
            for path in found:
                remove_dir(spark, path)
            if found or _hadoop_path(spark, self.root) is None:
                deleted.append((r.snapshot_month, r.run_id))
        return sorted(deleted)

    def sweep(self, spark: SparkSession, older_than: dt.timedelta = dt.timedelta(days=2)) -> list[str]:
        """Delete the files of attempts that were never committed and began
        longer ago than ``older_than`` (younger ones may still be running);
        returns their paths."""
        known = {(r["snapshot_month"], r["run_id"], _attempt(r)) for r in self.ledger(spark).collect()}
        before = dt.datetime.now(dt.timezone.utc) - older_than
        gone = []
        for path in matching_paths(spark, f"{self.data_path}/snapshot_month=*/run_id=*/attempt=*"):
            month, run, attempt = (part.split("=", 1)[1] for part in path.rstrip("/").split("/")[-3:])
            if (month, run, int(attempt)) not in known and attempt_time(int(attempt)) < before:
                remove_dir(spark, path)
                gone.append(path)
        return sorted(gone)

    def _write(self, out: DataFrame, months, run_id, metrics) -> list[Commit]:
        return self.commit(self._stage(out, months, run_id, metrics))

    def stage(self, df: DataFrame, month: str, *, run_id: str | None = None,
              metrics: dict[str, int] | None = None) -> "StagedRun":
        """Write a run's files without committing it (versioned tables):
        readers do not see it until :meth:`commit`; an abandoned stage stays
        invisible. ``read_run`` reads it back, e.g. to cut lineage."""
        if not self.versioned:
            raise ValueError("staging needs a versioned table")
        validate_month(month)
        return self._stage(df.withColumn("snapshot_month", F.lit(month)), [month], run_id, metrics)

    def _stage(self, out: DataFrame, months, run_id, metrics, attempt=None) -> "StagedRun":
        run_id = run_id or new_run_id()
        attempt = (attempt or new_attempt()) if self.versioned else None
        metrics = dict(metrics or {})
        out = out.drop("run_id", "attempt")
        schema_json = out.drop("snapshot_month").schema.json()
        self._check_types(out.sparkSession, schema_json)
        hashed = row_hash(out.drop("snapshot_month").schema)
        here = lambda m: F.col("snapshot_month") == F.lit(m)
        if months is None and not self.versioned:
            raise ValueError("an unversioned table needs the list of months a run replaces")
        # Rows and checksum taken while writing: of each month, or of a long
        # list's rows together (an expression per month and row costs more than
        # the look at the written files that then tells the months apart).
        each = months is not None and (len(months) <= OBSERVED_MONTHS or not self.versioned)
        obs = Observation(f"snapshot-{run_id}")
        known = F.col("snapshot_month").isNotNull()
        out = out.observe(obs, F.sum(F.when(known, 0).otherwise(1)).alias("none"),
                          F.sum(F.when(known, 1).otherwise(0)).alias("n"), F.bit_xor(F.when(known, hashed)).alias("x"),
                          *([F.sum(F.when(here(m), 1).otherwise(0)).alias(f"m{i}") for i, m in enumerate(months)] if each else []),
                          *([F.bit_xor(F.when(here(m), hashed)).alias(f"x{i}") for i, m in enumerate(months)] if each else []))
        out = out.where(known)
        writer_df = (out.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt).cast("long")})
                     if self.versioned else out)
        (writer_df.write.format(self.fmt)
         # Only this attempt's partitions; concurrent writers stage apart.
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*(PARTITION_COLS if self.versioned else PARTITION_COLS[:1])).save(self.data_path))
        got = obs.get
        if each:
            counts = {m: int(got.get(f"m{i}") or 0) for i, m in enumerate(months)}
            checksums = {m: int(got.get(f"x{i}") or 0) for i, m in enumerate(months)}
        else:
            counts, checksums = self._written(out.sparkSession, run_id, attempt, schema_json, F.bit_xor(hashed))
            if (sum(counts.values()), reduce(xor, checksums.values(), 0)) != (int(got.get("n") or 0), int(got.get("x") or 0)):
                raise RuntimeError(f"files of run {run_id!r}, attempt {attempt}, are not what was written")
            if months is None:
                metrics["null_month_rows"] = int(got.get("none") or 0)
            months = [validate_month(m) for m in (sorted(counts) if months is None else months)]
        return StagedRun(self, tuple(months), run_id, counts, schema_json, metrics, attempt, checksums,
                         out.sparkSession)

    def _check_types(self, spark, schema_json: str) -> None:
        """New columns and safe widening may join a table; any other change of
        a column's type would make its older months unreadable."""
        known = {r.schema_json for r in self.current_runs(spark)}
        _merged_schema([*sorted(known), schema_json])

    def commit(self, staged: "StagedRun", metrics: dict[str, int] | None = None,
               month_metrics: dict[str, dict[str, int]] | None = None,
               requires: "SnapshotTable | None" = None) -> list[Commit]:
        """Append the staged run's ledger rows: from now on readers see it --
        or, with ``requires``, from when that table has committed the same run
        too. ``month_metrics`` adds metrics to one month's ledger row."""
        spark = staged.spark
        now = dt.datetime.now(dt.timezone.utc)
        base = {**staged.metrics, **(metrics or {})}
        commits = [Commit(m, staged.run_id, now, staged.counts.get(m, 0), staged.attempt) for m in staged.months]
        own = {} if staged.attempt is None else {"attempt": staged.attempt}
        rows = [(c.snapshot_month, c.run_id, c.committed_at, c.row_count, staged.schema_json,
                 {**base, **(month_metrics or {}).get(c.snapshot_month, {}), **own,
                  "checksum": staged.checksums.get(c.snapshot_month, 0)},
                 requires.ledger_path if requires else None) for c in commits]
        if rows:
            (literal_rows(spark, rows, LEDGER_SCHEMA)
             .write.mode("append").format("parquet").save(self.ledger_path))
        return commits

    def read_run(self, spark: SparkSession, staged: "StagedRun") -> DataFrame:
        """Rows of one (staged or committed) run with ``snapshot_month``."""
        runs = [Run(m, staged.run_id, staged.attempt, None, staged.counts.get(m, 0), staged.schema_json, {})
                for m in staged.months]
        return self._load(spark, runs, _merged_schema([staged.schema_json])).drop("run_id")

    def _load(self, spark, runs, schema: StructType) -> DataFrame:
        """Rows of the files of ``runs`` with ``snapshot_month`` and, of a
        versioned table, ``run_id``."""
        month, run_id = StructField("snapshot_month", StringType(), True), StructField("run_id", StringType(), True)
        full = StructType([*schema.fields, month, *([run_id] if self.versioned else [])])
        found = [r for r in runs if r.row_count > 0]
        # Runs written before attempts had numbers lie one folder higher.
        numbered = [r for r in found if r.attempt is not None]
        plain = [r for r in found if r.attempt is None]
        if not found:
            return spark.createDataFrame([], full)
        out = None
        for part, extra in ((numbered, [StructField("attempt", LongType(), True)]), (plain, [])):
            if part:
                df = (spark.read.format(self.fmt).schema(StructType([*full.fields, *extra]))
                      .option("basePath", self.data_path).load([self._run_path(r) for r in part]))
                df = df.drop("attempt") if extra else df
                out = df if out is None else out.unionByName(df)
        return out

    def _written(self, spark, run_id, attempt, schema_json, digest) -> tuple[dict, dict]:
        """Rows and checksum per month of one versioned run, read back from its
        committed files only (a glob on this attempt, not a listing of the
        whole table)."""
        pattern = f"{self.data_path}/snapshot_month=*/run_id={run_id}/attempt={attempt}"
        if path_matches(spark, pattern) is False:  # the run wrote no rows
            return {}, {}
        schema = StructType([*_merged_schema([schema_json]).fields, StructField("snapshot_month", StringType(), True),
                             StructField("run_id", StringType(), True), StructField("attempt", LongType(), True)])
        try:
            df = spark.read.format(self.fmt).schema(schema).option("basePath", self.data_path).load(pattern)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # the run wrote no rows
                return {}, {}
            raise
        rows = df.groupBy("snapshot_month").agg(F.count(F.lit(1)), digest).collect()
        return {r[0]: int(r[1]) for r in rows}, {r[0]: int(r[2]) for r in rows}

    def verify(self, spark: SparkSession, months=None, **as_of) -> DataFrame:
        """Runs whose files are not what the ledger says was written:
        ``snapshot_month, run_id, row_count, found_rows, same_rows``. One
        aggregate over the files of the current runs; runs without a checksum
        (written before they had one) are compared by rows only."""
        runs = [r for r in self.current_runs(spark, **as_of) if months is None or r.snapshot_month in set(months)]
        schema = "snapshot_month string, run_id string, row_count long, checksum long"
        want = literal_rows(spark, [(r.snapshot_month, r.run_id, r.row_count, r.metrics.get("checksum")) for r in runs],
                            StructType.fromDDL(schema))
        got = None
        for text in sorted({r.schema_json for r in runs}):
            there = [r for r in runs if r.schema_json == text and (
                r.row_count == 0 or path_matches(spark, self._run_path(r)) is not False)]
            own = _merged_schema([text])
            part = self._load(spark, there, own).groupBy("snapshot_month").agg(
                F.count(F.lit(1)).alias("found_rows"), F.bit_xor(row_hash(own)).alias("found"))
            got = part if got is None else got.unionByName(part)
        if got is None:
            return want.select("snapshot_month", "run_id", "row_count", F.lit(0).cast("long").alias("found_rows"),
                               F.lit(False).alias("same_rows")).where("false")
        both = want.join(got, "snapshot_month", "left")
        n = F.coalesce("found_rows", F.lit(0)).cast("long")
        same = F.col("checksum").isNull() | (F.col("checksum") == F.coalesce("found", F.lit(0)))
        return (both.select("snapshot_month", "run_id", "row_count", n.alias("found_rows"),
                            ((n == F.col("row_count")) & same).alias("same_rows")).where("NOT same_rows"))

    # ------------------------------------------------------------- read

    def ledger(self, spark: SparkSession) -> DataFrame:
        return _read_ledger(spark, self.ledger_path)

    def _entries(self, spark: SparkSession) -> list[Run]:
        """Ledger rows whose commit is complete: a row that requires another
        table's commit counts only if that ledger has the same attempt of its
        run. Each ledger is read once."""
        rows = self.ledger(spark).collect()
        done = {(path, r["snapshot_month"], r["run_id"], _attempt(r))
                for path in {r["requires"] for r in rows if r["requires"] is not None}
                for r in _read_ledger(spark, path).select("snapshot_month", "run_id", "metrics").collect()}
        return [Run(r["snapshot_month"], r["run_id"], _attempt(r), r["committed_at"].astimezone(dt.timezone.utc),
                    r["row_count"], r["schema_json"], dict(r["metrics"] or {})) for r in rows
                if r["requires"] is None or (r["requires"], r["snapshot_month"], r["run_id"], _attempt(r)) in done]

    def runs(self, spark: SparkSession, month: str | None = None) -> DataFrame:
        """Version history: every committed run (of ``month``), newest first."""
        kept = [r for r in self._entries(spark) if month is None or r.snapshot_month == validate_month(month)]
        rows = [(r.snapshot_month, r.run_id, r.committed_at, r.row_count, r.schema_json, r.metrics, None) for r in kept]
        return (literal_rows(spark, rows, LEDGER_SCHEMA)
                .select("snapshot_month", "run_id", "committed_at", "row_count", "metrics")
                .orderBy(F.col("committed_at").desc(), F.col("run_id").desc()))

    def current_runs(self, spark: SparkSession, *, as_of: dt.datetime | None = None,
                     as_of_run: str | None = None) -> list[Run]:
        """Latest committed run per month (optionally as of a time, or as of
        a run's commit; a run that was never committed is an error)."""
        return _latest(self._entries(spark), as_of, as_of_run)

    def read(self, spark: SparkSession, months=None, *, as_of: dt.datetime | None = None,
             as_of_run: str | None = None, with_run_id: bool = False) -> DataFrame:
        """Current content of ``months`` (default all) as one DataFrame."""
        if not self.versioned and (as_of is not None or as_of_run is not None):
            raise ValueError("as-of reads need a versioned table")
        entries = self._entries(spark)
        runs = _latest(entries, as_of, as_of_run)
        if months is not None:
            wanted = {validate_month(m) for m in months}
            runs = [r for r in runs if r.snapshot_month in wanted]
        schema = _merged_schema([r.schema_json for r in runs] or
                                [r.schema_json for r in _latest(entries)])
        df = self._load(spark, runs, schema)
        return df.drop("run_id") if self.versioned and not with_run_id else df

    def read_month(self, spark: SparkSession, month: str, **kw) -> DataFrame:
        return self.read(spark, [month], **kw)

    def changes(self, spark: SparkSession, since: dict, until: dict | None = None,
                keys=("snapshot_month", "BIN")) -> DataFrame:
        """What changed between two versions of the table, as the feed of
        ``operators.row_changes``. A version is ``{"as_of": time}`` or
        ``{"as_of_run": id}``; ``until`` defaults to now. Months that both
        versions take from the same attempt are not read."""
        entries = self._entries(spark)
        old, new = ({r.snapshot_month: r for r in _latest(entries, **v)} for v in (since, until or {}))
        moved = [m for m in sorted({*old, *new}) if old.get(m) != new.get(m)]
        schema = _merged_schema([r.schema_json for v in (old, new) for r in v.values()])
        before, after = (self._load(spark, [v[m] for m in moved if m in v], schema).drop("run_id") for v in (old, new))
        return row_changes(before, after, keys)

    def _run_path(self, r) -> str:
        p = f"{self.data_path}/snapshot_month={r.snapshot_month}"
        if not self.versioned:
            return p
        p = f"{p}/run_id={r.run_id}"
        return f"{p}/part-*" if r.attempt is None else f"{p}/attempt={r.attempt}"


def _attempt(ledger_row) -> int | None:
    return (ledger_row["metrics"] or {}).get("attempt")


def _read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if path_matches(spark, path) is False:  # no run committed yet
        return spark.createDataFrame([], LEDGER_SCHEMA)
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def _latest(entries: list[Run], as_of: dt.datetime | None = None, as_of_run: str | None = None) -> list[Run]:
    """Each month's latest run among the ledger rows of a time or a run."""
    if as_of is not None:
        entries = [r for r in entries if r.committed_at <= as_of.astimezone(dt.timezone.utc)]
    if as_of_run is not None:
        at = max((r.committed_at for r in entries if r.run_id == as_of_run), default=None)
        if at is None:
            raise ValueError(f"no committed run {as_of_run!r}")
        entries = [r for r in entries if r.committed_at <= at]
    latest: dict[str, Run] = {}
    for r in sorted(entries, key=lambda r: r.order):
        latest[r.snapshot_month] = r
    return [latest[m] for m in sorted(latest)]


def literal_rows(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A few driver-side rows as one JVM-side literal relation: one task, no
    Python worker (``createDataFrame`` of a list plans a Python RDD scan).
    The rows travel as ONE JSON string literal parsed by ``from_json``, so
    building the plan costs a handful of gateway calls however many rows
    there are (a backfill commits one ledger row per month). Map cells are
    Python dicts; naive datetimes are local time, as in ``createDataFrame``."""
    if not rows:
        return spark.createDataFrame([], schema)

    def cell(v):
        if isinstance(v, dt.datetime):
            return v.astimezone().isoformat(timespec="microseconds")
        return v.isoformat() if isinstance(v, dt.date) else v

    text = json.dumps([{f.name: cell(v) for v, f in zip(r, schema.fields)} for r in rows])
    parsed = F.from_json(F.lit(text), ArrayType(schema),
                         {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


# Changes of a stored type that Parquet readers widen safely.
_WIDER = {("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"), ("short", "long"),
          ("integer", "long"), ("float", "double")}


def _merged_schema(schema_jsons) -> StructType:
    """Union of run schemas by column name; a column's widest type wins, and
    types that do not widen into each other are an error."""
    fields: dict[str, StructField] = {}
    for s in schema_jsons:
        for f in StructType.fromJson(json.loads(s)).fields:
            old = fields.get(f.name)
            if old is None or (old.dataType.typeName(), f.dataType.typeName()) in _WIDER:
                fields[f.name] = StructField(f.name, f.dataType, True)
            elif old.dataType != f.dataType and (f.dataType.typeName(), old.dataType.typeName()) not in _WIDER:
                raise ValueError(f"column {f.name!r} changes type from {old.dataType.simpleString()} "
                                 f"to {f.dataType.simpleString()}")
    return StructType(list(fields.values()))

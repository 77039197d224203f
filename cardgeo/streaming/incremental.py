"""Incremental per-month country counts from a landing folder of
transaction files (Structured Streaming).

Each micro-batch writes the partial counts of its new rows,
``(snapshot_month, reason, BIN, country) -> n`` with ``reason`` the load
filter's verdict (``kept`` or why the row is dropped), partitioned by month
and batch id, through ``foreachBatch`` -- the same layout publication
stages from a raw scan, so ``publish_months_from_counts`` publishes straight
from this table. A retried batch overwrites
exactly its own partitions (dynamic partition overwrite keyed by the batch
id), so together with the stream checkpoint the partial table is
exactly-once; no state store is kept, so late files simply add to their
month. A month's counts are the sum of its partials -- the same numbers as
``country_counts`` over the same rows -- and feed the coverage, support and
vendor steps unchanged.

Run it on a schedule with ``available_now=True`` (process what has landed,
then stop) or continuously.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import counts_from_partials as _sum_partials
from ..operators import reason_counts
from ..params import validate_month
from ..schemas import TXN_SCHEMA


def start_count_stream(
    spark: SparkSession,
    source_path: str,
    partials_path: str,
    checkpoint_path: str,
    *,
    fmt: str = "parquet",
    schema=TXN_SCHEMA,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    available_now: bool = True,
    strict: bool = False,
    codes: DataFrame | None = None,
    lg_k: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Fold the files of ``source_path`` into partial counts. A batch takes
    what has landed, or at most so many files or bytes. ``transform`` turns a
    batch's rows into transactions (e.g. joins with static tables); ``strict``,
    ``codes`` and ``lg_k`` as in ``reason_counts``: with the last, partial counts
    carry sketches of distinct transaction ids, so that support on distinct ids
    needs no second look at the raw rows."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    rows = reader.load(source_path)

    def write_partials(batch: DataFrame, batch_id: int) -> None:
        tx = transform(batch) if transform else batch
        (reason_counts(tx, by=("snapshot_month",), strict=strict, codes=codes, lg_k=lg_k)
         .withColumn("batch_id", F.lit(int(batch_id)))
         .hint("rebalance", "snapshot_month")  # about one file per month and batch
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("snapshot_month", "batch_id").parquet(partials_path))

    writer = (rows.writeStream.foreachBatch(write_partials)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def compact_partials(spark: SparkSession, partials_path: str, compacted_path: str) -> None:
    """Add the partial counts up into a new table: one row per key and about
    one file per month, under batch id -1, which no batch has. The caller
    points readers at it, and starts a new partial table, between two runs of
    the stream (whose checkpoint goes on); both are then read together."""
    keys = ["snapshot_month", "reason", "BIN", "country"]
    partials = read_partials(spark, partials_path)
    # A union of no sketches is an empty sketch; rejected rows keep none.
    ids = ([F.when(F.count("ids") > 0, F.hll_union_agg("ids")).alias("ids")] if "ids" in partials.columns else [])
    (partials.groupBy(*keys).agg(F.sum("n").alias("n"), *ids)
     .withColumn("batch_id", F.lit(-1)).hint("rebalance", "snapshot_month")
     .write.mode("overwrite").partitionBy("snapshot_month", "batch_id").parquet(compacted_path))


def read_partials(spark: SparkSession, *partials_paths: str) -> DataFrame:
    """The partial-count table(s) ``(snapshot_month, reason, BIN, country, n,
    batch_id)``, with ``ids`` if they were sketched; filters on ``snapshot_month`` prune partitions."""
    read = lambda p: spark.read.parquet(p).withColumn(
        "snapshot_month", F.col("snapshot_month").cast("string"))
    first, *more = map(read, partials_paths)
    for df in more:
        first = first.unionByName(df)
    return first


def counts_from_partials(spark: SparkSession, partials_path: str, month: str | None = None) -> DataFrame:
    """``(BIN, country, txn_count, bin_total)`` of ``month`` from the partial
    counts (partition-pruned to that month, kept rows only); of every month,
    with ``snapshot_month``, if none is named."""
    partials = read_partials(spark, partials_path).where(F.col("reason") == "kept")
    if month is None:
        return _sum_partials(partials, by=("snapshot_month",))
    return _sum_partials(partials.where(F.col("snapshot_month") == validate_month(month)))

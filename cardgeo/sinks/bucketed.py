"""Snapshots laid out for joins on the BIN.

A catalog table partitioned by month and, within a month, bucketed and sorted
by BIN. Every month has the same buckets, so a comparison of two months, or of
a month with a vendor table of the same layout, is a merge of matching bucket
files: no exchange of the stored rows, however large. The versioned
``SnapshotTable`` stays the table of record; this is a copy for readers that
join, replaced month by month.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import validate_month
from ..schemas import require_columns


@dataclass(frozen=True)
class BucketedTable:
    """``name`` in the session's catalog, its files under ``path`` (shared).
    ``buckets``: about a month's bytes / 128 MB; two tables join without an
    exchange only if they have the same number."""

    name: str
    path: str
    buckets: int = 64
    key: str = "BIN"
    by_month: bool = True

    def write(self, df: DataFrame, month: str | None = None) -> None:
        """Replace a month (or, of a table without months, everything)."""
        require_columns(df.columns, {self.key}, "bucketed table")
        spark = df.sparkSession
        if self.by_month:
            validate_month(month)
        rows = df.drop("snapshot_month") if self.by_month else df
        # The same hash deals rows to tasks and to buckets: one file a bucket.
        rows = rows.repartition(self.buckets, self.key)
        if not spark.catalog.tableExists(self.name) or not self.by_month:
            out = rows.withColumn("snapshot_month", F.lit(month)) if self.by_month else rows
            w = out.write.format("parquet").mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key)
            w = w.partitionBy("snapshot_month") if self.by_month else w
            w.option("path", self.path).saveAsTable(self.name)
            return
        stored = [c for c in spark.table(self.name).columns if c != "snapshot_month"]
        require_columns(rows.columns, set(stored), "bucketed table")
        view = f"bucketed_{uuid.uuid4().hex}"
        rows.select(*stored).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (snapshot_month = '{month}') "
                      f"SELECT {', '.join(f'`{c}`' for c in stored)} FROM {view}")
        finally:
            spark.catalog.dropTempView(view)

    def read(self, spark: SparkSession, month: str | None = None) -> DataFrame:
        df = spark.table(self.name)
        if month is not None:
            df = df.where(F.col("snapshot_month") == validate_month(month))
        return df

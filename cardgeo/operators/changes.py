"""Change feed between two versions of a table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import row_hash
from ..schemas import require_columns


def _on(a: DataFrame, b: DataFrame, left, right) -> Column:
    """Null-safe equality of key columns (planned as an equi-join)."""
    return reduce(and_, (a[x].eqNullSafe(b[y]) for x, y in zip(left, right)))


def row_changes(prev: DataFrame, curr: DataFrame, keys, change: str = "change") -> DataFrame:
    """Rows that turn ``prev`` into ``curr``: the ``keys``, ``change``
    (``insert``, ``update``, ``delete``) and ``curr``'s other columns (null for
    a delete). Rows that are the same have none.

    One full outer join on the keys, null-safe, each side one row per key (the
    publication gate's rule). Of ``prev`` only the keys and two 64-bit hashes of
    each row are shuffled. Columns that only ``prev`` has are dropped from the
    comparison; those that only ``curr`` has count as null in ``prev``.
    """
    require_columns(prev.columns, keys, "previous version")
    require_columns(curr.columns, keys, "current version")
    values = [c for c in curr.columns if c not in keys]
    if change in curr.columns:
        raise ValueError(f"the frame has a column {change!r}")
    missing = [f for f in curr.schema.fields if f.name not in prev.columns]
    prev = prev.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else prev
    types = StructType([f for f in curr.schema.fields if f.name in values])
    digest = F.struct(row_hash(types, 1), row_hash(types, 2))  # of both versions' values as the current types
    old = prev.select(*(F.col(k).alias(f"_p_{k}") for k in keys),
                      *(F.col(f.name).cast(f.dataType) for f in types.fields))
    old = old.select(*(f"_p_{k}" for k in keys), digest.alias("_p"), F.lit(True).alias("_in_prev"))
    new = curr.select(*curr.columns, digest.alias("_c"), F.lit(True).alias("_in_curr"))
    j = old.join(new, _on(old, new, [f"_p_{k}" for k in keys], keys), "full_outer")
    kind = (F.when(F.col("_in_prev").isNull(), "insert").when(F.col("_in_curr").isNull(), "delete")
            .when(F.col("_p") != F.col("_c"), "update"))
    return (j.withColumn(change, kind).where(F.col(change).isNotNull())
            .select(*(F.when(F.col("_in_curr").isNull(), F.col(f"_p_{k}")).otherwise(F.col(k)).alias(k) for k in keys),
                    change, *values))


def apply_changes(prev: DataFrame, feed: DataFrame, keys, change: str = "change") -> DataFrame:
    """``prev`` with a feed of :func:`row_changes` applied."""
    require_columns(feed.columns, {*keys, change}, "change feed")
    hit = feed.select(*(F.col(k).alias(f"_f_{k}") for k in keys))
    kept = prev.join(hit, _on(prev, hit, keys, [f"_f_{k}" for k in keys]), "left_anti")
    new = feed.where(F.col(change) != "delete").drop(change)
    return new.unionByName(kept, allowMissingColumns=True)

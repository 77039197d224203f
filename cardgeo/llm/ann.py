"""Nearest neighbours by shifted space-filling curves.

1. Equal vectors collapse into one class that keeps its ``k + 1`` smallest ids
   (no query needs more of them), so one very common vector costs one class.
2. A projection is fitted on a bounded sample (``SAMPLE`` vectors): principal
   axes, then one random rotation and shift per curve. Every class gets one
   Hilbert key per curve.
3. Each curve's order is range-partitioned by Spark and written with running
   positions; the partitions' counts give global positions (as in packing).
4. A query looks at the neighbouring key window of every curve: the order is
   cut into blocks of ``BLOCK`` rows, and a query visits the blocks that its
   window of ``share`` of the rows on each side touches. Blocks are bounded;
   many queries on one block are split over salted copies of it.
5. The windows' candidates merge, and distances on the original vectors in
   double precision rank them.

The window is a share of the rows because the vectors may have no structure
that a curve could follow: for nearly isotropic vectors, recall depends on the
share looked at (measured: 20 curves of 5 percent on each side give 0.97).

Vectors that are null, zero, of another length than most, or with null or
non-finite components take no part, nor do rows with a null id. Ties go to the
smaller id. Repeated rows count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

CURVES, AXES, DIMS, BITS = 20, 16, 8, 7
SAMPLE = 4096
BLOCK = 1024
SHARE, LEAST_WINDOW = 0.05, 512
#: Queries of one block and salt.
QUERIES_PER_BLOCK = 2048
_EMPTY = ["qcid", "cid", "first_id", "score"]


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of integer cells (rows x dims), by
    Skilling's transposed form: undo the excess work of each bit plane, Gray
    encode, then interleave the bits."""
    x = [c.astype(np.int64) for c in cells.T]
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(dims):
            on = (x[i] >> level) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap) if i else np.where(on, x[0] ^ low, x[0])
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | (((x[i] ^ flip) >> level) & 1)
    return key


class CurveFamily:
    """Projections of ``CURVES`` curves, fitted on a sample."""

    def __init__(self, sample: np.ndarray, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0)
        axes = np.linalg.svd(sample - self.mean, full_matrices=False)[2][:AXES].T
        dims = min(DIMS, axes.shape[1])
        self.maps, self.low, self.width = [], [], []
        for _ in range(CURVES):
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0][:, :dims]
            flat = (sample - self.mean) @ axes @ turn
            low, high = flat.min(axis=0), flat.max(axis=0)
            width = np.maximum(high - low, 1e-9)
            self.maps.append(axes @ turn)
            self.low.append(low - rng.random(dims) * width)
            self.width.append(2 * width)

    def keys(self, vectors: np.ndarray) -> Iterator[np.ndarray]:
        most = (1 << BITS) - 1
        for m, low, width in zip(self.maps, self.low, self.width):
            cells = ((vectors - self.mean) @ m - low) / width * (most + 1)
            yield hilbert_keys(np.clip(cells, 0, most).astype(np.int64), BITS)


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    size = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.where(F.size("v") == (size["d"] if size else 0))


def _as_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _pack_vectors(batches):
    for pdf in batches:
        yield pd.DataFrame({"cid": pdf["cid"], "first_id": pdf["first_id"],
                            "vec": [np.asarray(x, np.float64).tobytes() for x in pdf["v"]]})


def _nearest(k: int):
    def run(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """Of one block: each query's ``k`` nearest classes in its window."""
        if not len(rows) or not len(queries):
            return pd.DataFrame(columns=_EMPTY)
        rows = rows.sort_values("pos")
        matrix, pos = _as_matrix(rows["vec"]), rows["pos"].to_numpy()
        cid, first = rows["cid"].to_numpy(), rows["first_id"].to_numpy()
        out = []
        for qcid, vec, at, window in zip(queries["qcid"], queries["qvec"], queries["qpos"], queries["window"]):
            a, b = np.searchsorted(pos, (at - window, at + window + 1))
            if a < b:
                d = matrix[a:b] - np.frombuffer(vec, np.float64)
                score = np.sqrt((d * d).sum(axis=1))
                best = np.lexsort((first[a:b], score))[:k] + a
                out.append(pd.DataFrame({"qcid": qcid, "cid": cid[best], "first_id": first[best],
                                         "score": score[best - a]}))
        return pd.concat(out) if out else pd.DataFrame(columns=_EMPTY)
    return run


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` nearest other rows of
    every row for which the column expression ``is_query`` of ``vec_id`` holds."""
    spark = vectors.sparkSession
    usable = _usable(vectors, id_col, vec_col)
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    classes = (usable.withColumn("r", F.dense_rank().over(by_vector)).where(F.col("r") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), "v", "ids",
                                         F.col("ids")[0].alias("first_id")), "op4-classes")
    queries = materialize(usable.where(is_query(F.col("vec_id"))).distinct()
                          .join(classes.select("v", "cid"), "v").select(F.col("vec_id").alias("query_id"), "cid"),
                          "op4-queries")
    total = classes.count()
    sample = classes.select("v").orderBy(F.xxhash64("cid")).limit(SAMPLE).toPandas()["v"]
    if total < 2:  # nothing to be near to but copies: they are in the class
        order = None
    else:
        order = spark.sparkContext.broadcast(CurveFamily(np.array([np.asarray(x, float) for x in sample])))
    window = max(LEAST_WINDOW, math.ceil(share * total))

    packed = classes.select("cid", "first_id", "v").mapInPandas(_pack_vectors, "cid long, first_id long, vec binary")
    if order is None:
        near = (queries.select(F.col("cid").alias("qcid"), "cid").distinct()
                .join(classes.select("cid", "first_id"), "cid")
                .select("qcid", "cid", "first_id", F.lit(0.0).alias("score")))
    else:
        def keyed(batches):
            for pdf in batches:
                if len(pdf):
                    for curve, key in enumerate(order.value.keys(_as_matrix(pdf["vec"]))):
                        yield pdf.assign(curve=curve, key=key)[["curve", "key", "cid", "first_id", "vec"]]

        def numbered(batches):
            part, seen = TaskContext.get().partitionId(), {}
            for pdf in batches:
                curve = pdf["curve"].to_numpy()
                place = np.empty(len(pdf), np.int64)
                for c in np.unique(curve).tolist():
                    on = curve == c
                    n = int(on.sum())
                    place[on] = seen.get(c, 0) + np.arange(n)
                    seen[c] = seen.get(c, 0) + n
                yield pdf.assign(part=part, place=place)[["part", "place", "curve", "cid", "first_id", "vec"]]

        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total * CURVES // 50_000 + 1)
        placed = materialize(
            packed.mapInPandas(keyed, "curve int, key long, cid long, first_id long, vec binary")
            .repartitionByRange(parts, "curve", "key", "cid").sortWithinPartitions("curve", "key", "cid")
            .mapInPandas(numbered, "part int, place long, curve int, cid long, first_id long, vec binary"),
            "op4-curves")
        sizes = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
        base = sizes.select("curve", "part", (F.sum("n").over(Window.partitionBy("curve").orderBy("part"))
                                              - F.col("n")).alias("base"))
        placed = placed.join(base, ["curve", "part"]).withColumn("pos", F.col("base") + F.col("place"))
        # Expected queries on a block, split over salted copies of the block.
        busy = queries.select("cid").distinct().count() / total * (2 * window + BLOCK)
        salts = max(1, math.ceil(busy / QUERIES_PER_BLOCK))
        salt = F.sequence(F.lit(0), F.lit(salts - 1))
        rows = placed.select("curve", F.floor(F.col("pos") / BLOCK).alias("block"), F.explode(salt).alias("salt"),
                             "pos", "cid", "first_id", "vec")
        asked = (placed.join(queries.select("cid").distinct(), "cid", "left_semi")
                 .select("curve", F.explode(F.sequence(F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / BLOCK),
                                                       F.floor((F.col("pos") + window) / BLOCK))).alias("block"),
                         F.pmod(F.xxhash64("cid"), F.lit(salts)).cast("int").alias("salt"),
                         F.col("cid").alias("qcid"), F.col("vec").alias("qvec"), F.col("pos").alias("qpos"),
                         F.lit(window).alias("window")))
        key = ["curve", "block", "salt"]
        asked = asked.toDF("of_curve", "of_block", "of_salt", *asked.columns[3:])
        near = (rows.groupBy(*key).cogroup(asked.groupBy("of_curve", "of_block", "of_salt"))
                .applyInPandas(_nearest(k + 1), "qcid long, cid long, first_id long, score double").distinct())

    best = Window.partitionBy("qcid").orderBy("score", "first_id")
    near = near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    rows = (near.join(classes.select("cid", "ids"), "cid")
            .select("qcid", "score", F.explode("ids").alias("vec_id")))
    ranked = Window.partitionBy("qcid").orderBy("score", "vec_id")
    rows = rows.withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1)
    lists = rows.groupBy("qcid").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (queries.join(lists, queries["cid"] == lists["qcid"])
            .select("query_id", F.posexplode(own).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))

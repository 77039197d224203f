"""Helpers shared by the operators: words, hashes, bounded caches, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..sinks import shared_dir

#: A-Z to a-z, byte by byte.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a test-data folder, by a path that only Spark opens."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    lineage (a lost executor recomputes from committed files) and keeps an
    expensive pass from running twice."""
    spark = df.sparkSession
    path = shared_dir(spark, "cardgeo-llm", label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """``df``, its session set to hand at most ``rows`` texts at a time to
    Python: batches of long documents stay within a task's memory."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > rows:
        conf.set(key, rows)
    return df


class BoundedCache(dict):
    """``key -> make(key)`` with two generations of at most ``limit`` keys
    each: a full young generation becomes the old one, and keys used again
    move back. Frequent keys stay; memory is bounded for any vocabulary."""

    def __init__(self, make: Callable, limit: int = 1 << 17):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer, so that linear combinations look random."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


#: White space of the word rule, as a table over bytes, and the bytes lower-cased.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER_BYTES = np.frombuffer(LOWER, np.uint8)
#: An odd base for polynomials over bytes and its inverse, modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text hashed at a time (a longer document goes alone).
CHUNK_BYTES = 1 << 22


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, U64)
    p[0] = 1
    return np.multiply.accumulate(p)


def text_chunks(texts: Iterable[bytes | None], most: int = CHUNK_BYTES):
    """Runs of texts of about ``most`` bytes: ``(first index, [bytes])``."""
    first, run, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or b""
        if run and size + len(t) > most:
            yield first, run
            first, run, size = i, [], 0
        run.append(t)
        size += len(t)
    if run:
        yield first, run


class HashedWords:
    """The words of a run of texts as 64-bit hashes, all at once in numpy.

    ``hash``: one per word, in order; ``doc``: the index of its text;
    ``start``/``end``: byte positions in ``data`` (texts joined by a space);
    ``bounds``: words of text i are ``bounds[i]:bounds[i + 1]``.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        self.data = b" ".join(texts) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        space = _IS_SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(raw) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        value = (_LOWER_BYTES[raw] if lower else raw).astype(U64) + U64(1)
        power = _powers(_BASE, len(raw))
        total = np.empty(len(raw) + 1, U64)
        total[0] = 0
        np.cumsum(value * power, out=total[1:])
        h = (total[self.end] - total[self.start]) * _powers(_INVERSE, len(raw))[self.start]
        self.hash = mix64(h + (self.end - self.start).astype(U64))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        first = np.concatenate(([0], np.cumsum(sizes)))
        self.bounds = np.searchsorted(self.start, first)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]]


#: An odd multiplier for windows of word hashes.
WINDOW_BASE = U64(0x9E3779B97F4A7C15)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, in order."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    out = np.zeros(n, U64)
    for j in range(width):
        out = out * WINDOW_BASE + h[j:j + n]
    return mix64(out + U64(width))

"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a whole pre-token that is in the vocabulary is one id, found through a
minimal perfect hash (one slot per vocabulary entry, one comparison).
Tier 2: any other pre-token starts as linked bytes; a heap of adjacent pairs
gives the lowest-ranked merge, leftmost first, until no pair has a rank.

The vocabulary file is read on the driver and broadcast (its size is fixed by
the vocabulary, not by the data). Texts are processed whole, batch by batch;
results of pre-tokens are kept in a cache of bounded size.

Ids travel as one binary per row: little-endian unsigned 32-bit integers
(``unpack_ids`` gives an array column).

Defined results: null text encodes like the empty text: no ids; null ids decode
to no bytes; texts of any length are encoded whole; null document ids and
repeated rows are encoded like any other, each for itself; columns of the same
names as the results' are replaced, others are kept.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, BoundedCache, text_batches

#: Displacements a bucket may try before the next seed, and at a time.
_TRIES, _AT_ONCE = 1 << 16, 64


def read_text(path: str) -> str:
    """A vocabulary file that is installed where the driver runs; its content
    reaches the tasks by broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def parse_ranks(text: str) -> dict[bytes, int]:
    """Rank file: a line has the token in base 64 and its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line.strip())}


class MinimalPerfectHash:
    """Hash and displace: keys fall into small buckets; each bucket, largest
    first, takes the first displacement that puts its keys on free slots; a
    bucket of one key names its slot outright. ``len(keys)`` slots in all."""

    def __init__(self, keys: list[bytes], values: list[int], per_bucket: int = 4):
        self.n = len(keys)
        self.buckets = max(1, self.n // per_bucket)
        for self.seed in range(100):
            if self._place(keys, values):
                return
        raise ValueError("no placement found; are keys repeated?")

    def _slot(self, h, shift):
        """The slot of a hash (an int, or arrays of uint64) displaced."""
        if isinstance(h, int):
            x = ((h ^ shift * 0x9E3779B97F4A7C15) * 0xFF51AFD7ED558CCD) & 0xFFFFFFFFFFFFFFFF
            return (x >> 32) % self.n
        return ((h ^ shift * U64(0x9E3779B97F4A7C15)) * U64(0xFF51AFD7ED558CCD) >> U64(32)) % U64(self.n)

    def _place(self, keys, values) -> bool:
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(k, self.seed) for k in keys), U64, len(keys))
        rows: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate((hashes % U64(self.buckets)).tolist()):
            rows[b].append(i)
        self.shift = [0] * self.buckets
        self.key, self.value = [b""] * self.n, [-1] * self.n
        taken, free = np.zeros(self.n, bool), None
        for b in sorted(range(self.buckets), key=lambda b: -len(rows[b])):
            if not rows[b]:
                break
            if len(rows[b]) == 1:
                if free is None:
                    free = iter(np.flatnonzero(~taken).tolist())
                slots = [next(free)]
                self.shift[b] = -slots[0] - 1
            else:
                for first in range(1, _TRIES, _AT_ONCE):
                    shifts = np.arange(first, first + _AT_ONCE, dtype=U64)
                    tried = np.sort(self._slot(hashes[rows[b]][:, None], shifts[None, :]), axis=0)
                    good = np.flatnonzero(~taken[tried].any(axis=0) & (tried[1:] != tried[:-1]).all(axis=0))
                    if len(good):
                        break
                else:
                    return False
                self.shift[b] = first + int(good[0])
                slots = [self._slot(int(hashes[i]), self.shift[b]) for i in rows[b]]
                taken[slots] = True
            for i, s in zip(rows[b], slots):
                self.key[s], self.value[s] = keys[i], values[i]
        return True

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        shift = self.shift[h % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(h, shift)
        return self.value[slot] if self.key[slot] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: a heap over linked bytes. A part spans
    ``i:after[i]``; heap entries whose part or neighbour has changed since
    are skipped."""
    n = len(piece)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or after[j] != end:
            continue
        alive[j], after[i], before[end] = False, end, i
        if end < n and (r := ranks.get(piece[i:after[end]])) is not None:
            heapq.heappush(heap, (r, i, after[end]))
        if (k := before[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
            heapq.heappush(heap, (r, k, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class BpeModel:
    """Ranks, the split pattern and the perfect hash; broadcast to tasks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.whole = MinimalPerfectHash(list(ranks), list(ranks.values()))
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self._encoder = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}  # each process makes its own

    def encode_piece(self, piece: str) -> bytes:
        raw = piece.encode()
        one = self.whole.get(raw)
        ids = [one] if one >= 0 else merge_bytes(raw, self.ranks)
        return np.array(ids, "<u4").tobytes()

    def encoder(self):
        """text -> packed ids; the cache of pre-tokens lasts as long as the
        worker process keeps the model."""
        if self._encoder is None:
            split, cache = regex.compile(self.pattern).findall, BoundedCache(self.encode_piece)
            self._encoder = lambda text: b"".join(map(cache.__getitem__, split(text))) if text else b""
        return self._encoder

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def load_model(path: str, pattern: str) -> BpeModel:
    return BpeModel(parse_ranks(read_text(path)), pattern)


def encode(df: DataFrame, model: BpeModel, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the packed ids of a text column."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = shared.value.encoder()
        for texts in batches:
            yield pd.Series([run(t) for t in texts], dtype=object)

    return text_batches(df).withColumn(ids_col, ids(F.col(text_col)))


def decode(df: DataFrame, model: BpeModel, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that packed ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for ids in batches:
            yield pd.Series([model.decode(x) for x in ids], dtype=object)

    return text_batches(df).withColumn(bytes_col, back(F.col(ids_col)))


def unpack_ids(ids: str | Column) -> Column:
    """Packed ids as an array of int."""
    c = F.col(ids) if isinstance(ids, str) else ids
    byte = lambda k, j: F.conv(F.hex(c.substr(4 * k + 1 + j, F.lit(1))), 16, 10).cast("int")
    one = lambda k: byte(k, 0) + byte(k, 1) * 256 + byte(k, 2) * 65536 + byte(k, 3) * 16777216
    n = F.octet_length(c) / 4
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n.cast("int") - 1), one)).otherwise(F.array().cast("array<int>"))

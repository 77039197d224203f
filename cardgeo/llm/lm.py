"""Language-model scoring with an Elias-Fano n-gram trie.

Words are lower-cased; a text ends with one end token. Probabilities are
interpolated absolute discounting: trigram over bigram over add-0.1 unigrams.

1. Unigram counts of all training texts (partial counts in the tasks, added by
   Spark). The commonest words seen at least ``LEAST`` times, at most ``HEAD``,
   get a rank and are broadcast with their counts; the others stay in a table
   and meet the texts in a join, where no word can be common.
2. The texts are written once as ranks. Each token goes, with the two before it,
   to the bucket of the word before it (``v`` of ``u v w``), in packed columns.
   There all of the word's bigrams, and the trigrams around it, are together:
   those seen at least ``LEAST`` times are kept, at any size of the input. The
   rest is in the back-off weights, and a context's probabilities still sum to
   one. The score is a sum over a text's n-grams: a kept one adds its *gain*, its
   log probability less what backing off from it would have given, and its own
   back-off weight as a context. A bucket gives each text its sum back.
3. A word before ``HOT`` tokens or more has no single bucket: its tokens are
   first dealt by ``v w``, which counts the bigrams and the word's kept mass, and
   then, with their bigram's count, by ``u v``; of a pair that is so common
   itself, by ``u v w``, its kept mass known from the first deal.
4. Kept n-grams of at least a ``1 / GRAMS`` share of the tokens (at most
   ``GRAMS`` an order) are looked up in a trie in the tasks instead: per level, monotone pointers and successors
   in Elias-Fano code and probabilities quantised to 256 levels. A trigram's
   last word is stored relative to its context: as its position among the
   successors of the middle word. A level is a flat buffer, read in place
   from a broadcast or a memory-mapped file.

Defined results: null text is empty: one token, the end. A row with a null id
belongs to the training part. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import json
import mmap
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HashedWords, U64, WINDOW_BASE, materialize, mix64, text_batches, text_chunks

HEAD, GRAMS = 1 << 21, 1 << 16
#: Kept n-grams occur at least so often, at every size.
LEAST = 2
DISCOUNT = 0.75
#: The end token's and the start's place among the word hashes.
END, START = U64(0xE4D00000000000E4), U64(0x57A2700000000057)
#: Tokens of a bucket, and from how many on a word or a pair is dealt further.
BUCKET, HOT = 1 << 20, 1 << 20
#: Codes of words: ranks, the start, no word, and from RARE on words without a rank.
CODE_START, RARE, NONE = U64(1 << 62), U64(1 << 63), U64((1 << 64) - 1)
#: Rows whose sums go back together: 2 ** _SLOT; binary places of a sum.
_SLOT, _FRACTION = 14, 30
_FLUSH = 1 << 20
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: _NTH[b, r]: the place of the r-th set bit of byte b.
_NTH = np.array([([j for j in range(8) if b >> j & 1] + [8] * 8)[:8] for b in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence: the low bits of each value in a packed
    array, the high bits in unary, with a count of ones before each byte."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.bits = (int(x) for x in arrays["shape"])
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]

    @staticmethod
    def build(values: np.ndarray) -> dict[str, np.ndarray]:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = (((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8)).ravel()
        high = np.zeros(n + (top >> bits) + 1, np.uint8)
        high[(values >> bits) + np.arange(n)] = 1
        high = np.packbits(high, bitorder="little")
        ones = np.concatenate(([0], np.cumsum(_ONES[high]))).astype(np.uint32)
        return {"shape": np.array([n, bits]), "low": np.packbits(low, bitorder="little"), "high": high, "ones": ones}

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        i = np.asarray(i, np.int64)
        byte = np.searchsorted(self.ones, i, side="right") - 1
        bit = _NTH[self.high[byte], i - self.ones[byte]].astype(np.int64)
        value = (byte * 8 + bit - i) << self.bits
        for j in range(self.bits):
            at = i * self.bits + j
            value |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) << j
        return value

    def find(self, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Positions of ``wanted`` within ``lo:hi`` (increasing there), or -1."""
        lo, end = lo.copy(), hi
        hi = hi.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.get(mid) < wanted[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        out = np.full(len(lo), -1)
        ok = np.flatnonzero(lo < end)
        ok = ok[self.get(lo[ok]) == wanted[ok]] if ok.size else ok
        out[ok] = lo[ok]
        return out


def _quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """256 even levels between the extremes, and each value's level."""
    if not len(values):
        return np.zeros(256, np.float32), np.empty(0, np.uint8)
    book = np.linspace(values.min(), values.max(), 256)
    step = max(float(book[1] - book[0]), 1e-12)
    return book.astype(np.float32), np.rint((values - book[0]) / step).astype(np.uint8)


class Trie:
    """Levels of the kept n-grams. Words are ids ``0 .. words - 1``; the start
    of a text is the id ``words``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        sub = lambda name: EliasFano({k.split(".")[1]: v for k, v in arrays.items() if k.startswith(name + ".")})
        self.pointers2, self.words2 = sub("pointers2"), sub("words2")
        self.pointers3, self.words3 = sub("pointers3"), sub("words3")
        self.a = arrays

    @staticmethod
    def build(words: int, bigrams: np.ndarray, p2: np.ndarray, back1: np.ndarray, back2: np.ndarray,
              trigrams: np.ndarray, p3: np.ndarray) -> "Trie":
        """``bigrams``: sorted rows (context, word); ``trigrams``: sorted rows
        (index of the bigram u v, index of the bigram v w); ``back1`` per
        word id and the start, ``back2`` per bigram; probabilities and
        weights as log10."""
        first = np.searchsorted(bigrams[:, 0], np.arange(words + 2))
        deeper = np.searchsorted(trigrams[:, 0], np.arange(len(bigrams) + 1))
        relative = trigrams[:, 1] - first[bigrams[trigrams[:, 0], 1]]
        # Monotone within a level: each context's values start above the last.
        arrays = {f"pointers2.{k}": v for k, v in EliasFano.build(first).items()}
        arrays |= {f"words2.{k}": v for k, v in EliasFano.build(bigrams[:, 0] * words + bigrams[:, 1]).items()}
        arrays |= {f"pointers3.{k}": v for k, v in EliasFano.build(deeper).items()}
        span = int(np.diff(first).max(initial=0)) + 1
        arrays |= {f"words3.{k}": v for k, v in EliasFano.build(trigrams[:, 0] * span + relative).items()}
        arrays["sizes"] = np.array([words, span])
        for name, values in (("p2", p2), ("p3", p3), ("back1", back1), ("back2", back2)):
            arrays[name + "_book"], arrays[name + "_code"] = _quantise(np.asarray(values, float))
        return Trie(arrays)

    def value(self, name: str, i: np.ndarray) -> np.ndarray:
        return self.a[name + "_book"][self.a[name + "_code"][i]]

    def bigram(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Positions of bigrams in their level, -1 where not kept; ids < 0
        are words outside the trie."""
        out = np.full(len(word), -1)
        ok = np.flatnonzero((context >= 0) & (word >= 0))
        if ok.size and self.words2.n:
            size = int(self.a["sizes"][0])
            code, pair = pd.factorize(context[ok] * np.int64(size) + word[ok])
            h = pair // size
            out[ok] = self.words2.find(self.pointers2.get(h), self.pointers2.get(h + 1), pair)[code]
        return out

    def trigram(self, uv: np.ndarray, v: np.ndarray, vw: np.ndarray) -> np.ndarray:
        """Positions of trigrams from those of their bigrams."""
        out = np.full(len(uv), -1)
        ok = np.flatnonzero((uv >= 0) & (vw >= 0))
        if ok.size and self.words3.n:
            relative = vw[ok] - self.pointers2.get(v[ok])
            out[ok] = self.words3.find(self.pointers3.get(uv[ok]), self.pointers3.get(uv[ok] + 1),
                                       uv[ok] * int(self.a["sizes"][1]) + relative)
        return out

    def log10_over_unigram(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, uni: np.ndarray) -> np.ndarray:
        """log10 P(w | u v), given the words' unigram log10 probabilities."""
        vw, uv = self.bigram(v, w), self.bigram(u, v)
        back1 = np.where(v >= 0, self.value("back1", np.maximum(v, 0)), 0.0)
        p = np.where(vw >= 0, self.value("p2", vw), back1 + uni) if self.words2.n else back1 + uni
        if self.words2.n:
            p = p + np.where(uv >= 0, self.value("back2", uv), 0.0)
        if self.words3.n:
            uvw = self.trigram(uv, v, vw)
            p = np.where(uvw >= 0, self.value("p3", uvw), p)
        return p

    def to_bytes(self) -> bytes:
        """A header line (names, types, sizes), then the arrays, 8-aligned."""
        head = [(k, v.dtype.str, len(v)) for k, v in self.a.items()]
        body = b"".join(v.tobytes() + bytes(-v.nbytes % 8) for v in self.a.values())
        line = json.dumps(head).encode()
        return line + b" " * (-(len(line) + 1) % 8) + b"\n" + body

    @staticmethod
    def from_buffer(data) -> "Trie":
        at = data.find(b"\n") + 1
        arrays = {}
        for name, kind, n in json.loads(bytes(data[:at])):
            arrays[name] = np.frombuffer(data, kind, n, at)
            at += arrays[name].nbytes + -arrays[name].nbytes % 8
        return Trie(arrays)

    @staticmethod
    def open(path: str) -> "Trie":
        """Memory-map a file that holds ``to_bytes()``."""
        with open(path, "rb") as f:
            return Trie.from_buffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in a sorted array, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class _Run:
    """Tokens of a run of texts, ends included: ``code`` into ``distinct``
    hashes; text i has the tokens ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: list[bytes]):
        words = HashedWords(texts)
        self.bounds = words.bounds + np.arange(len(words.bounds))
        self.code, self.distinct = pd.factorize(np.insert(words.hash, words.bounds[1:], END))


def _counted(keys_of) -> "callable":
    """A task that adds up the 64-bit keys of its texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.Series] = []

        def total() -> pd.Series:
            return pd.concat(held).groupby(level=0, sort=False).sum()

        def frame(s: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"key": s.index.to_numpy(np.uint64).view(np.int64), "n": s.to_numpy(np.int64)})

        for pdf in batches:
            for _, texts in text_chunks(pdf["text"]):
                held.append(pd.Series(keys_of(texts)).value_counts(sort=False))
                if sum(map(len, held)) > _FLUSH:
                    held = [total()]
                    if len(held[0]) > _FLUSH // 2:
                        yield frame(held.pop())
        if held:
            yield frame(total())
    return run


def _counts(texts: DataFrame, keys_of) -> DataFrame:
    part = texts.mapInPandas(_counted(keys_of), "key long, n long")
    return part.groupBy("key").agg(F.sum("n").alias("n"))


def _log10(x: Column) -> Column:
    return F.log10(F.greatest(x, F.lit(1e-9)))


def _unsigned(values: pd.Series) -> np.ndarray:
    return values.to_numpy(np.int64).view(np.uint64)


def _collected(df: DataFrame) -> pd.DataFrame:
    """Rows of longs and doubles on the driver: the tasks send them as bytes."""
    kinds = {c: np.int64 if kind == "bigint" else np.float64 for c, kind in df.dtypes}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({c: [pdf[c].to_numpy(kind).tobytes()] for c, kind in kinds.items()})

    held = {c: [] for c in kinds}
    for r in df.mapInPandas(run, ", ".join(f"{c} binary" for c in kinds)).toLocalIterator():
        for c in kinds:
            held[c].append(bytes(r[c]))
    return pd.DataFrame({c: np.frombuffer(b"".join(held.pop(c)), kind) for c, kind in kinds.items()})


class Model:
    """What the tasks need: head words with counts, by hash and by rank. Arrays
    by code have two places more than ranks: for the start and for words
    without a rank. ``gram_hash``: the trie's words, ``trie``: its bytes."""

    def __init__(self, head_hash, head_count, tokens: int, distinct: int, texts: int, cut: int, closed: bool):
        self.head_hash, self.tokens, self.distinct = head_hash, tokens, distinct
        self.cut, self.closed = cut, closed  # words with a rank occur at least cut times; closed: the others once at most
        by = np.argsort(-head_count, kind="stable")
        self.rank = np.empty(len(by), np.int32)
        self.rank[by] = np.arange(len(by), dtype=np.int32)
        self.count = np.concatenate((head_count[by], [texts, 0])).astype(np.int64)
        self.least, self.hot_least = max(LEAST, -(-tokens // GRAMS)), HOT
        self.buckets = max(1, -(-tokens // BUCKET))
        self.gram_hash, self.trie = head_hash[head_count >= self.least], b""

    def __getstate__(self):  # what follows from the rest is made again
        return {k: x for k, x in self.__dict__.items() if k not in ("head_count", "name", "common", "hot", "trie")}

    @cached_property
    def head_count(self) -> np.ndarray:
        return self.count[self.rank]

    @cached_property
    def name(self) -> np.ndarray:
        """Hashes by code."""
        name = np.zeros(len(self.count), np.uint64)
        name[self.rank] = self.head_hash
        name[-2] = START
        return name

    @cached_property
    def common(self) -> np.ndarray:
        common = self.count >= self.least
        common[-2] = True  # the start is a context only, and in the trie whatever its share
        return common

    @cached_property
    def hot(self) -> np.ndarray:
        return self.count >= self.hot_least

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))

    def place(self, code: np.ndarray) -> np.ndarray:
        """Where arrays by code hold a word's value."""
        n = len(self.count) - 2
        return np.where(code < U64(n), code, np.where(code == CODE_START, U64(n), U64(n + 1))).astype(np.int64)


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    """Arrays of 64-bit values, byte by byte and compressed."""
    sizes = np.array([len(a) for a in arrays], np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(a.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays)
    return sizes + pa.compress(body, codec="zstd", asbytes=True)


def _spread(data: bytes, n: int) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, n)
    body = np.frombuffer(pa.decompress(data[8 * n:], int(sizes.sum()) * 8, codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for size in sizes.tolist():
        out.append(np.ascontiguousarray(body[at:at + 8 * size].reshape(8, size).T).view(np.uint64).ravel())
        at += 8 * size
    return out


BLOCKS = "bucket long, data binary"


def _blocks(bucket: np.ndarray, doc: np.ndarray, rows: np.ndarray, columns: list[np.ndarray]) -> pd.DataFrame:
    """Tokens by bucket: the rows of their texts, how many each has, columns
    (an empty one stays empty)."""
    order = np.argsort(bucket, kind="stable")
    cut = np.concatenate((np.flatnonzero(np.diff(bucket[order], prepend=-1)), [len(order)]))
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        at = order[a:b]
        first = np.flatnonzero(np.diff(doc[at], prepend=-1))
        texts = rows[doc[at[first]]]
        out.append((int(bucket[at[0]]), _squeeze([np.diff(texts, prepend=U64(0)), np.diff(first, append=len(at)), *(c[at] if len(c) else c for c in columns)])))
    return pd.DataFrame(out, columns=["bucket", "data"])


def _tokens_of(blocks) -> tuple:
    """``doc, rows, u, v, w, n`` of a bucket's blocks; ``n`` is the bigram's
    count where the block holds it."""
    parts, base = [], 0
    for data in blocks:
        rows, sizes, *columns = _spread(data, 6)
        rows = np.cumsum(rows, dtype=np.uint64)
        parts.append((np.repeat(np.arange(base, base + len(rows)), sizes.astype(np.int64)), rows, *columns))
        base += len(rows)
    doc, rows, u, v, w, n = (np.concatenate(x) for x in zip(*((*p[:5], p[5] if len(p[5]) else np.zeros(len(p[0]), np.uint64)) for p in parts)))
    return doc, rows, u, v, w, n


def _mix(*codes: np.ndarray) -> np.ndarray:
    h = codes[0]
    for c in codes[1:]:
        h = mix64(h) * WINDOW_BASE + c
    return mix64(h + U64(1))


def _numbered(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal tuples get equal numbers from 0 on; and one place of each."""
    code = None
    for c in columns:
        c, values = (c, None) if c.dtype == np.int64 else pd.factorize(c)
        size = int(c.max(initial=0)) + 1
        code = c if code is None else pd.factorize(code * np.int64(size) + c)[0]
    first = np.empty(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return code, first


TEXTS = "row long, doc_id string, held_out boolean, words binary, rare binary"


def _ranked(shared) -> "callable":
    """A task that writes each text as ranks (-1: none), with the hashes of
    those that have none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            for first, texts in text_chunks(pdf["text"]):
                t = _Run(texts)
                at = _lookup(m.head_hash, t.distinct)
                words = (np.where(at >= 0, m.rank[at], -1) if len(m.rank) else at).astype(np.int32)[t.code]
                name = t.distinct[t.code]
                out = pdf.iloc[first:first + len(texts)][["row", "doc_id", "held_out"]].copy()
                edges = list(zip(t.bounds[:-1], t.bounds[1:]))
                out["words"] = [words[a:b].tobytes() for a, b in edges]
                out["rare"] = [name[a:b][words[a:b] < 0].tobytes() for a, b in edges]
                yield out
    return run


def _sizes(values: pd.Series, width: int) -> np.ndarray:
    return np.fromiter(map(len, values), np.int64, len(values)) // width


def _before(bounds: np.ndarray) -> np.ndarray:
    """Per token how many are before it in its text."""
    return np.arange(bounds[-1]) - np.repeat(bounds[:-1], np.diff(bounds))


def _dealt(shared, hot: bool) -> "callable":
    """A task that deals the tokens whose word before is hot, or the others."""
    def deal(m: Model, pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.frombuffer(b"".join(pdf["words"]), np.int32)
        code, none = words.astype(np.int64).view(np.uint64), words < 0
        rare = np.frombuffer(b"".join(pdf["rare"]), np.uint64)
        code[none] = NONE if m.closed else rare | RARE
        sizes = _sizes(pdf["words"], 4)
        before = _before(np.concatenate(([0], np.cumsum(sizes))))
        v = np.where(before > 0, np.roll(code, 1), CODE_START)
        u = np.where(before > 1, np.roll(code, 2), np.where(before == 1, CODE_START, NONE))
        take = np.flatnonzero((v != NONE) & (m.hot[m.place(v)] == hot))
        u, v, w = u[take], v[take], code[take]
        doc = np.repeat(np.arange(len(pdf)), sizes)[take]
        rows = pdf["row"].to_numpy(np.int64).view(np.uint64) * U64(2) + (~pdf["held_out"].to_numpy(bool)).astype(np.uint64)
        bucket = (_mix(v, w) if hot else _mix(v)) % U64(m.buckets)
        return _blocks(bucket.astype(np.int64), doc, rows, [u, v, w, np.empty(0, np.uint64)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += int(_sizes(pdf["words"], 4).sum())
            if size >= _FLUSH:
                yield deal(shared.value, pd.concat(held))
                held, size = [], 0
        if size:
            yield deal(shared.value, pd.concat(held))
    return run


#: What buckets give back: texts' sums, words' back-off weights, n-grams of the
#: trie, and what waits for the count of a word without a rank.
SUMS, WORD, BIGRAM, BACK, TRIGRAM, WAITING = range(6)
GIVEN = "kind int, a long, b long, c long, x double, y double, data binary"


def _given(kind: int, **columns) -> pd.DataFrame:
    columns = {k: x.view(np.int64) if getattr(x, "dtype", None) == np.uint64 else x for k, x in columns.items()}
    out = pd.DataFrame({"kind": np.int32(kind), "a": 0, "b": 0, "c": 0, "x": 0.0, "y": 0.0, "data": None} | columns)
    return out.astype({"kind": np.int32, "a": np.int64, "b": np.int64, "c": np.int64})


def _counted_tokens(blocks):
    """A bucket's tokens, the numbers of their n-grams, their counts in the
    training texts, and which are kept."""
    doc, rows, u, v, w, n = _tokens_of(blocks)
    train = (rows & U64(1)).astype(float)[doc]
    (cu, _), (cv, first_v), (cw, _) = _numbered(u), _numbered(v), _numbered(w)
    vw, first_vw = _numbered(cv, cw)
    uvw, first3 = _numbered(vw, cu)
    count = lambda code, first: np.bincount(code, train, len(first))
    n2, n3 = count(vw, first_vw), count(uvw, first3)
    keep2 = (n2 >= LEAST) & (w[first_vw] != NONE)
    keep3 = (n3 >= LEAST) & (w[first3] != NONE) & (u[first3] != NONE)
    return doc, rows, train, (u, v, w, n), (cu, cv), first_v, (vw, first_vw, n2, keep2), (uvw, first3, n3, keep3)


def _first_deal(shared) -> "callable":
    """A bucket of hot words' bigrams: its tokens again, with their bigram's
    count; kept mass of the words and of pairs of hot words; common bigrams."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        doc, rows, _, (u, v, w, _), (cu, cv), first_v, (vw, first, n2, keep2), (_, first3, n3, keep3) = _counted_tokens(pdf["data"])
        blocks = _blocks(np.zeros(len(doc), np.int64), doc, rows, [u, v, w, n2[vw].astype(np.uint64)])
        held = np.bincount(cv[first], np.where(keep2, n2 - DISCOUNT, 0.0), len(first_v))
        often = np.flatnonzero((n2 >= min(m.least, m.hot_least)) & keep2)
        at = first3[in_hot := keep3 & m.hot[m.place(u[first3])]]
        uv, one = _numbered(cu[at], cv[at])
        mass = np.bincount(uv, (n3 - DISCOUNT)[in_hot], len(one))
        return pd.concat([_given(SUMS, data=blocks["data"]), _given(WORD, a=v[first_v], x=held),
                          _given(BIGRAM, a=v[first[often]], b=w[first[often]], x=n2[often]),
                          _given(BACK, a=u[at[one]], b=v[at[one]], x=mass)])
    return run


class Hot:
    """Of hot words (by code) and of pairs as common: count, kept mass."""

    def __init__(self, words: pd.DataFrame, pairs: pd.DataFrame):
        for of, t, keys in ((self.__dict__, words, lambda t: _unsigned(t["a"])),
                            (self.__dict__, pairs, lambda t: _mix(_unsigned(t["a"]), _unsigned(t["b"])))):
            key = keys(t)
            by = np.argsort(key)
            of["words" if t is words else "pairs"] = (key[by], t["n"].to_numpy(float)[by], t["x"].to_numpy(float)[by])


def _second_deal(shared, shared_hot) -> "callable":
    """A task that deals the hot words' tokens by their first pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, hot = shared.value, shared_hot.value
        for pdf in batches:
            for data in pdf["data"]:
                doc, rows, u, v, w, n = _tokens_of([data])
                pair = _mix(u, v)
                split = _lookup(hot.pairs[0], pair) >= 0
                bucket = np.where(split, _mix(u, v, w), pair) % U64(m.buckets)
                yield _blocks(bucket.astype(np.int64), doc, rows, [u, v, w, n])
    return run


def _safe_log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-9))


def _learnt(shared, shared_hot) -> "callable":
    """A bucket: its tokens' n-grams are counted, and each text gets the sum of
    what the trie does not give it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m, hot = shared.value, shared_hot.value
        doc, rows, train, (u, v, w, n), (cu, cv), first_v, (vw, first, n2, keep2), (uvw, first3, n3, keep3) = _counted_tokens(pdf["data"])
        # Words: what a hot one lacks here is known.
        name_v = v[first_v]
        n1, held = np.bincount(cv, train, len(first_v)), None
        at = _lookup(hot.words[0], name_v)
        is_hot, whole = at >= 0, (lambda here, known: np.where(at >= 0, known[at], here) if len(known) else here)
        n1 = whole(n1, hot.words[1])
        n2 = np.where(is_hot[cv[first]], n[first].astype(float), n2)
        keep2 = (n2 >= LEAST) & (w[first] != NONE)
        held = whole(np.bincount(cv[first], np.where(keep2, n2 - DISCOUNT, 0.0), len(first_v)), hot.words[2])
        back1 = 1 - held / np.maximum(n1, 1)
        in_v, in_w = m.common[m.place(name_v)], m.common[m.place(w[first])]
        weight = np.where(in_v, 0.0, _safe_log(back1.astype(np.float32)))
        # Bigrams v w.
        of = cv[first]
        uni = (m.count[m.place(w[first])] + 0.1) / (m.tokens + 0.1 * (m.distinct + 1))
        open_w = w[first] >= RARE  # its count is in the table of rare words
        a2 = np.where(keep2, (n2 - DISCOUNT) / np.maximum(n1[of], 1), 0.0)
        p2 = a2 + back1[of] * uni
        in2 = (n2 >= m.least) & keep2 & in_v[of] & in_w
        more2, wait2 = keep2 & ~in2 & ~open_w, keep2 & ~in2 & open_w
        gain2 = np.where(more2, _safe_log(p2) - _safe_log(back1)[of] - np.log10(uni), 0.0)
        # Pairs u v.
        uv, first_uv = _numbered(cu, cv)
        name = _mix(u[first_uv], v[first_uv])
        n_uv, mass = np.bincount(uv, train, len(first_uv)), np.bincount(uv[first3], np.where(keep3, n3 - DISCOUNT, 0.0), len(first_uv))
        at = _lookup(hot.pairs[0], name)
        n_uv, mass, split = whole(n_uv, hot.pairs[1]), whole(mass, hot.pairs[2]), at >= 0
        keep_uv = (n_uv >= LEAST) & (u[first_uv] != NONE)
        back2 = np.where(keep_uv, 1 - mass / np.maximum(n_uv, 1), 1.0)
        in_uv = (n_uv >= m.least) & keep_uv & m.common[m.place(u[first_uv])] & in_v[cv[first_uv]]
        add_uv = np.where(in_uv, 0.0, _safe_log(back2))
        # Trigrams, and per trigram all that its tokens get.
        g2, g_uv = vw[first3], uv[first3]
        a3 = np.where(keep3, (n3 - DISCOUNT) / np.maximum(n_uv[g_uv], 1), 0.0)
        p3 = a3 + back2[g_uv] * p2[g2]
        in3 = (n3 >= m.least) & keep3 & in_uv[g_uv] & in2[g2]
        more3 = keep3 & ~in3 & ~open_w[g2]
        each = weight[of][g2] + gain2[g2] + add_uv[g_uv] + np.where(more3, _safe_log(p3) - _safe_log(back2)[g_uv] - _safe_log(p2)[g2], 0.0)
        waits = np.flatnonzero(wait2[g2])
        on3 = keep3[waits]
        log1, log2 = _safe_log(back1)[of][g2[waits]], _safe_log(back2)[g_uv[waits]]
        each[waits] -= log1 + np.where(on3, log2, 0.0)
        # The texts' sums.
        row, where = np.unique(rows >> U64(1), return_inverse=True)
        total = np.bincount(where[doc], each[uvw], len(row))
        out = []
        for slot in np.split(np.arange(len(row)), np.flatnonzero(np.diff(row >> U64(_SLOT))) + 1):
            got = slot[total[slot] != 0]
            if len(got):
                sums = np.rint(total[got] * (1 << _FRACTION)).astype(np.int64)
                data = _squeeze([np.diff(row[got], prepend=U64(0)), ((sums << 1) ^ (sums >> 63)).view(np.uint64)])
                out.append((int(row[got[0]] >> U64(_SLOT)), data))
        parts = [_given(SUMS, a=np.array([k for k, _ in out], np.int64), data=[d for _, d in out])]
        if len(waits):
            of_token = np.full(len(first3), -1)
            of_token[waits] = np.arange(len(waits))
            tokens = np.flatnonzero(of_token[uvw] >= 0)
            pair, one = _numbered(where[doc[tokens]].astype(np.int64), of_token[uvw[tokens]])
            i = of_token[uvw[tokens[one]]]
            t = waits[i]
            alpha = np.where(on3[i], a3[t] + back2[g_uv[t]] * a2[g2[t]], a2[g2[t]])
            beta = np.where(on3[i], back2[g_uv[t]], 1.0) * back1[of[g2[t]]]
            parts.append(_given(WAITING, a=row[where[doc[tokens[one]]]], b=w[first3[t]], c=np.bincount(pair), x=alpha, y=beta))
        known = np.flatnonzero(~is_hot & (held > 0))
        here = np.flatnonzero(in2 & ~is_hot[of])
        mine, three = np.flatnonzero(in_uv & ~split & (back2 < 1)), np.flatnonzero(in3)
        parts += [_given(WORD, a=name_v[known], b=in_v[known].astype(np.int64), x=back1[known]),
                  _given(BIGRAM, a=v[first[here]], b=w[first[here]], x=p2[here]),
                  _given(BACK, a=u[first_uv[mine]], b=v[first_uv[mine]], x=back2[mine]),
                  _given(TRIGRAM, a=u[first3[three]], b=v[first3[three]], c=w[first3[three]], x=p3[three])]
        return pd.concat([p for p in parts if len(p)] or parts[:1])
    return run


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    """``row, gained``: the sums of all buckets for the texts of a slot."""
    both = [_spread(d, 2) for d in pdf["data"]]
    row = np.concatenate([np.cumsum(r, dtype=np.uint64) for r, _ in both])
    x = np.concatenate([x for _, x in both])
    x = ((x >> U64(1)) ^ (U64(0) - (x & U64(1)))).view(np.int64) / (1 << _FRACTION)
    row, where = np.unique(row, return_inverse=True)
    return pd.DataFrame({"row": row.view(np.int64), "gained": np.bincount(where, x, len(row))})


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of ``texts`` (``text`` as binary) and all words' ``key, n,
    back``."""
    docs = texts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.lit(False).alias("held_out"))
    model, _, words, *_ = _train(docs)
    return model, words


def _train(docs: DataFrame) -> tuple:
    """The model, its broadcast (without the trie), all words, the texts as ranks, and what the buckets gave, of
    ``doc_id, text, held_out``; those not held out are learnt from."""
    spark = docs.sparkSession

    def unigram_keys(run):
        t = _Run(run)
        return t.distinct[t.code]

    counts = materialize(_counts(docs.where("not held_out").select("text"), unigram_keys), "op6-unigrams")
    is_end = F.col("key") == int(END.view(np.int64))
    size = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(is_end, F.col("n"))).alias("ends")).first()
    # The least count that at most HEAD words have; what occurs once is in no kept n-gram.
    alike = counts.where(F.col("n") >= LEAST).groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    above = F.sum("words").over(Window.orderBy(F.desc("n")))
    ranked = alike.select("n", (above <= HEAD).alias("fits")).agg(
        F.min(F.when(F.col("fits"), F.col("n"))).alias("cut"), F.max(~F.col("fits")).alias("more")).first()
    cut = ranked["cut"] if ranked["cut"] is not None else int(size["n"] or 0) + 1
    head = _collected(counts.where(F.col("n") >= cut))
    by = np.argsort(_unsigned(head["key"]))
    model = Model(_unsigned(head["key"])[by], head["n"].to_numpy()[by], int(size["n"] or 0), int(size["v"]),
                  int(size["ends"] or 0), cut, not ranked["more"])
    del head, by
    shared = spark.sparkContext.broadcast(model)

    # Ids pass through pandas as text: a null beside them would make them floats.
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
    texts = materialize(named.mapInPandas(_ranked(shared), TEXTS), "op6-texts")
    blocks = texts.mapInPandas(_dealt(shared, False), BLOCKS)
    hot = Hot(none := pd.DataFrame({"a": [], "b": [], "n": [], "x": []}, dtype=np.int64), none.copy())
    bigrams = none
    if model.hot.any():
        first = materialize(texts.mapInPandas(_dealt(shared, True), BLOCKS).groupBy("bucket")
                            .applyInPandas(_first_deal(shared), GIVEN), "op6-hot")
        words = _collected(first.where(F.col("kind") == WORD).groupBy("a").agg(F.sum("x").alias("x")))
        words["n"] = model.count[model.place(_unsigned(words["a"]))]
        bigrams = _collected(first.where(F.col("kind") == BIGRAM).select("a", "b", F.col("x").alias("n")))
        again = bigrams[(bigrams["n"] >= HOT) & model.hot[model.place(_unsigned(bigrams["b"]))]]
        asked = F.broadcast(spark.createDataFrame(again, "a long, b long, n double"))
        pairs = (first.where(F.col("kind") == BACK).select("a", "b", "x").join(asked, ["a", "b"], "right")
                 .groupBy("a", "b", "n").agg(F.coalesce(F.sum("x"), F.lit(0.0)).alias("x")).toPandas())
        hot = Hot(words, pairs)
    shared_hot = spark.sparkContext.broadcast(hot)
    if model.hot.any():
        blocks = blocks.unionByName(first.where(F.col("kind") == SUMS).select("data").mapInPandas(_second_deal(shared, shared_hot), BLOCKS))
    given = materialize(blocks.groupBy("bucket").applyInPandas(_learnt(shared, shared_hot), GIVEN), "op6-given")

    # The trie: n-grams of at least a 1 / GRAMS share of the tokens.
    of = lambda kind, *columns: given.where(F.col("kind") == kind).select(*columns)
    back1 = np.ones(len(model.count))
    known = _collected(of(WORD, "a", "b", "x").where("b = 1"))
    back1[model.place(_unsigned(known["a"]))] = known["x"]
    hot_at = model.place(hot.words[0])
    back1[hot_at] = 1 - hot.words[2] / np.maximum(hot.words[1], 1)
    own = bigrams[(bigrams["n"] >= model.least) & model.common[model.place(_unsigned(bigrams["a"]))]
                  & model.common[model.place(_unsigned(bigrams["b"]))]]
    at_v, at_w = model.place(_unsigned(own["a"])), model.place(_unsigned(own["b"]))
    uni = (model.count[at_w] + 0.1) / (model.tokens + 0.1 * (model.distinct + 1))
    own = pd.DataFrame({"a": own["a"], "b": own["b"], "x": (own["n"] - DISCOUNT) / np.maximum(model.count[at_v], 1) + back1[at_v] * uni})
    top2 = pd.concat([_collected(of(BIGRAM, "a", "b", "x")), own], ignore_index=True)
    back2 = _collected(of(BACK, "a", "b", F.col("x").alias("back")))
    if model.hot.any():
        back2 = pd.concat([back2, pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "back": 1 - pairs["x"] / pairs["n"]})])
    top2 = top2.merge(back2, "left", ["a", "b"]).fillna({"back": 1.0})
    gram_hash, n_words = model.gram_hash, len(model.gram_hash)

    def ids(codes: pd.Series) -> np.ndarray:
        place = model.place(_unsigned(codes))
        return np.where(place == len(model.count) - 2, n_words, _lookup(gram_hash, model.name[place])).astype(np.int64)

    bigrams = np.stack([ids(top2["a"]), ids(top2["b"])], 1)
    by = np.lexsort((bigrams[:, 1], bigrams[:, 0]))
    bigrams, top2 = bigrams[by], top2.iloc[by]
    names = bigrams[:, 0] * (n_words + 1) + bigrams[:, 1]
    top3 = _collected(of(TRIGRAM, "a", "b", "c", "x"))
    u, v, w = ids(top3["a"]), ids(top3["b"]), ids(top3["c"])
    trigrams = np.stack([_lookup(names, u * (n_words + 1) + v), _lookup(names, v * (n_words + 1) + w)], 1)
    by = np.lexsort((trigrams[:, 1], trigrams[:, 0]))
    of_words = back1[model.rank[_lookup(model.head_hash, gram_hash)]].astype(np.float32) if n_words else np.empty(0, np.float32)
    trie = Trie.build(n_words, bigrams, _safe_log(top2["x"].to_numpy(float)), _safe_log(np.append(of_words, back1[-2]).astype(float)),
                      _safe_log(top2["back"].to_numpy(float)), trigrams[by].astype(np.int64), _safe_log(top3["x"].to_numpy(float)[by]))
    model.trie = trie.to_bytes()

    # Names of words with a rank, by code; a name without one is its code but for one bit.
    backs = of(WORD, "a", "x")
    if len(hot.words[0]):
        extra = pd.DataFrame({"a": hot.words[0].view(np.int64), "x": back1[hot_at]})
        backs = backs.unionByName(spark.createDataFrame(extra, "a long, x double"))

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            code = _unsigned(pdf["a"])
            yield pd.DataFrame({"name": np.where(code >= RARE, code, m.name[m.place(code)] | RARE).view(np.int64), "back": pdf["x"]})

    words = (counts.withColumn("name", F.col("key").bitwiseOR(F.lit(-(1 << 63))))
             .join(backs.mapInPandas(hashes, "name long, back double"), "name", "left")
             .select("key", "n", F.coalesce("back", F.lit(1.0)).alias("back")))
    return model, shared, words, texts, given
def held_out(id_col: Column, parts: int = 10) -> Column:
    """crc32 of the id as text is a multiple of ``parts``; null: not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == 0, F.lit(False))


SCORED = ("row long, doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, "
          "score double, rare array<long>")


def held_out(id_col: Column, parts: int = 10) -> Column:
    """crc32 of the id as text is a multiple of ``parts``; null: not."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == 0, F.lit(False))


def _scored(shared, shared_trie) -> "callable":
    """A task that scores texts by the trie and the words' counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        trie = Trie.from_buffer(shared_trie.value)
        # By rank, for the start and for a word without a rank: ids in the trie, logs.
        ids = np.append(_lookup(m.gram_hash, m.name[:-2]), [len(m.gram_hash), -1])
        logs = np.append(m.unigram(m.count[:-1]), 0.0)
        for pdf in batches:
            words = np.frombuffer(b"".join(pdf["words"]), np.int32).astype(np.int64)
            sizes = _sizes(pdf["words"], 4)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            before = _before(bounds)
            w, start = ids[words], len(m.gram_hash)
            v = np.where(before > 0, np.roll(w, 1), start)
            u = np.where(before > 1, np.roll(w, 2), np.where(before == 1, start, -1))
            uni = logs[words]  # a rare word's unigram part comes from the join: 0 for now
            full = trie.log10_over_unigram(u, v, w, uni)
            add = lambda x: np.add.reduceat(x, bounds[:-1])
            out = pdf[["row", "doc_id", "held_out"]].copy()
            out["n_tokens"], out["n_known"] = sizes, add((words >= 0).astype(np.int64))
            out["base_score"], out["score"] = add(uni), add(full)
            out["rare"] = [np.frombuffer(x, np.int64) for x in pdf["rare"]]
            yield out
    return run


def score(docs: DataFrame) -> DataFrame:
    """Train on the part of ``docs`` not held out and score every row."""
    docs = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    model, shared, counts, texts, given = _train(docs.withColumn("held_out", held_out(F.col("doc_id"))))
    tokens, distinct = model.tokens, model.distinct
    shared_trie = docs.sparkSession.sparkContext.broadcast(model.trie)
    scored = texts.mapInPandas(_scored(shared, shared_trie), SCORED).withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = materialize(scored, "op6-scored")
    rare = scored.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("times"))
    few = counts.where(F.col("n") < model.cut).select("key", "n")
    known = F.col("n").isNotNull()
    uni = (F.coalesce("n", F.lit(0)) + 0.1) / (tokens + 0.1 * (distinct + 1))
    rest = (rare.join(few, "key", "left").groupBy("row")
            .agg(F.sum(F.log10(uni) * F.col("times")).alias("more"),
                 F.sum(F.when(known, F.col("times")).otherwise(0)).alias("more_known")))
    waiting = (given.where(F.col("kind") == WAITING).select(F.col("a").alias("row"), F.col("b").alias("name"), "c", "x", "y")
               .join(few.select(F.col("key").bitwiseOR(F.lit(-(1 << 63))).alias("name"), "n"), "name")
               .groupBy("row").agg(F.sum((_log10(F.col("x") + F.col("y") * uni) - F.log10(uni)) * F.col("c")).alias("waited")))
    gained = (given.where(F.col("kind") == SUMS).select(F.col("a").alias("slot"), "data")
              .groupBy("slot").applyInPandas(_added, "row long, gained double"))
    plus = lambda c: F.coalesce(c, F.lit(0.0))
    out = scored.drop("rare").join(rest, "row", "left").join(gained, "row", "left")
    if model.closed:
        out = out.withColumn("waited", F.lit(0.0))  # a word without a rank is in no kept n-gram
    else:
        out = out.join(waiting, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(tokens).cast("long").alias("train_tokens"),
                      (F.col("base_score") + plus("more")).alias("base_score"),
                      (F.col("score") + plus("more") + plus("gained") + plus("waited")).alias("score"))

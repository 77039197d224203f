"""Packing by concatenate and cut, with a two-pass prefix sum.

Pass 1 tokenizes each text once, in the order of its input partition, and
writes ids, the partition's number and the running token total inside the
partition. The partitions' totals give each partition its base offset (one row
per partition), so every document knows its place in the concatenation without
a shuffle of the data. Pass 2 cuts the concatenation into windows of
``length`` ids: one row per piece of a document, with boundary records
(``continued``, ``continues``) where a window's edge runs through it.

All sequences but the last are full. Written files hold the order: a lost
executor in pass 2 reads the same partition numbers and offsets again.

Defined results: null text is empty and contributes its separator only; null
ids and repeated rows are documents like any other; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import read_text
from .common import BoundedCache, materialize, text_batches

LENGTH = 1024
#: Ids pass through pandas as text: a null beside them would make them floats.
TOKENS = "doc_id string, part int, before long, n long, ids binary"


def byte_spelling() -> dict[int, str]:
    """The character that byte-level vocabularies spell each byte with:
    printable Latin-1 characters themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


#: Code points without a space from which a text goes unit by unit: an engine
#: by ranks takes time in the square of a pre-token's length.
LONG_RUN = 2000


class TokenizerFile:
    """A ``tokenizers`` file of byte-level BPE, with the library's ids.

    Texts are encoded by merge ranks (``tiktoken``'s engine, about twice as fast
    as calls of the library's model by pre-token). That gives the file's own ids
    if no token is made by two merges and each merged token's text is encoded as
    that token (then two neighbours that make a token are always the pair of its
    merge, and ranks order merges as the file does); both are checked when the
    encoder is made, and other files are encoded by the library's model.

    So are texts with a run of ``LONG_RUN`` code points without a space (or of
    spaces), whose time must not grow with the square of the run. Such a text is
    cut at spaces that follow something other than white space: no pre-token and
    no lookahead of the pattern reaches over such a place, so each unit (mostly
    a word with its space and punctuation) is split by itself and its pre-tokens
    are encoded once.

    ``added_tokens``: names of the file's added tokens in a text are those
    tokens, as in the library's plain call; otherwise they are text like any
    other.
    """

    def __init__(self, json_text: str, pattern: str, separator: int = 0, added_tokens: bool = False):
        self.json_text, self.pattern, self.separator, self.added_tokens = json_text, pattern, separator, added_tokens
        self._encoder = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_encoder": None}  # each process makes its own

    def encoder(self) -> Callable[[str | None], bytes]:
        """text -> packed ids and the separator; the caches last as long as
        the worker process keeps this object."""
        if self._encoder is None:
            self._encoder = self._make()
        return self._encoder

    def _make(self) -> Callable[[str | None], bytes]:
        by_rank, by_unit = self._by_rank(), self._by_unit()
        spaces = " " * LONG_RUN

        def encode(text: str) -> bytes:
            if by_rank and (len(text) < LONG_RUN or (
                    max(map(len, text.split(" "))) < LONG_RUN and spaces not in text)):
                return by_rank(text)
            return by_unit(text)

        end = _packed([self.separator])
        added = self._added()
        if not added:
            return lambda text: encode(text or "") + end
        # Longest first, as the library matches them; a group keeps the names.
        names = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        added = {name: _packed([i]) for name, i in added.items()}

        def whole(text: str | None) -> bytes:
            text = text or ""
            if not any(name in text for name in added):
                return encode(text) + end
            return b"".join(added.get(part) or encode(part) for part in names.split(text)) + end

        return whole

    def _by_rank(self) -> Callable[[str], bytes] | None:
        import tiktoken
        from tokenizers import Tokenizer

        file = json.loads(self.json_text)["model"]
        byte_of = {c: b for b, c in byte_spelling().items()}
        if file.get("type") != "BPE" or any(file.get(k) for k in (
                "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in file["merges"]]
        tokens = [*sorted(t for t in file["vocab"] if len(t) == 1), *pairs]
        model = Tokenizer.from_str(self.json_text).model
        if (len(set(tokens)) != len(tokens) or len(tokens) - len(pairs) != 256 or not set("".join(tokens)) <= byte_of.keys()
                or any([t.value for t in model.tokenize(p)] != [p] for p in pairs)):
            return None
        ids = np.array([file["vocab"][t] for t in tokens], "<u4")
        engine = tiktoken.Encoding("file", pat_str=self.pattern, special_tokens={}, mergeable_ranks={
            bytes(byte_of[c] for c in t): rank for rank, t in enumerate(tokens)})
        ranks_of = engine.encode_to_numpy
        return lambda text: ids[ranks_of(text, disallowed_special=())].tobytes()

    def _by_unit(self) -> Callable[[str], bytes]:
        from tokenizers import Tokenizer

        # The tokenizer's model on one pre-token, spelt in its byte alphabet.
        tokenize, spelling = Tokenizer.from_str(self.json_text).model.tokenize, byte_spelling()

        def one(piece: str) -> bytes:
            return _packed([t.id for t in tokenize(piece.encode().decode("latin-1").translate(spelling))])

        split, pre_tokens = regex.compile(self.pattern).findall, BoundedCache(one)
        unit = lambda text: b"".join(map(pre_tokens.__getitem__, split(text)))

        def encode(text: str) -> bytes:
            run, *rest = text.split(" ")
            out = []
            for r in rest:
                # Taking more for white space than the pattern does only makes a unit longer.
                if run and not run[-1].isspace():
                    out.append(unit(run))
                    run = ""
                run += " " + r
            return b"".join(out) + unit(run)

        return encode

    def _added(self) -> dict[str, int]:
        if not self.added_tokens:
            return {}
        listed = json.loads(self.json_text).get("added_tokens") or []
        if any(t.get(flag) for t in listed for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that strip, normalise or want whole words are not supported")
        return {t["content"]: t["id"] for t in listed}


def load_tokenizer(path: str, pattern: str, added_tokens: bool = False) -> TokenizerFile:
    return TokenizerFile(read_text(path), pattern, added_tokens=added_tokens)


def tokenized(docs: DataFrame, tokenizer: TokenizerFile) -> DataFrame:
    """Pass 1: ``doc_id, part, before, n, ids`` as a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, total = shared.value.encoder(), TaskContext.get().partitionId(), 0
        for pdf in batches:
            ids = [encode(t) for t in pdf["text"]]
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            ends = total + np.cumsum(n)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "part": part, "before": ends - n,
                                "n": n, "ids": pd.Series(ids, dtype=object)})
            total = int(ends[-1]) if len(ends) else total

    narrow = text_batches(docs).select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    tokens = narrow.mapInPandas(run, TOKENS).withColumn("doc_id", F.col("doc_id").cast("long"))
    return materialize(tokens, "op3-tokens")


def cut(tokens: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pass 2: the pieces of the windows of ``length`` ids."""
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    # One row per input partition; no key: the prefix sum runs over all.
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    first = F.col("base") + F.col("before")
    # As many rows as input partitions, so never near the size of the data;
    # without the hint, the ids would be shuffled to meet them.
    placed = tokens.join(F.broadcast(base), "part").select("doc_id", "n", "ids", first.alias("first"))

    def piece(seq):
        start = F.greatest(seq * length - F.col("first"), F.lit(0))
        size = F.least((seq + 1) * length - F.col("first"), F.col("n")) - start
        return F.struct(
            start.alias("start"), size.alias("length"), seq.alias("sequence_id"),
            F.greatest(F.col("first") - seq * length, F.lit(0)).alias("offset"),
            F.crc32(F.col("ids").substr((start * 4 + 1).cast("int"), (size * 4).cast("int"))).alias("ids_crc32"),
            (start > 0).alias("continued"), (start + size < F.col("n")).alias("continues"))

    windows = F.sequence(F.floor(F.col("first") / length), F.floor((F.col("first") + F.col("n") - 1) / length))
    return (placed.select("doc_id", F.col("n").alias("doc_tokens"),
                          F.explode(F.transform(windows, piece)).alias("p"))
            .select("doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset",
                    "p.continued", "p.continues"))


def pack(docs: DataFrame, tokenizer: TokenizerFile, length: int = LENGTH) -> DataFrame:
    return cut(tokenized(docs, tokenizer), length)

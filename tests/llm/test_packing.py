import json
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardgeo.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_the_librarys(tokenizer, reference):
    encode = tokenizer.encoder()
    for t in ["", None, "Hello  world\n\n isn't it", "größer ½ 日本語 🙂", "<|endoftext|>", "a" * 3000, "\x00 \t　z"]:
        assert np.frombuffer(encode(t), "<u4").tolist() == reference(t)


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


ODD = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", " <|endoftext|> x", "<|endoftext", "a  b", "a \n b", "a\n b", " a", "  a ",
       "a ", "\n", " ", "a \t\u3000 b", "x\x1f y", "x\u2028 y \u00a0 z", "it's  we'll 're", "1 2  3\r\n\r\n4", "a" * 100 + " " + "b" * 100]


def test_ids_of_the_plain_call(plain):
    """The library as it comes, its added token included."""
    encode = packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, True).encoder()
    for t in ODD + [" ".join(ODD), "\n".join(ODD)]:
        assert np.frombuffer(encode(t), "<u4").tolist() == plain(t), repr(t)


@pytest.fixture(scope="module")
def encode_plain():
    return packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, True).encoder()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", " ", "a", "Bc", "é", "1", ".", "'s", "\n", "\t", "\u3000", "\x1e", "🙂", "<|endoftext|>"]),
                max_size=30).map("".join))
def test_units_do_not_change_ids(plain, encode_plain, text):
    assert np.frombuffer(encode_plain(text), "<u4").tolist() == plain(text)


def test_long_runs_and_other_files(plain, encode_plain):
    """Runs that go unit by unit, in linear time; a file whose merges are not
    in rank order goes the same way."""
    for t in ["ab" * 5000 + " x  y", "word " * 10 + " " * 5000 + "end", "é" * 3000, "x " * 5000, "。，" * 2500 + "\n a"]:
        assert np.frombuffer(encode_plain(t), "<u4").tolist() == plain(t)
    at = time.time()
    encode_plain("a" * 400_000), encode_plain(" " * 400_000 + "a")
    assert time.time() - at < 60
    path = public_tokenizers.path("byte_bpe_50k.json")
    file = json.loads(open(path).read())
    file["model"]["merges"].append(file["model"]["merges"][0])  # one token by two merges
    other = packing.TokenizerFile(json.dumps(file), public_tokenizers.PATTERN, added_tokens=True)
    assert other._by_rank() is None
    library = Tokenizer.from_str(json.dumps(file))
    for t in ODD:
        assert np.frombuffer(other.encoder()(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids + [0]


def check(rows, texts, reference, length):
    """Every id once, in gapless full sequences, with its piece's crc."""
    by_sequence, left = {}, {}
    for i, t in texts:
        left.setdefault(i, []).append(reference(t))
    for r in rows:
        assert any(r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(
            np.array(x[r.start:r.start + r.length], "<u4").tobytes()) for x in left[r.doc_id])
        assert r.continued == (r.start > 0) and r.continues == (r.start + r.length < r.doc_tokens)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(x) for v in left.values() for x in v)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == length or s == len(by_sequence) - 1


def test_concatenate_and_cut(spark, tokenizer, reference):
    texts = [(i, f"word{i} " * (i * 7 % 90)) for i in range(40)]
    texts += [(None, "no id"), (3, None), (4, ""), (4, ""), (50, "long text, " * 900)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, length int, start int")
    rows = packing.pack(df.repartition(5), tokenizer, length=64).collect()
    check(rows, texts, reference, 64)
    for i, t in texts:
        if i not in (3, 4, None):
            mine = sorted((r.start, r.length) for r in rows if r.doc_id == i)
            assert mine[0][0] == 0 and sum(n for _, n in mine) == len(reference(t))


def test_one_document_fills_sequences_exactly(spark, tokenizer):
    df = spark.createDataFrame([(1, "a " * 63)], "doc_id long, text string")
    n = packing.tokenized(df, tokenizer).first().n
    rows = packing.pack(df, tokenizer, length=int(n)).collect()
    assert [(r.start, r.length, r.sequence_id, r.offset) for r in rows] == [(0, n, 0, 0)]


def test_empty_table(spark, tokenizer):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer).collect() == []

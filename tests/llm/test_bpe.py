import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cardgeo.llm import bpe


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(model):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})


TEXTS = ["", "a", "The idea isn't  new.\n\n\tDon't!", "größer als ½ ǅ", "日本語のテキスト 123", "  x　y ", "🙂🙂",
         "ab" * 3000, "<|endoftext|>", "x" * 5000 + " end", "\x00\x1c\x85"]


def test_perfect_hash_is_minimal_and_exact(model):
    h = model.whole
    assert len(h.key) == len(model.ranks) and set(h.key) == set(model.ranks)
    assert all(h.get(k) == v for k, v in model.ranks.items())
    assert h.get(b"no such piece at all") == -1


def test_small_perfect_hashes():
    for n in (1, 2, 3, 50):
        keys = [bytes([i, 7]) for i in range(n)]
        h = bpe.MinimalPerfectHash(keys, list(range(n)))
        assert [h.get(k) for k in keys] == list(range(n)) and h.get(b"zz") == -1


def test_same_ids_as_tiktoken(model, reference):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choices("abcdeé ñß'.,\n0123", k=r.randint(1, 60))) for _ in range(300)]
    encode = model.encoder()
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == reference.encode_ordinary(t)
        assert model.decode(encode(t)) == t.encode()


def test_columns(spark, model, reference):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS + [None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = bpe.decode(bpe.encode(df, model), model).withColumn("list", bpe.unpack_ids("ids"))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows) and out.columns[:3] == df.columns
    for i, t, _ in rows:
        assert got[i]["list"] == reference.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode()
    assert bpe.encode(df.limit(0), model).collect() == []


def test_bounded_cache_keeps_values():
    from cardgeo.llm.common import BoundedCache
    made = []
    cache = BoundedCache(lambda k: made.append(k) or k * 2, limit=3)
    assert [cache[k] for k in (1, 2, 3, 4, 1, 5, 6, 7, 8, 1)] == [2, 4, 6, 8, 2, 10, 12, 14, 16, 2]
    assert len(cache) <= 3 and len(cache.old) <= 3


def test_repeats_nulls_and_clashing_columns(spark):
    import public_tokenizers
    from cardgeo.llm import bpe
    model = bpe.load_model(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [(1, "same text", "a", "b"), (1, "same text", "c", "d"), (None, "same text", "e", None), (2, None, None, "f"), (3, "", "g", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    out = bpe.decode(bpe.encode(df, model), model).collect()
    assert sorted(str((r.doc_id, r.text, bytes(r.decoded))) for r in out) == sorted(
        str((i, t, (t or "").encode())) for i, t, _, _ in rows)
    assert bpe.decode(bpe.encode(df.limit(0), model), model).collect() == []

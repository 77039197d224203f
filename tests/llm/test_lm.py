import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cardgeo.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_elias_fano_reads_what_was_written():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (1, 10 ** 9), (7, 3), (1000, 10 ** 7), (1000, 300)):
        v = np.sort(rng.integers(0, top, n))
        e = lm.EliasFano(lm.EliasFano.build(v))
        assert e.get(np.arange(n)).tolist() == v.tolist()
    v = np.unique(rng.integers(0, 10 ** 6, 500))
    e, wanted = lm.EliasFano(lm.EliasFano.build(v)), np.concatenate([v, v + 1])
    got = e.find(np.zeros(len(wanted), np.int64), np.full(len(wanted), len(v)), wanted)
    assert all((v[g] == w) if g >= 0 else w not in v for g, w in zip(got, wanted))


def tiny_trie():
    """Words 0..3; the start is 4."""
    bigrams = np.array([(0, 1), (0, 2), (1, 2), (4, 0), (4, 1)])
    trigrams = np.array([(0, 2), (3, 0), (3, 1)])  # 0 1 2, start 0 1, start 0 2
    return lm.Trie.build(4, bigrams, [-.1, -.2, -.3, -.4, -.5], [-1.0, -1.1, -1.2, -1.3, -1.4],
                         [-2.0, -2.1, -2.2, -2.3, -2.4], trigrams, [-.01, -.02, -.03])


def test_trie_by_file_and_buffer(tmp_path):
    path = tmp_path / "model"
    path.write_bytes(tiny_trie().to_bytes())
    for trie in (tiny_trie(), lm.Trie.open(str(path))):
        u, v, w = (np.array(x) for x in ([0, 4, 4, 0, 1, -1], [1, 0, 0, 2, 2, 1], [2, 1, 2, 3, 3, 2]))
        got = trie.log10_over_unigram(u, v, w, np.full(6, -5.0))
        # found, found, found, no bigram 2 3 after "0 2" and "1 2", bigram 1 2 after an outsider
        assert np.allclose(got, [-.01, -.02, -.03, -2.1 - 1.2 - 5, -2.2 - 1.2 - 5, -.3], atol=1e-2)  # quantised


def corpus(n=400, seed=1):
    r = random.Random(seed)
    nouns, verbs = "cat dog bird Fish".split(), "sees hears likes".split()
    rows = [(i, ". ".join(f"The {r.choice(nouns)} {r.choice(verbs)} the {r.choice(nouns)} x{r.randint(0, 300)}"
                          for _ in range(r.randint(1, 6)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (None, "The cat sees"), (5, rows[5][1]), (1002, "unseenword " * 3)]


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return WORD.findall(low) + [None]


@pytest.mark.parametrize("head", [1 << 21, 64])  # all words broadcast; most of them joined
def test_base_scores(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, n int")
    out = lm.score(df).collect()
    count = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in tokens(t))
    total = sum(count.values())
    assert len(out) == len(rows)
    better = worse = 0
    for r in out:
        t = next(t for i, t in rows if i == r.doc_id)
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in tokens(t))
        assert abs(r.base_score - base) < 1e-6
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (
            len(tokens(t)), sum(w in count for w in tokens(t)), total)
        if r.held_out and t:
            better, worse = better + (r.score > r.base_score), worse + (r.score <= r.base_score)
    assert better > 5 * max(worse, 1)  # contexts help on texts not learned from


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([(t,) for _, t in corpus()], "text string").selectExpr("cast(text as binary) text")
    model, counts = lm.train(texts)
    trie = lm.Trie.from_buffer(model.trie)
    n = len(model.gram_hash)
    assert n > 5 and trie.words2.n > 5 and trie.words3.n > 5
    every = [np.arange(n), np.full(1, -1)]  # the trie's words; the others meet the back-off weight
    w = np.concatenate(every)
    uni = np.concatenate([model.unigram(model.head_count[lm._lookup(model.head_hash, model.gram_hash)]), [0.0]])
    rest = 1 - (10 ** uni[:-1]).sum()  # the other words' unigram mass, unseen ones included
    for u, v in np.random.default_rng(0).integers(0, n, (60, 2)).tolist() + [(n, 0), (n, 1), (-1, 2)]:
        p = 10 ** trie.log10_over_unigram(np.full(n + 1, u), np.full(n + 1, v), w, uni)
        total = p[:-1].sum() + p[-1] * rest
        assert 0.95 < total < 1.05  # exact but for the quantised values
    assert counts.count() == model.distinct


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(df).collect() == []


def brute_scores(rows):
    """Scores with every n-gram seen at least twice, in dicts."""
    train = [tokens(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for t in train for w in t) + Counter({0: len(train)})
    two = Counter(g for t in train for g in zip([0, *t], t))
    three = Counter(g for t in train for g in zip([0, *t], t, t[1:]))
    total = sum(one.values()) - len(train)
    two, three = ({g: n for g, n in c.items() if n >= 2} for c in (two, three))
    held1, held2 = Counter(), Counter()
    for (v, _), n in two.items():
        held1[v] += n - lm.DISCOUNT
    for (u, v, _), n in three.items():
        held2[u, v] += n - lm.DISCOUNT

    def p(u, v, w):
        uni = ((one[w] if w != 0 else 0) + 0.1) / (total + 0.1 * len(one))
        p2 = (max(two.get((v, w), 0) - lm.DISCOUNT, 0) + (one[v] - held1[v]) * uni) / one[v] if one[v] else uni
        n = two.get((u, v), 0)
        return (max(three.get((u, v, w), 0) - lm.DISCOUNT, 0) + (n - held2[u, v]) * p2) / n if n else p2

    return lambda t: sum(math.log10(p(u, v, w)) for u, v, w in zip([None, 0, *t], [0, *t], t))


@pytest.mark.parametrize("head, grams", [(1 << 21, 1 << 16), (1 << 21, 32), (64, 16), (64, 1 << 16)])
def test_rare_ngrams_count_whatever_the_tries_size(spark, monkeypatch, head, grams):
    monkeypatch.setattr(lm, "HEAD", head)
    monkeypatch.setattr(lm, "GRAMS", grams)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_scores(rows)
    for r in lm.score(df).collect():
        t = tokens(next(t for i, t in rows if i == r.doc_id))
        assert abs(r.score - want(t)) < 0.03 * len(t)  # the trie's values are quantised


@pytest.mark.parametrize("head, grams, hot, bucket", [(1 << 21, 1 << 16, 1 << 20, 300), (1 << 21, 1 << 16, 60, 300),
                                                      (1 << 21, 32, 100, 500), (40, 1 << 16, 60, 400)])
def test_words_dealt_over_buckets_score_the_same(spark, monkeypatch, head, grams, hot, bucket):
    """Whatever is dealt by word, pair or triple, each n-gram counts once and whole."""
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_scores(rows)
    for name, value in (("HEAD", head), ("GRAMS", grams), ("HOT", hot), ("BUCKET", bucket)):
        monkeypatch.setattr(lm, name, value)
    out = lm.score(df).collect()
    assert len(out) == len(rows)
    for r in out:
        t = tokens(next(t for i, t in rows if i == r.doc_id))
        assert abs(r.score - want(t)) < (0.03 if grams == 32 else 0.015) * len(t)


def test_little_is_written(spark):
    """All tables that a run writes together take less than its texts, though
    nearly every n-gram is kept or asked for."""
    import glob
    import os

    r = random.Random(3)
    words = [f"word{i}" for i in range(2000)]
    share = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(r.choices(words, share, k=200))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{root}/**/*.parquet", recursive=True))
    before = size()
    assert len(lm.score(df).collect()) == len(rows)
    assert size() - before < sum(len(t) for _, t in rows)

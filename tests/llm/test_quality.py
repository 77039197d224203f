import random
import re
from collections import Counter

import numpy as np
import pytest

from cardgeo.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    n = len(words)
    windows = [tuple(words[i:i + 8]) for i in range(n - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)]


TEXTS = ["", " \n\t", "one", "a b c d e f g h a b c d e f g h", "x\nx\n x\nx\n\n", "é#ü$ <b> 日本 | & *", "w " * 40,
         "\x1f is no space\x0b here"]


def test_rules_by_brute_force():
    r = random.Random(0)
    texts = TEXTS + [" ".join(r.choices("ab#é", k=r.randint(0, 60))) + "\n" * r.randint(0, 2) for _ in range(100)]
    got = q.text_rules([t.encode() for t in texts]).astype(int).to_numpy().tolist()
    assert got == [brute(t) for t in texts]


def test_gram_keys_cover_each_text():
    texts = ["ab  c", "", "日本🙂"]
    keys, bounds = q.gram_keys([t.encode() for t in texts])
    unit = lambda k: [int(k) >> s & 0xFFFF for s in (48, 32, 16, 0)]
    assert np.diff(bounds).tolist() == [5, 1, 5]  # "ab c" and an end; the emoji is two units
    assert unit(keys[0]) == [2, 2, 2, ord("a")] and unit(keys[4])[-1] == 3 and unit(keys[5]) == [2, 2, 2, 3]


def english(spark, extra=()):
    r = random.Random(7)
    words = "the of and to in that is was for with his as on be at by had not are but from or have an they".split()
    rows = [(i, " ".join(r.choices(words, k=60)) + ".", "en", True) for i in range(60)]
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, lang string, kept boolean")


def test_probabilities_sum_to_one(spark):
    model = q.fit(english(spark).selectExpr("cast(text as binary) text", "lang"))
    grams, _ = q.gram_keys(["the of was not seen zq".encode()])
    every = np.arange(1 << 16, dtype=np.uint64)
    for g in grams[::4]:
        p = np.exp(model.log_probability("en", (g & ~np.uint64(0xFFFF)) | every))
        assert abs(p.sum() - 1) < 1e-4


def test_verdicts(spark):
    r = random.Random(9)
    noise, other = ("".join(chr(r.randint(0x4E00, 0x9000)) + " " for _ in range(80)) for _ in range(2))
    extra = [(100, noise, "en", True), (101, None, "en", True), (102, "", None, True), (103, "too short", "en", True),
             (104, "the of and to in that is was for with " * 6, "en", True), (None, other, "en", True),
             (0, "the of and to in that is was", "xx", True)]
    out = q.quality(english(spark, extra)).collect()
    assert len(out) == 67
    of = lambda i: [x for x in out if x.doc_id == i]
    assert sum(x.kept for x in out if x.doc_id is not None and x.doc_id < 60 and x.n_words == 60) >= 58
    assert not of(100)[0].kept and not of(100)[0].base_failed and not of(None)[0].kept
    assert [of(i)[0].base_failed for i in (101, 102, 103, 104)] == [True] * 4
    assert (of(101)[0].n_words, of(104)[0].n_repeat_words) == (0, 60)


def test_empty_table(spark):
    assert q.quality(english(spark).limit(0)).collect() == []


def test_copies_move_no_verdict(spark):
    """One text at most of a language's rows: as if it were there once."""
    r = random.Random(11)
    copied = " ".join(r.choices("zebra quartz jumps vexed fjord waltz".split(), k=60)) + "."
    of = lambda n: {x.doc_id: (x.kept, round(x.log_ppl, 9), round(x.low, 9), round(x.high, 9))
                    for x in q.quality(english(spark, [(100 + i, copied, "en", True) for i in range(n)])).collect()}
    once, often = of(1), of(200)
    assert len(often) == 260 and {i: often[i] for i in once} == once
    assert len({often[i] for i in range(100, 300)}) == 1 and sum(often[i][0] for i in range(60)) >= 58


def kneser_ney(texts):
    """The same model in plain dictionaries: ``log P`` of a gram of units."""
    order = q.ORDER
    counts = [Counter() for _ in range(order + 1)]
    for t in set(texts):
        u = [2] * (order - 1) + [int(x) for x in np.frombuffer(" ".join(t.split()).encode("utf-16-le"), "<u2")] + [3]
        counts[order].update(tuple(u[i:i + order]) for i in range(len(u) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k].update(g[1:] for g in counts[k + 1])
    prob, back = {}, {}
    for k in range(order, 0, -1):
        c, of = counts[k], Counter(counts[k].values())
        y = of[1] / max(of[1] + 2 * of[2], 1)
        cut = [0] + [min(max(min(i - (i + 1) * y * of[i + 1] / of[i], i - 0.05), 0.05), 9) if of[i] else 0.5 for i in (1, 2, 3)]
        total, held = Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            if n > 1 or k == 1:
                held[g[:-1]] += n - cut[min(n, 3)]
        for g, n in c.items():
            if n > 1 or k == 1:
                prob[g] = (n - cut[min(n, 3)]) / total[g[:-1]]
                back[g[:-1]] = 1 - held[g[:-1]] / total[g[:-1]]

    def p(g):
        if not g:
            return 1 / 65536
        return prob.get(g, 0.0) + back.get(g[:-1], 1.0) * p(g[1:])

    return lambda g: np.log(p(g))


def test_model_by_brute_force(spark):
    df = english(spark, [(200, "the of and to in that is was", "fr", True), (201, "# $ % junk # $ %", "en", True)])
    rows = df.collect()
    model = q.fit(df.unionByName(df).selectExpr("cast(text as binary) text", "lang"))  # copies teach nothing
    unit = lambda k: tuple(int(k) >> s & 0xFFFF for s in (48, 32, 16, 0))
    for lang in ("en", "fr"):
        by_hand = kneser_ney([r.text for r in rows if r.lang == lang and "#" not in r.text])
        for t in ["the of and", "never seen 日本 #", "", "was was was"]:
            grams, _ = q.gram_keys([t.encode()])
            assert np.allclose(model.log_probability(lang, grams), [by_hand(unit(g)) for g in grams], atol=1e-5)


def test_largest_entries_are_kept(spark, monkeypatch):
    """A bound that binds leaves the rarest out, each language for itself."""
    monkeypatch.setattr(q, "ENTRIES", 50)
    df = english(spark, [(300, "un deux trois un deux trois un deux", "fr", True)]).selectExpr("cast(text as binary) text", "lang")
    small = q.fit(df)
    sizes = {key: len(v[0]) for key, v in small.of.items()}
    assert all(n <= 50 for n in sizes.values()) and sizes["en", 4] > 25 and ("fr", 1) in sizes
    grams, _ = q.gram_keys([b"the of was"])
    every = np.arange(1 << 16, dtype=np.uint64)
    for g in grams[::3]:
        assert abs(np.exp(small.log_probability("en", (g & ~np.uint64(0xFFFF)) | every)).sum() - 1) < 1e-4


@pytest.mark.parametrize("entries", [50, 2])
def test_entries_that_are_not_broadcast_count_the_same(spark, monkeypatch, entries):
    """Whatever is broadcast, each probability, figure and verdict is the whole
    model's: copies, unseen units, untaught texts and ids that repeat included."""
    r = random.Random(5)
    words = "un deux trois quatre cinq six sept huit neuf dix onze".split()
    extra = [(300 + i, " ".join(r.choices(words, k=40)), r.choice(["fr", None]), True) for i in range(20)]
    extra += [(400, "never seen 日本 # " * 8, "fr", True), (401, None, "en", True), (401, "", "xx", True)] + extra[:3] * 2
    df = english(spark, extra)
    texts = df.selectExpr("cast(text as binary) text", "lang")
    of = lambda: sorted(map(str, [tuple(round(x, 5) if isinstance(x, float) else x for x in row) for row in q.quality(df).collect()]))
    everything, known = q.fit(texts), of()
    monkeypatch.setattr(q, "ENTRIES", entries)
    small = q.fit(texts)
    assert not everything.more and ("en", 4) in small.more and all(len(v[0]) <= entries for v in small.of.values())
    for lang in ("en", "fr", "xx"):
        grams, _ = q.gram_keys(["the of un deux never 日本 #".encode(), b""])
        assert np.allclose(small.log_probability(lang, grams), everything.log_probability(lang, grams), atol=1e-9)
    assert of() == known and len(known) == 60 + len(extra)


def test_junk_goes_and_good_texts_stay_in_every_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = q.judge(docs, keep=["doc_id", "lang"]).join(labels, "doc_id").where("not __q.base_failed")
    good, bad = {}, {}
    for lang, quality, kept, n in judged.selectExpr("lang", "quality", "cast(__q.kept as int) as kept").groupBy(
            "lang", "quality").agg({"kept": "sum", "*": "count"}).select("lang", "quality", "sum(kept)", "count(1)").collect():
        (good if quality == 1 else bad)[lang] = (kept, n)
    assert all(k >= 0.9 * n for k, n in good.values()) and len(good) == 4  # a few dozen texts a language
    assert sum(k for k, _ in good.values()) >= 0.97 * sum(n for _, n in good.values())
    assert sum(k for k, _ in bad.values()) <= 0.2 * sum(n for _, n in bad.values())

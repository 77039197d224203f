import random
import zlib

import numpy as np

from cardgeo.llm import toxicity as tox


def corpus(n=600, seed=0):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "ba be bi bo bu da de di do du".split() for b in "ra re ri ro ru la le li lo lu".split()]
    rows = []
    for i in range(n):
        bad = i % 6 == 0
        text = r.choices(words, k=r.randint(10, 120))
        if bad:
            for _ in range(r.randint(2, 6)):
                text.insert(r.randrange(len(text)), r.choice(["Fiend!", "rotter", "CAD"]))
        rows.append((i, " ".join(text), int(bad)))
    return rows


def frames(spark, rows, labelled=0.7):
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t, _ in rows], "doc_id long, text string, score double, toxic int")
    marks = [(i, 1, y) for i, _, y in rows if i is not None and i % 10 < 10 * labelled]
    return docs, spark.createDataFrame(marks + [(7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows = corpus()
    extra = [(9001, None, 0), (9002, "", 0), (None, "you fiend rotter", 1), (12, rows[12][1], 1)]
    docs, labels = frames(spark, rows + extra)
    out = tox.toxicity(docs, labels).collect()
    assert len(out) == len(rows) + 4
    truth = {i: y for i, _, y in rows}
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert [r.predicted for r in out if r.doc_id in (9001, 9002)] == [0, 0]
    assert [r.predicted for r in out if r.doc_id is None] == [1]


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    rows = corpus(200)
    docs, labels = frames(spark, rows, 1.0)
    held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    flipped = labels.selectExpr("doc_id", "quality", f"if({held}, 1 - toxic, toxic) as toxic")
    a, b = (tox.train(docs, x) for x in (labels, flipped))
    assert a.weights == b.weights and a.offset == b.offset and a.weights


def test_without_examples(spark):
    docs, labels = frames(spark, corpus(30))
    none = tox.toxicity(docs, labels.where("toxic = 0")).collect()
    assert all(r.score < 1e-6 and r.predicted == 0 for r in none)
    assert tox.toxicity(docs.limit(0), labels).collect() == []
    assert all(r.predicted == 0 for r in tox.toxicity(docs, labels.limit(0)).collect())


def test_risk_estimate_recovers_a_boundary():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    truth = x[:, 0] > 1.0
    w, b = tox.fit_pu(x, truth.astype(float), np.ones(len(x)), float(truth.mean()))
    assert ((x @ w + b > 0) == truth).mean() > 0.95

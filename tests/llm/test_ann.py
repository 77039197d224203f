import itertools

import numpy as np

from cardgeo.llm import ann


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))  # a bijection
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()  # steps of one cell


def brute(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[q]][:k]
    return [(int(ids[j]), float(d[j])) for j in order]


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score int")
    out = {}
    for r in ann.nearest(df, lambda v: v % 100 == 0, **kw).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.float32(rng.normal(size=(900, 24)) + 2 * rng.normal(size=(6, 24))[rng.integers(0, 6, 900)])
    x[500:560] = x[0]  # one very common vector
    ids = np.arange(900) * 3
    bad = [(100000, None), (100100, [0.0] * 24), (100200, [float("nan")] * 24), (100300, [1.0, None] * 12),
           (100400, [1.0, 2.0]), (None, x[1].tolist()), (100500, [float("inf")] + [1.0] * 23)]
    rows = [(int(i), v.tolist(), "r", 1) for i, v in zip(ids, x)] + [(i, v, "r", 1) for i, v in bad]
    rows += rows[:3]  # repeated rows count once
    got = run(spark, rows)
    queries = [q for q in range(900) if ids[q] % 100 == 0]
    assert sorted(got) == [ids[q] for q in queries]
    for q in queries:
        want = brute(ids, x.astype(float), q)
        assert [v for v, _ in got[ids[q]]] == [v for v, _ in want]
        assert np.allclose([s for _, s in got[ids[q]]], [s for _, s in want], rtol=0, atol=1e-12)


def test_recall_with_narrow_windows(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAST_WINDOW", 16)
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 2)  # several salted copies
    rng = np.random.default_rng(4)
    x = np.float32(rng.normal(size=(3000, 32)))
    ids = np.arange(3000)
    got = run(spark, [(int(i), v.tolist(), "r", 1) for i, v in zip(ids, x)])
    hits = [len({v for v, _ in got[q]} & {v for v, _ in brute(ids, x.astype(float), q)}) for q in range(0, 3000, 100)]
    assert sum(hits) >= 0.8 * 10 * len(hits)  # structureless, the hardest case


def test_few_rows(spark):
    assert run(spark, []) == {}
    one = [(0, [1.0, 0.0], "r", 1)]
    assert run(spark, one) == {}
    assert run(spark, one + [(7, [1.0, 0.0], "r", 1)]) == {0: [(7, 0.0)]}
    assert run(spark, one + [(7, [1.0, 3.0], "r", 1), (9, [1.0, 0.0], "r", 1)]) == {0: [(9, 0.0), (7, 3.0)]}

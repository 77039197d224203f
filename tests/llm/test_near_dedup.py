import random

import numpy as np

from cardgeo.llm import near_dedup as nd
from cardgeo.llm.components import connected_components

SCHEMA = "doc_id long, text string, n_shingles string, component_id long"


def shingles(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = low.encode().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """(doc_id -> (set size, smallest reachable id)) by all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 6)))
    passage = [word() for _ in range(40)]
    rows = []
    for group in range(12):
        base = [word() for _ in range(r.choice([6, 30, 120]))] + passage * (group % 3 == 0)
        for _ in range(r.choice([1, 2, 5])):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 4, 8])):
                w[r.randrange(len(w))] = word()
            rows.append((r.randint(0, 10 ** 9), " ".join(w)))
    rows += [(1, "Too few words"), (2, "too  FEW\nwords"), (3, ""), (4, None), (5, " \t\n"), (6, "Ünder ünder"),
             (7, "ünder ünder")]
    return rows


def test_matches_all_pairs(spark):
    rows = corpus()
    rows += [rows[0], (8, rows[0][1])]  # a repeated row, an exact copy
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows] + [(None, "no id at all here", "x", 0)], SCHEMA)
    out = nd.near_duplicates(df).collect()
    want = brute(rows)
    assert len(out) == len(rows) + 1
    for r in out:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert want[2][1] == 1 and want[7][1] == 7  # A-Z only: other letters keep their case


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nd.near_duplicates(df).collect() == []


def test_components_by_union_find(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randint(100, 160), r.randint(100, 160)) for _ in range(40)]
    edges += [(500, k) for k in range(501, 540)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for u, v in edges if u != v for x in (u, v)}


def test_large_regions_go_deeper(monkeypatch):
    monkeypatch.setattr(nd, "REGION", 4)
    lcp = np.array([1, 3, 3, 1, 2, 2, 0, 8, 8, 8, 8, 8, 8])
    got = sorted(nd._regions(lcp, len(lcp) + 1))
    assert all(b - a <= 4 for a, b in got)
    reached = {(i, i + 1) for a, b in got for i in range(a, b - 1)}
    assert reached == {(i, i + 1) for i in range(len(lcp)) if lcp[i] > 0}  # every neighbour pair stays


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 64, 400, dtype=np.uint64)
    near = np.concatenate([x[:343], rng.integers(0, 2 ** 64, 57, dtype=np.uint64)])  # 343 / 457 = 0.75
    same = (nd.signature(x) == nd.signature(near)).sum()
    assert nd.PLAUSIBLE < same < 90 and (nd.signature(x) == nd.signature(x)).all()

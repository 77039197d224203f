import hashlib
import zlib

import duckdb
import pytest

from cardgeo.llm import merkle as m

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, idx int, tree string, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """Levels of one tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute(rows):
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))):
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {x: climb([leaf(*r) for r in trees[x]]) for x in langs}
    top = climb([levels[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for i, r in enumerate(trees[x]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            longer = None if r[4] is None else min(r[4] + 1, 2 ** 63 - 1)
            node, siblings = leaf(*r[:4], longer) if tampered else leaf(*r), []
            for level, at in [(v, i >> k) for k, v in enumerate(levels[x][:-1])] + [(v, place >> k) for k, v in enumerate(top[:-1])]:
                other = level[at ^ 1] if at ^ 1 < len(level) else ""
                siblings.append(other)
                node = h(other, node) if at % 2 else h(node, other)
            out.append((r[0], leaf(*r), levels[x][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0]))
    return out


def documents(n, langs=("en", "de", "é", "", None, "fr")):
    rows = [(i * 3 % 1009, f"text {i} ü", langs[i * i % 7 % len(langs)], f"src{i % 3}", i) for i in range(n)]
    return rows + [(None, None, None, None, None), (None, "x", "en", "s", 1), (7, None, "only", "s", None),
                   (14, "long " * 50000, "en", "", 2 ** 63 - 1), (3, "same", "de", "s", 4), (3, "same", "de", "s", 4)]


@pytest.mark.parametrize("n, stride", [(0, 8), (1, 8), (300, 8), (300, 2), (40, 1)])
def test_against_whole_trees(spark, n, stride):
    rows = documents(n)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS).repartition(3)
    got = [tuple(r) for r in m.verified(df, stride).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))
    assert sum(not r[6] for r in got) > 0 or n < 20


def test_one_leaf_and_none(spark):
    df = spark.createDataFrame([(5, "a", "en", "s", 1, 1, "x", "y")], COLUMNS)
    one = m.verified(df).first()
    assert one.root == one.subroot == one.leaf == leaf(5, "a", "en", "s", 1) and one.proof_sha256 == h()
    assert m.verified(df.limit(0)).collect() == []


def test_only_every_stride_is_written(spark):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in documents(300, ("en",))], COLUMNS)
    by_lang, _ = m.manifest(df, 3)
    sizes = [{r.tree: r.n for r in level.select("tree", "n").distinct().collect()} for level in by_lang.levels]
    assert [s["ven"] for s in sizes] == [302, 38, 5, 1] and all(level.count() == sum(s.values()) for level, s in zip(by_lang.levels, sizes))


def test_duckdb_agrees(spark):
    rows = [r for r in documents(200) if r[4] != 2 ** 63 - 1]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], COLUMNS)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(m.oracle_sql())
    got = {str(tuple(r)) for r in m.verified(df, 3).collect()}
    names = [c[0] for c in want.description]
    assert names == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert {str(r) for r in want.fetchall()} == got

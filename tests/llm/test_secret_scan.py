import hashlib
import re

import duckdb
import pytest

from cardgeo.llm import secret_scan as s

KEY = "AKIA" + "ABCDEFGH12345678"
HEX = "0123456789abcdef" * 2
TEXTS = {
    1: f'token = "{HEX}"', 2: f"key {KEY} é and password: hunter22", 3: "token=abc secret: token: abcdef",
    4: "", 5: None, 6: "login: anna", 7: "login: anna, pwd = correcthorse", 8: "see https://example.com/x",
    9: f"日本🙂 https://db.example.com/x\nAPI_KEY='{HEX}' user=bob" + " filler" * 60 + " login: far",
    10: "pwd = correcthorse", 11: f"{s.MARK}token{s.MARK} secret=abcdef1{s.MARK}", 12: "a" * 5000,
    13: f"Bearer abcdefghijklmnop0 host: db1.local {HEX[:24]}", 14: f"{HEX}," * 300,
}
ASSIGN = re.compile(r'''(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', re.I | re.A)


def brute(text):
    """All spans (start, kind, end): base ones, and weak ones with a
    complementary part in scope, by all pairs."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    weak = [(m.start(), k, m.end()) for k, name in enumerate(s.KINDS) if k > 2
            for m in re.finditer(s.PATTERNS[name], text, re.A)]
    role = lambda x: s.ROLES[s.KINDS[x[1]]]
    every = found + weak
    near = lambda a, b: (b[0] <= a[2] + s.SCOPE and b[2] >= a[0] - s.SCOPE and role(a) != role(b)
                         and "secret" in (role(a), role(b)))
    return sorted(found), sorted(found + [a for a in weak if any(near(a, b) for b in every)])


def name(spans):
    return ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in TEXTS.items()] + [(None, TEXTS[7], "x"), (1, TEXTS[1], "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(4)


def test_spans(docs):
    rows = s.secrets(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        base, every = brute(TEXTS[r.doc_id or 7])
        assert r.spans == name(every) and r.base_sha256 == hashlib.sha256(name(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
    of = {r.doc_id: r.spans for r in rows}
    assert of[6] == of[8] == of[10] == ""  # weak parts alone
    assert of[7] == "ident:0:11,pass:13:31" and "endpoint:" in of[9] and ":far" not in of[9]


def test_duckdb_agrees(spark, docs):
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    con = duckdb.connect()
    con.register("documents", one.toPandas())
    want = con.execute(s.oracle_sql()).df().set_index("doc_id").sort_index()
    got = s.secrets(one).toPandas().set_index("doc_id").sort_index()
    assert (got[want.columns] == want).all().all() and len(got) == len(TEXTS)


def test_masking(spark, docs):
    out = s.masked(docs.withColumn("n_chars", s.F.lit(-1)))
    assert out.columns == ["doc_id", "text", "spans", "n_chars"]
    got = out.collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text, spans = TEXTS[r.doc_id or 7], brute(TEXTS[r.doc_id or 7])[1]
        want, at = "", 0
        for a, _, b in spans:
            if a >= at:
                want += text[at:a] + "[SECRET]"
            at = max(at, b)
        want = want + text[at:] if spans else text
        assert r.text == want and r.n_chars == (len(want) if spans else -1)


def test_empty_table(docs):
    assert s.secrets(docs.limit(0)).collect() == [] and s.masked(docs.limit(0)).collect() == []

import hashlib
import math
import re
import time

import duckdb
import pytest

from cardgeo.llm import pii as p

#: Base patterns as given, with their conditions.
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(digits(v)) <= 15),
}
FILLER = "the and of to it is on by as at we he she they said made went came saw new old red big low".split()
TEXTS = {
    1: "Call Zorblax now at +1 (017) 555-7713 or zorblax@mail.example.com today.",
    2: "Again Zorblax (mail: zorblax@MAIL.example.com) said hello, zorblax!", 3: "Zorblax@mail.example.com Zorblax the end",
    4: "", 5: None, 6: "no entity but Zorblax here", 7: "a.b@c.d_e@f.g x@@y.z@q.r.s x@y a@b..c %+-@a-b.c",
    8: "1.2.3.4.5 256.1.1.1 0255.01.001.0 1.2.3.4.5.6.7.8 999999999999999999999.1.1.1", 9: "4111 1111 1111 1111 and 4111-1111-1111-1112",
    10: "4111111111111111, 41111111111111114111111111111111, 378282246310005 1 2", 11: f"{p.MARK}q@r.st{p.MARK} é日本🙂 a@b.co 🙂",
    12: "+1234567890 +12 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 ++44 20 7946 0958. +1.2.3.4", 13: "x" * 300 + " y@z.com " + "w" * 300,
    14: "tab\tZorblax x zorblax@mail.example.com\nl'été Zorblax's zor-blax Zorblax2 (Zorblax).", 15: "10.0.0.1 " * 40,
    16: "Quxley the of quxley@h.org", 17: "to Quxley and quxley@h.org of", 18: "Quxley", 19: "Quxley red", 20: "quxley",
    21: "user@host.com 10.0.0.1 4111111111111111", 22: "new Quxley",
}
TEXTS |= {100 + i: " ".join(FILLER[(i * j) % len(FILLER)] for j in range(1, 30)) for i in range(60)}


def digits(v):
    return re.sub("[^0-9]", "", v)


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def low(s):
    return "".join(c.lower() if c.isascii() else c for c in s)


def words(text):
    """Words by tokens: (word, start, end)."""
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        letters = [i for i, c in enumerate(m[0]) if c.isalpha()]
        if letters and not any(c == "@" or c.isnumeric() for c in m[0]) and letters[-1] - letters[0] + 1 == len(letters):
            yield low(m[0][letters[0]:letters[-1] + 1]), m.start() + letters[0], m.start() + letters[-1] + 1, m.start(), m.end()


def brute(texts):
    """Spans (start, kind, end) of every text, by whole-text rules."""
    texts = [(t or "").replace(p.MARK, p.OTHER) for t in texts]
    base, near, entity, has = [], [], {}, {}
    for row, t in enumerate(texts):
        found, beside = [], []
        for k, (pattern, ok) in enumerate(BASE.values()):
            cuts = [m.span() for m in re.finditer(pattern, t)]
            edges = [-1] + [x for c in cuts for x in c] + [len(t) + 1]  # text ends count as white space
            for i, (a, b) in enumerate(cuts):
                if not ok(t[a:b]):
                    continue
                found.append((a, k, b))
                e = (k, low(t[a:b]) if k == 0 else t[a:b] if k == 1 else digits(t[a:b]))
                entity.setdefault(e, set()).add(row)
                left, right = max(edges[2 * i], a - p.SCOPE), min(edges[2 * i + 3], b + p.SCOPE)
                for w, s, end, ts, te in words(t):  # its token and white space around it lie in scope
                    if left < ts and te < a or b < ts and te < right:
                        beside.append((e, w, s, end))
                        has.setdefault((e, w), set()).add((row, t))
        base.append(found)
        near.append(beside)
    holds = {}
    for t in texts:
        for w in {x[0] for x in words(t)}:
            holds[w] = holds.get(w, 0) + 1
    n = len(texts)
    shown = {k for k, v in has.items() if len({t for _, t in v}) > 1 and
             holds[k[1]] ** 4 * len(entity[k[0]]) <= n * len(v) ** 4}
    return [(sorted(f), sorted(f + list({(s, p.TERM, end) for e, w, s, end in b if (e, w) in shown})))
            for f, b in zip(base, near)], shown


def name(spans):
    return ",".join(f"{p.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in TEXTS.items()] + [(None, TEXTS[1], "x", 1), (1, TEXTS[1], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int").repartition(4)


def test_spans(docs):
    want, shown = brute([*TEXTS.values(), TEXTS[1], TEXTS[1]])
    want = dict(zip(TEXTS, want))
    assert ((0, "zorblax@mail.example.com"), "zorblax") in shown and all(w not in FILLER for _, w in shown)
    rows = p.personal_data(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        base, every = want[r.doc_id or 1]
        assert r.spans == name(every), r
        assert r.base_sha256 == hashlib.sha256(name(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for _, k, _ in base) for j in range(4))
    of = {r.doc_id: r.spans for r in rows}
    assert of[6] == of[18] == "" and "term" in of[2]  # documents without an entity stay clean
    assert "term" not in of[16]  # met elsewhere too often


def test_duckdb_agrees(docs):
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    con = duckdb.connect()
    con.register("documents", one.toArrow())
    want = con.execute(p.oracle_sql())
    names = [c[0] for c in want.description]
    assert sorted(want.fetchall()) == sorted(tuple(r) for r in p.personal_data(one).select(*names).collect())


def test_disclosures(docs):
    read = p.read(docs)
    found = p.mentions(read)
    rows = p.disclosures(p.document_counts(docs), read, found, p.contexts(found)).collect()
    got = {(r.kind, r.entity, r.term): r for r in rows}
    z = got[0, "zorblax@mail.example.com", "zorblax"]  # in seven documents, in six beside the address
    n = len(TEXTS) + 2
    assert (z.n_term, z.n_entity, z.n_both, z.action) == (7, 6, 6, "generalise")
    assert z.disclosed == pytest.approx(1 - math.log(7 / 6) / math.log(n / 6)) and z.disclosed > p.GENERALISED
    assert all(r.action == "remove" if r.n_term == r.n_both else p.GENERALISED <= r.disclosed < 1 for r in rows)


def test_sanitised(spark, docs):
    out = p.sanitised(docs)
    assert out.columns == docs.columns
    of = {r.doc_id: r for r in out.where("doc_id is not null").collect()}
    assert of[1].text == "Call [NAME] now at [PHONE] or [EMAIL] today." and of[1].spans == "x"
    assert of[2].text == "Again [NAME] (mail: [EMAIL]) said hello, [WORD]!" and of[6].text == TEXTS[6]
    assert of[4].text == "" and of[5].text is None and of[9].text == "[CARD] and 4111-1111-1111-1112"
    assert of[15].text == "[IP] " * 40


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 400_000, "1" * 400_000, "x@" + "a." * 200_000, "1.2.3." * 70_000, "+1" + "(" * 400_000, "+1 " * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    at = time.time()
    assert len(p.personal_data(df).collect()) == 6 and time.time() - at < 120


def test_empty_table(docs):
    assert p.personal_data(docs.limit(0)).collect() == [] and p.sanitised(docs.limit(0)).collect() == []

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages_by_brute_force(spark):
    """Each stage on what the one before kept, against plain Python."""
    import corpus_pipeline as p
    from pyspark.sql import functions as F

    from cardgeo.llm import quality, toxicity
    from cardgeo.llm.common import materialize, table
    from test_near_dedup import brute as classes
    from test_packing import check
    from test_secret_scan import brute as spans
    from tokenizers import Tokenizer
    import public_tokenizers

    docs = table(spark, SF, "documents")
    seen = [docs]
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, seen[-1], SF)
        assert out.schema.names == docs.schema.names, name
        seen.append(materialize(out, "test-pipeline"))
    rows = [{r.doc_id: r for r in df.collect()} for df in seen]

    model = toxicity.train(docs, table(spark, SF, "labels"))
    assert set(rows[1]) == {i for i, r in rows[0].items() if model.score(r.text) < 0.5} and len(rows[1]) < len(rows[0])

    verdict = {r.doc_id: r["__q"].kept for r in quality.judge(seen[1], keep=["doc_id"]).collect()}
    assert set(rows[2]) == {i for i, kept in verdict.items() if kept} and len(rows[2]) < len(rows[1])
    assert all(r.text == rows[0][i].text for i, r in rows[2].items())

    assert set(rows[3]) == {i for i, (_, c) in classes([(i, r.text) for i, r in rows[2].items()]).items() if c == i}

    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        text, want, at = rows[3][i].text, "", 0
        found = spans(text)[1]
        for a, _, b in found:
            if a >= at:
                want += text[at:a] + "[SECRET]"
            at = max(at, b)
        want += text[at:]
        assert r.text == want and r.n_chars == (len(want) if found else rows[3][i].n_chars)

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]
    packed = p.STAGES[-1][1](spark, seen[-1], SF).collect()
    check(packed, [(i, r.text) for i, r in rows[4].items()], ids, 1024)
    assert seen[0].where(F.col("doc_id").isNull()).count() == 0


def test_repeated_and_empty(spark):
    import corpus_pipeline as p
    from cardgeo.llm.common import table
    docs = table(spark, SF, "documents")
    text = "some words that make up a text of " + " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (2, text, "en", "s", 5), (None, text, "en", "s", 5),
            (3, None, None, None, None)]
    df = spark.createDataFrame(rows, docs.schema)
    kept = p.drop_near_copies(spark, df, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None"]
    for _, stage in p.STAGES:
        assert stage(spark, df.limit(0), SF).collect() == []


@pytest.mark.parametrize("entries", [50, 2])
def test_quality_stage_is_the_same_whatever_is_broadcast(spark, monkeypatch, entries):
    """Entries of the language model beyond the broadcast ones count in the
    pipeline's stage as if all were broadcast: same rows stay."""
    import random

    import corpus_pipeline as p
    from cardgeo.llm import quality
    r = random.Random(11)
    words = "un deux trois quatre cinq six sept huit neuf dix onze douze".split()
    odd = "zqx wvk jjx qqz kkw xzj vvq".split()
    rows = [(i, " ".join(r.choices(words, k=40)), "fr" if i % 3 else None) for i in range(60)]
    rows += [(100 + i, " ".join(r.choices(words, k=40 - 5 * i) + r.choices(odd, k=5 * i)), "fr") for i in range(9)]
    rows += [(150 + i, " ".join("".join(r.choices("qzxjkw#%&", k=6)) for _ in range(30)), "fr") for i in range(5)]
    rows += [(200, None, "fr"), (None, rows[0][1], "fr"), (0, rows[0][1], "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = lambda: sorted(str(x.doc_id) for x in p.drop_low_quality(spark, docs, "").collect())
    everything = ids()
    assert 30 < len(everything) < len(rows) - 1  # some texts go, and not only for their length
    monkeypatch.setattr(quality, "ENTRIES", entries)
    assert ids() == everything

"""Coverage cut, top-1 and the whole chain against brute force."""

import random
from collections import Counter
from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from cardgeo import Params, infer
from cardgeo.operators import dq_coverage_reached, select_top_countries, top1_country
from cardgeo.schemas import COUNTRY_COUNTS_SCHEMA, TXN_SCHEMA

COUNTRIES = list("ABCDEFGH")
COVERAGES = [Decimal(x) for x in ("0.5", "0.8", "0.9", "0.95", "0.99", "1")]

bins = st.dictionaries(
    keys=st.sampled_from([f"B{i}" for i in range(8)]),
    values=st.dictionaries(st.sampled_from(COUNTRIES), st.integers(1, 60), min_size=1),
    min_size=1, max_size=6)


def ranked(countries):
    return sorted(countries.items(), key=lambda kv: (-kv[1], kv[0]))


def brute_top(data, coverage):
    cov = Fraction(str(coverage))
    out = set()
    for b, countries in data.items():
        total, prior = sum(countries.values()), 0
        for c, n in ranked(countries):
            if Fraction(prior) < cov * total:
                out.add((b, c))
            prior += n
    return out


@settings(max_examples=25, deadline=None)
@given(data=bins, coverage=st.sampled_from(COVERAGES))
def test_coverage_cut_matches_brute_force(spark, data, coverage):
    rows = [(b, c, n, sum(cs.values())) for b, cs in data.items() for c, n in cs.items()]
    df = spark.createDataFrame(rows, COUNTRY_COUNTS_SCHEMA)
    top = select_top_countries(df, coverage)
    assert {(r.BIN, r.country) for r in top.collect()} == brute_top(data, coverage)
    # Invariants: target reached and minimal.
    assert dq_coverage_reached(top, coverage).count() == 0
    top1 = {(r.BIN, r.inferred_top_country) for r in top1_country(top).collect()}
    assert top1 == {(b, ranked(cs)[0][0]) for b, cs in data.items()}


def test_skewed_pipeline_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        # One hot BIN carries over a third of all rows.
        b = "400001" if i % 3 == 0 else f"40{rnd.randint(10, 40):04d}"
        c = rnd.choice(["US", "US", "US", "CA", "MX", "GB"]) if b == "400001" else rnd.choice(
            ["FR", "DE", "FR"])
        fraud = rnd.random() < 0.1
        rows.append((f"t{i}", None, b, c, fraud))
    tx = spark.createDataFrame(rows, TXN_SCHEMA)
    vendor = spark.createDataFrame([("400001", "CA")], "BIN string, country string")
    params = Params(Decimal("0.9"), 40)
    got = {r.BIN: (r.inferred_top_country, r.vendor_country, r.is_discrepant, r.bin_total)
           for r in infer(tx, vendor, None, params).flags.collect()}

    counts = Counter((b, c) for _, _, b, c, f in rows if not f)
    per_bin = {}
    for (b, c), n in counts.items():
        per_bin.setdefault(b, {})[c] = n
    want = {}
    for b, cs in per_bin.items():
        total = sum(cs.values())
        if total >= params.min_txns:
            top = ranked(cs)[0][0]
            v = "CA" if b == "400001" else None
            want[b] = (top, v, v is not None and v != top, total)
    assert got == want
    assert got["400001"][0] == "US" and got["400001"][2] is True


raw_rows = st.lists(
    st.tuples(st.sampled_from(["12345", "123456", "1234567", "123456789", "654321"]),
              st.sampled_from(["US", "CA", "MX", None]),
              st.sampled_from([True, False, False, False, None])),
    min_size=0, max_size=80)


@settings(max_examples=15, deadline=None)
@given(data=raw_rows, min_txns=st.integers(0, 6), coverage=st.sampled_from(COVERAGES))
def test_raw_pipeline_matches_brute_force(spark, data, min_txns, coverage):
    from cardgeo.operators import reject_reasons
    from pyspark.sql.types import StructField, StructType
    schema = StructType([StructField(f.name, f.dataType, True) for f in TXN_SCHEMA.fields])
    tx = spark.createDataFrame([(f"t{i}", None, b, c, f) for i, (b, c, f) in enumerate(data)],
                               schema)
    vendor = spark.createDataFrame([("123456", "US"), ("654321", "CA")],
                                   "BIN string, country string")
    params = Params(coverage, min_txns)

    def reason(b, c, f):
        if f is None:
            return "null_label"
        if f:
            return "fraud"
        if c is None:
            return "null_country"
        if not 6 <= len(b) <= 8:
            return "bad_bin_length"
        return "kept"

    assert {(r.reason, r.n_rows) for r in reject_reasons(tx).collect()} == set(
        Counter(reason(*r) for r in data).items())

    kept = Counter((b, c) for b, c, f in data if reason(b, c, f) == "kept")
    per_bin = {}
    for (b, c), n in kept.items():
        per_bin.setdefault(b, {})[c] = n
    vend = {"123456": "US", "654321": "CA"}
    want = {(b, ranked(cs)[0][0], vend.get(b), vend.get(b) not in (None, ranked(cs)[0][0]),
             sum(cs.values()))
            for b, cs in per_bin.items() if sum(cs.values()) >= min_txns}
    got = {tuple(r) for r in infer(tx, vendor, None, params).flags.collect()}
    assert got == want
    top = {(r.BIN, r.country) for r in infer(tx, vendor, None, params).top_countries.collect()}
    assert top == brute_top({b: cs for b, cs in per_bin.items()
                             if sum(cs.values()) >= min_txns}, coverage)

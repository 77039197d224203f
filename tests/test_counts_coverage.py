from decimal import Decimal

import pytest

from cardgeo.operators import (
    country_counts,
    cumulative_share,
    distinct_support,
    filter_supported_bins,
    select_top_countries,
    support_flag,
)
from cardgeo.schemas import COUNTRY_COUNTS_SCHEMA, TOP_COUNTRIES_SCHEMA, TXN_SCHEMA, same_shape
from conftest import rows


def clean(spark, pairs):
    return spark.createDataFrame(
        [(f"t{i}", None, b, c, False) for i, (b, c) in enumerate(pairs)], TXN_SCHEMA)


def counts_df(spark, data):
    return spark.createDataFrame(data, COUNTRY_COUNTS_SCHEMA)


def bin_counts(spark, counts, total=None):
    total = total if total is not None else sum(n for _, n in counts)
    return counts_df(spark, [("B1", c, n, total) for c, n in counts])


def test_country_counts(spark):
    df = clean(spark, [("401", "IE"), ("402", "NO"), ("401", "IE"), ("401", "IS"), ("402", "NO"),
                       ("401", "IE"), ("402", "NO"), ("403", "IS")])
    out = country_counts(df)
    assert rows(out) == [("401", "IE", 3, 4), ("401", "IS", 1, 4), ("402", "NO", 3, 3), ("403", "IS", 1, 1)]
    assert same_shape(out.schema, COUNTRY_COUNTS_SCHEMA)


def test_country_counts_empty(spark):
    out = country_counts(spark.createDataFrame([], TXN_SCHEMA))
    assert out.count() == 0 and same_shape(out.schema, COUNTRY_COUNTS_SCHEMA)


def kept(spark, counts, coverage=Decimal("0.95")):
    out = select_top_countries(bin_counts(spark, counts), coverage)
    return [r.country for r in out.orderBy("cumulative_pct").collect()]


def test_coverage_tie_goes_country_ascending(spark):
    # After 180 of 200, two tied tens: the one that sorts first reaches 190.
    assert kept(spark, [("SE", 110), ("NO", 70), ("IS", 10), ("DK", 10)]) == ["SE", "NO", "DK"]


def test_coverage_tie_order_and_values(spark):
    out = select_top_countries(bin_counts(spark, [("IS", 4), ("NO", 8), ("DK", 4)]))
    got = [(r.country, r.country_pct, r.cumulative_pct)
           for r in out.orderBy("cumulative_pct").collect()]
    assert got == [("NO", 0.5, 0.5), ("DK", 0.25, 0.75), ("IS", 0.25, 1.0)]
    assert same_shape(out.schema, TOP_COUNTRIES_SCHEMA)


def test_single_country_suffices(spark):
    assert kept(spark, [("SE", 39), ("NO", 1)]) == ["SE"]


def test_target_never_reached_keeps_all(spark):
    assert kept(spark, [("SE", 4), ("NO", 3), ("DK", 2)], Decimal("1")) == ["SE", "NO", "DK"]
    assert kept(spark, [("SE", 4), ("NO", 3), ("DK", 2)], Decimal("0.99")) == ["SE", "NO", "DK"]


def test_exact_boundary_stops(spark):
    assert kept(spark, [("SE", 26), ("NO", 12), ("DK", 2)]) == ["SE", "NO"]


def test_exact_boundary_not_fooled_by_doubles(spark):
    # 0.57 + 0.29 + 0.09 sums to 0.9499999999999998 in doubles; exact
    # arithmetic stops at C.
    assert kept(spark, [("A", 57), ("B", 29), ("C", 9), ("D", 5)]) == ["A", "B", "C"]


def test_cumulative_share_keeps_every_row(spark):
    out = cumulative_share(bin_counts(spark, [("A", 57), ("B", 29), ("C", 9), ("D", 5)]))
    assert out.count() == 4


@pytest.mark.parametrize("total,expected", [(99, 0), (100, 1), (101, 1)])
def test_support_threshold(spark, total, expected):
    df = counts_df(spark, [("B1", "US", total, total)])
    assert filter_supported_bins(df, 100).count() == expected
    assert support_flag(df, 100).first().is_supported == bool(expected)


def test_support_keeps_or_drops_whole_bin(spark):
    df = counts_df(spark, [("B1", "US", 60, 120), ("B1", "CA", 60, 120),
                           ("B2", "US", 50, 99), ("B2", "CA", 49, 99)])
    assert rows(filter_supported_bins(df, 100), "BIN", "country") == [("B1", "CA"), ("B1", "US")]


def test_distinct_support_counts_ids(spark):
    df = spark.createDataFrame(
        [("t1", None, "B1", "US", False), ("t1", None, "B1", "US", False),
         ("t2", None, "B1", "CA", False)], TXN_SCHEMA)
    r = distinct_support(df, 2).first()
    assert (r.bin_total, r.distinct_txns, r.is_supported_distinct) == (3, 2, True)


def test_distinct_support_sketch_option(spark):
    df = spark.createDataFrame(
        [(f"t{i % 500}", None, "B1", "US", False) for i in range(2000)], TXN_SCHEMA)
    exact = distinct_support(df, 100).first()
    approx = distinct_support(df, 100, rsd=0.02).first()
    assert exact.distinct_txns == 500
    assert abs(approx.distinct_txns - 500) <= 25 and approx.bin_total == 2000

import pytest

from cardgeo.operators import (
    discrepancy_severity,
    flag_discrepancies,
    vendor_conflicts,
    vendor_dedup,
)
from cardgeo.schemas import COUNTRY_COUNTS_SCHEMA, FLAGS_SCHEMA, VENDOR_SCHEMA, same_shape
from conftest import rows


def inferred(spark, data):
    return spark.createDataFrame(data, COUNTRY_COUNTS_SCHEMA)


def vendor(spark, data):
    return spark.createDataFrame(data, VENDOR_SCHEMA)


def flags(spark, inf, ven):
    return rows(flag_discrepancies(inferred(spark, inf), vendor(spark, ven)))


@pytest.mark.parametrize("vendor_country,discrepant", [
    ("PT", True),      # another country
    ("ES", False),     # the same one
    ("es", True),      # compared as stored
    (None, False),     # the vendor names none
])
def test_single_bin(spark, vendor_country, discrepant):
    assert flags(spark, [("4017321", "ES", 7, 7)], [("4017321", vendor_country)]) == [
        ("4017321", "ES", vendor_country, discrepant, 7)]


def test_leading_country_is_compared(spark):
    counts = [("4017321", "ES", 21, 48), ("4017321", "AD", 2, 48), ("4017321", "PT", 25, 48)]
    assert flags(spark, counts, [("4017321", "ES")]) == [("4017321", "PT", "ES", True, 48)]


def test_top1_tie_country_ascending(spark):
    counts = [("4017321", "PT", 4, 11), ("4017321", "FR", 3, 11), ("4017321", "ES", 4, 11)]
    assert flags(spark, counts, [("4017321", "PT")]) == [("4017321", "ES", "PT", True, 11)]


def test_bins_of_one_side_only(spark):
    counts = [("4017321", "ES", 7, 7), ("4017322", "PT", 3, 3), ("4017323", "FR", 2, 2)]
    known = [("4017322", "AD"), ("4017323", "FR"), ("4017999", "GR")]
    assert flags(spark, counts, known) == [
        ("4017321", "ES", None, False, 7), ("4017322", "PT", "AD", True, 3), ("4017323", "FR", "FR", False, 2)]


def test_empty_inferred(spark):
    out = flag_discrepancies(inferred(spark, []), vendor(spark, [("B1", "US")]))
    assert out.count() == 0 and same_shape(out.schema, FLAGS_SCHEMA)


def test_missing_columns_raise(spark):
    bad = spark.createDataFrame([("B1", "US")], "BIN string, nation string")
    with pytest.raises(ValueError, match="country"):
        flag_discrepancies(bad, vendor(spark, []))
    with pytest.raises(ValueError, match="country"):
        flag_discrepancies(inferred(spark, []), bad)


def test_vendor_duplicates_do_not_multiply_rows(spark):
    inf = [("B1", "US", 5, 5)]
    ven = [("B1", "US"), ("B1", "ZZ")]
    assert flags(spark, inf, ven) == [("B1", "US", "US", False, 5)]
    unguarded = flag_discrepancies(inferred(spark, inf), vendor(spark, ven), dedup=False)
    assert unguarded.count() == 2
    assert rows(vendor_conflicts(vendor(spark, ven))) == [("B1", 2, 2, "US", "ZZ")]
    assert rows(vendor_dedup(vendor(spark, ven))) == [("B1", "US")]


def test_discrepancy_severity(spark):
    inf = inferred(spark, [("B1", "US", 60, 100), ("B1", "CA", 38, 100), ("B1", "MX", 2, 100),
                           ("B2", "US", 98, 100), ("B2", "MX", 2, 100)])
    ven = vendor(spark, [("B1", "CA"), ("B2", "MX")])
    got = {r.BIN: r for r in discrepancy_severity(inf, ven).collect()}
    assert got["B1"].is_discrepant and got["B1"].vendor_in_top and not got["B1"].is_significant
    assert got["B1"].vendor_country_txns == 38
    assert got["B2"].is_discrepant and not got["B2"].vendor_in_top and got["B2"].is_significant

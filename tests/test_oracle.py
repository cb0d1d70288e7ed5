"""Every registered query against DuckDB, and the recorded counts of the derived trips."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from faresift.plans import catalog

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

RECORDED = {
    "raw_rows": 10_000,
    "processed_rows": 9_957,
    "rejected_rows": 43,
    "is_flex_fare_record": 475,
    "is_unknown_ratecode": 180,
    "is_negative_transaction": 185,
    "has_amount_sign_mismatch": 177,
    "is_outside_reporting_month": 72,
    "has_nonpositive_duration": 195,
    "has_suspicious_long_duration": 71,
    "has_near_24h_duration": 166,
    "has_extreme_duration": 183,
    "has_negative_distance": 46,
    "has_zero_distance": 119,
    "has_extreme_distance": 87,
    "has_implausible_speed": 1_047,
    "has_zero_passengers": 1_186,
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry_point.queries())
    assert set(catalog.QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SMALL)
    assert differences(df, duck, entry_point.oracle_sql()[name]) == []


def test_summary_has_recorded_counts(spark):
    rows = catalog.quality_summary(spark, MEDIUM).collect()
    assert [r["metric"] for r in rows] == list(RECORDED)
    assert {r["metric"]: r["count"] for r in rows} == RECORDED


def test_entry_is_the_summary(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["metric", "count", "percentage_of_raw"]
    assert df.count() == 17

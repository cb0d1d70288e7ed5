"""Source gate, reconciliation and quality summary."""

import pytest
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.operators import cleaning, gate, quality


def rules(df):
    return sorted((r["rule"], r["column"]) for r in gate.violations(df).collect())


def test_sound_source_passes(trip):
    df = trip({}, {"payment_type": 0}, {"store_and_fwd_flag": None, "RatecodeID": None})
    assert rules(df) == []
    gate.validate_source(df)


def test_empty(trip):
    df = trip({}).where(F.lit(False))
    assert rules(df) == [("empty", None)]
    with pytest.raises(ValueError, match="empty"):
        gate.validate_source(df)


def test_missing_and_renamed_columns(trip):
    df = trip({"payment_type": 9}).withColumnRenamed("Airport_fee", "airport_fee")
    # Codes are not judged while a column is missing.
    assert rules(df) == [("missing_column", "Airport_fee"), ("unexpected_column", "airport_fee")]


def test_extra_column_and_code_in_one_error(trip, tmp_path):
    df = trip({"payment_type": 9}, {"payment_type": 12}, {"store_and_fwd_flag": "X"}).withColumn("cbd_congestion_fee", F.lit(1.0))
    with pytest.raises(ValueError) as error:
        gate.validate_source(df, str(tmp_path / "faults"))
    text = str(error.value)
    assert "unexpected_column cbd_congestion_fee (1)" in text
    assert "unknown_code payment_type (2)" in text and "unknown_code store_and_fwd_flag (1)" in text
    assert df.sparkSession.read.parquet(str(tmp_path / "faults")).count() == 4


def test_many_unknown_codes_are_listed_in_full(spark, trip, tmp_path):
    df = trip({}).drop("VendorID").join(spark.range(100, 5100).select(F.col("id").cast("int").alias("VendorID")))
    df = df.select(S.TRIP_COLUMNS)
    with pytest.raises(ValueError, match=r"unknown_code VendorID \(5,000\)"):
        gate.validate_source(df, str(tmp_path / "faults"))
    assert spark.read.parquet(str(tmp_path / "faults")).count() == 5000
    report = gate.domain_report(df).where("column = 'VendorID'")
    assert report.count() == 5000 and not report.where("documented OR all_documented").count()


def test_text_is_not_a_datetime(trip):
    df = trip({}).withColumn(S.PICKUP, F.col(S.PICKUP).cast("string"))
    assert rules(df) == [("not_datetime", S.PICKUP)]


def test_fractional_code_is_unknown_to_the_gate_but_whole_in_the_report(trip):
    df = trip({"RatecodeID": 1.5})
    assert rules(df) == [("unknown_code", "RatecodeID")]
    report = {r["column"]: r for r in gate.domain_report(df).collect()}
    assert report["RatecodeID"]["code"] == 1 and report["RatecodeID"]["all_documented"]


def test_domain_report_of_columns_without_values(trip):
    report = {r["column"]: r for r in gate.domain_report(trip({"RatecodeID": None})).collect()}
    assert report["RatecodeID"]["code"] is None and report["RatecodeID"]["all_documented"]


def halves(df):
    return cleaning.transform_trips(df, 2024, 1, "f", "2025-01-01 00:00:00")


def test_summary_refuses_lost_rows(trip):
    raw = trip({}, {}, {S.PICKUP: None})
    processed, rejected = halves(raw)
    assert quality.quality_summary(processed, rejected, raw).count() == 17
    for wrong in (4, trip({})):
        with pytest.raises(Exception, match="raw=.*processed=2, rejected=1"):
            quality.quality_summary(processed, rejected, wrong).collect()


def test_reconcile():
    quality.reconcile(3, 2, 1)
    with pytest.raises(ValueError, match="raw=3, processed=1, rejected=1"):
        quality.reconcile(3, 1, 1)


def test_summary_needs_every_flag(trip):
    processed, rejected = halves(trip({}))
    with pytest.raises(ValueError, match="lack 2 flags: has_zero_distance, is_flex_fare_record"):
        quality.quality_summary(processed.drop("is_flex_fare_record", "has_zero_distance"), rejected, 1)


def test_percentages_are_half_even_on_the_float_and_null_without_rows(trip):
    processed, rejected = halves(trip(*[{}] * 7, {"trip_distance": 0.0}))
    found = {r["metric"]: r["percentage_of_raw"] for r in quality.quality_summary(processed, rejected, 8).collect()}
    assert found["has_zero_distance"] == 12.5 and found["raw_rows"] == 100.0
    empty = halves(trip({}).where(F.lit(False)))
    assert {r["percentage_of_raw"] for r in quality.quality_summary(*empty, 0).collect()} == {None}


def test_free_values_are_listed_in_full(spark):
    df = spark.range(3000).select(F.col("id").alias("code"), F.nullif(F.col("id").cast("string"), F.lit("7")).alias("text"))
    assert gate.domain_report(df, {"code": [1]}).where("NOT documented").count() == 2999
    found = gate.string_domain_report(df, "text", ["1"])
    assert found.count() == 3000 and found.where("is_outside").count() == 2998
    assert found.where("value IS NULL").first()["rows"] == 1

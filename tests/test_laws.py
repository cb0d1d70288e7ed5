"""Laws that hold for any trips, in any session zone and any partitioning."""

import pytest
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.operators import cleaning, quality
from faresift.plans.derived_trips import MONTH_FILE, PROCESSING_TIME, trips

SF = "/root/testdata/sf0.001"


def halves(df):
    return cleaning.transform_trips(df, 2024, 1, MONTH_FILE, PROCESSING_TIME)


def test_every_row_goes_to_one_half(spark):
    df = trips(spark, SF)
    processed, rejected = halves(df)
    back = processed.select(S.TRIP_COLUMNS).unionAll(rejected.select(S.TRIP_COLUMNS))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_flags_are_never_null_and_durations_exclude_each_other(spark):
    processed, _ = halves(trips(spark, SF))
    nulls = processed.where(" OR ".join(f"{f} IS NULL" for f in S.QUALITY_FLAGS))
    assert nulls.count() == 0
    several = sum(F.col(f).cast("int") for f in S.QUALITY_FLAGS[5:9]) > 1
    assert processed.where(several).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("partitions", [1, 8])
def test_zone_and_partitioning_do_not_matter(spark, zone, partitions):
    expected = quality.quality_summary(*halves(trips(spark, SF)), trips(spark, SF)).collect()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = trips(spark, SF).repartition(partitions)
        assert quality.quality_summary(*halves(df), df).collect() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

"""Threshold sides and null rules of the split, the measures and the flags."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.operators import cleaning
from trip_rows import FLEX, lasting

NOW = datetime(2025, 1, 1)
TICK = timedelta(microseconds=1)


def clean(df, now=NOW, year=2024, month=1):
    return cleaning.transform_trips(df, year, month, "yellow_tripdata_2024-01.parquet", now)


def flags_of(df):
    row = clean(df)[0].first()
    return {f for f in S.QUALITY_FLAGS if row[f]}


@pytest.mark.parametrize(
    "pickup, kept",
    [
        (None, False),
        (datetime(2023, 1, 1) - TICK, False),
        (datetime(2023, 1, 1), True),
        (NOW, True),
        (NOW + TICK, False),
    ],
)
def test_trusted_range(trip, pickup, kept):
    processed, rejected = clean(trip({S.PICKUP: pickup}))
    assert (processed.count(), rejected.count()) == ((1, 0) if kept else (0, 1))


@pytest.mark.parametrize(
    "pickup, outside",
    [
        (datetime(2024, 1, 1), False),
        (datetime(2024, 1, 31, 23, 59, 59, 999999), False),
        (datetime(2024, 2, 1), True),
        (datetime(2023, 12, 31, 23, 59, 59), True),
    ],
)
def test_month_edges(trip, pickup, outside):
    row = clean(trip({S.PICKUP: pickup, S.DROPOFF: pickup + timedelta(minutes=20)}))[0].first()
    assert row["is_outside_reporting_month"] is outside


DURATION_FLAGS = {
    "has_nonpositive_duration",
    "has_suspicious_long_duration",
    "has_near_24h_duration",
    "has_extreme_duration",
}


@pytest.mark.parametrize(
    "minutes, flag",
    [
        (-0.5, "has_nonpositive_duration"),
        (0, "has_nonpositive_duration"),
        (0.5, None),
        (360, None),
        (360.01, "has_suspicious_long_duration"),
        (1379.99, "has_suspicious_long_duration"),
        (1380, "has_near_24h_duration"),
        (1439.99, "has_near_24h_duration"),
        (1440, "has_extreme_duration"),
    ],
)
def test_duration_flags_exclude_each_other(trip, minutes, flag):
    assert flags_of(trip(lasting(minutes))) & DURATION_FLAGS == ({flag} if flag else set())


def test_missing_dropoff_has_no_measures_and_no_flags(trip):
    df = trip({S.DROPOFF: None})
    row = clean(df)[0].first()
    assert row[S.DURATION] is None and row[S.SPEED] is None
    assert flags_of(df) == set()


@pytest.mark.parametrize(
    "miles, flag",
    [
        (-0.01, "has_negative_distance"),
        (0.0, "has_zero_distance"),
        (100.0, None),
        (100.01, "has_extreme_distance"),
        (None, None),
    ],
)
def test_distance_flags(trip, miles, flag):
    found = flags_of(trip(lasting(600, trip_distance=miles))) - {"has_suspicious_long_duration"}
    assert found == ({flag} if flag else set())


@pytest.mark.parametrize(
    "miles, minutes, speed, implausible",
    [(80.0, 60, 80.0, False), (80.01, 60, 80.01, True), (-1.0, 60, None, False), (5.0, 0, None, False), (0.0, 60, 0.0, False)],
)
def test_speed(trip, miles, minutes, speed, implausible):
    row = clean(trip(lasting(minutes, trip_distance=miles)))[0].first()
    assert row[S.SPEED] == speed
    assert row["has_implausible_speed"] is implausible


@pytest.mark.parametrize(
    "fare, total, mismatch",
    [(-1.0, -1.0, False), (-1.0, 1.0, True), (1.0, -1.0, True), (None, -1.0, True), (None, None, False), (1.0, 1.0, False)],
)
def test_sign_mismatch(trip, fare, total, mismatch):
    row = clean(trip({"fare_amount": fare, "total_amount": total}))[0].first()
    assert row["has_amount_sign_mismatch"] is mismatch


def test_missing_codes_raise_no_flags(trip):
    assert flags_of(trip({"RatecodeID": None, "payment_type": None, "passenger_count": None})) == set()


def test_flags_from_codes(trip):
    assert flags_of(trip(FLEX)) == {"is_flex_fare_record"}
    assert flags_of(trip({"RatecodeID": 99.0})) == {"is_unknown_ratecode"}
    assert flags_of(trip({"passenger_count": 0.0})) == {"has_zero_passengers"}
    assert flags_of(trip({"passenger_count": 9.0})) == set()


def test_output_columns(trip):
    processed, rejected = clean(trip({}))
    assert processed.columns == [
        *S.TRIP_COLUMNS,
        "source_file",
        *S.QUALITY_FLAGS[:5],
        S.DURATION,
        *S.QUALITY_FLAGS[5:12],
        S.SPEED,
        *S.QUALITY_FLAGS[12:],
    ]
    assert rejected.columns == [*S.TRIP_COLUMNS, "source_file", "rejection_reason"]
    assert rejected.count() == 0


def test_rejected_row_is_kept_as_it_was(trip):
    row = clean(trip({S.PICKUP: None, "fare_amount": -3.0, **FLEX}))[1].first()
    assert row["rejection_reason"] == "untrustworthy_pickup_timestamp"
    assert row["source_file"] == "yellow_tripdata_2024-01.parquet"
    assert row["fare_amount"] == -3.0 and row["congestion_surcharge"] is None


@pytest.mark.parametrize("month", [0, 13])
def test_month_must_exist(trip, month):
    with pytest.raises(ValueError, match="between 1 and 12"):
        clean(trip({}), month=month)


def test_december_ends_in_the_next_year(trip):
    inside, outside = datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1)
    rows = trip(*[{S.PICKUP: p, S.DROPOFF: p} for p in (inside, outside)])
    found = {r[S.PICKUP]: r["is_outside_reporting_month"] for r in clean(rows, year=2023, month=12)[0].collect()}
    assert found == {inside: False, outside: True}


def test_zone_of_processing_time_is_dropped_not_converted(trip):
    now = datetime(2025, 1, 1, tzinfo=timezone(timedelta(hours=-9)))
    rows = trip({S.PICKUP: NOW}, {S.PICKUP: NOW + TICK})
    processed, rejected = clean(rows, now=now)
    assert (processed.count(), rejected.count()) == (1, 1)


def test_default_processing_time_is_the_session_clock(trip):
    processed, rejected = clean(trip({}, {S.PICKUP: datetime(2999, 1, 1)}), now=None)
    assert (processed.count(), rejected.count()) == (1, 1)


def test_duration_ignores_session_zone_and_dst(spark, trip):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = trip({S.PICKUP: datetime(2024, 3, 10, 1, 30), S.DROPOFF: datetime(2024, 3, 10, 3, 30)})
        assert clean(df, month=3)[0].first()[S.DURATION] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_split_reaches_the_parquet_scan(spark):
    from faresift.plans.catalog import _halves

    for half in _halves(spark, "/root/testdata/sf0.001"):
        plan = half._jdf.queryExecution().executedPlan().toString()
        assert "LessThan(tpep_pickup_datetime" in plan or "GreaterThanOrEqual(tpep_pickup_datetime" in plan
        assert "Exchange" not in plan


def test_many_months_equal_each_month_alone(spark, trip):
    files = {"yellow_tripdata_2024-01.parquet": (2024, 1), "yellow_tripdata_2023-12.parquet": (2023, 12)}
    pickups = [datetime(2024, 1, 5), datetime(2023, 12, 5), datetime(2022, 12, 15), datetime(2022, 11, 1), None]
    rows = trip(*[{S.PICKUP: p} for p in pickups])
    both = [rows.withColumn("source_file", F.lit(name)) for name in files]
    periods = spark.createDataFrame(
        [(n, y, m) for n, (y, m) in files.items()], "source_file string, reporting_year int, reporting_month int"
    )
    together = cleaning.transform_many(both[0].unionAll(both[1]), periods, NOW)
    alone = [cleaning.transform_trips(rows, y, m, n, NOW) for n, (y, m) in files.items()]
    for i in (0, 1):
        expected = sorted(map(str, alone[0][i].collect() + alone[1][i].collect()))
        assert sorted(map(str, together[i].collect())) == expected


def test_many_months_refuse_an_unlisted_file(spark, trip):
    rows = trip({}).withColumn("source_file", F.lit("yellow_tripdata_2024-05.parquet"))
    periods = spark.createDataFrame([], "source_file string, reporting_year int, reporting_month int")
    with pytest.raises(Exception, match="No reporting period"):
        cleaning.transform_many(rows, periods, NOW)[0].collect()


def test_normal_trips(trip):
    rows = trip({}, lasting(0), lasting(1400), {"trip_distance": 101.0}, lasting(1, trip_distance=5.0), lasting(400))
    kept = cleaning.normal_trips(clean(rows)[0])
    assert sorted(r[S.DURATION] for r in kept.collect()) == [20.0, 400.0]

"""Hand-made trips: a sound trip, changed column by column."""

from datetime import datetime, timedelta

from faresift import schema as S

SOUND = {
    "VendorID": 2,
    "tpep_pickup_datetime": datetime(2024, 1, 10, 8, 0),
    "tpep_dropoff_datetime": datetime(2024, 1, 10, 8, 20),
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 17.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
}
FLEX = {c: None for c in S.BLOCK_COLUMNS} | {"payment_type": 0}


def trip_frame(spark, rows):
    filled = [tuple({**SOUND, **row}[c] for c in S.TRIP_COLUMNS) for row in rows]
    return spark.createDataFrame(filled, S.TRIP_SCHEMA)


def lasting(minutes: float, **row) -> dict:
    start = SOUND["tpep_pickup_datetime"]
    return {"tpep_dropoff_datetime": start + timedelta(microseconds=round(minutes * 60e6)), **row}

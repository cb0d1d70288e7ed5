"""The trip table derived from the ``events`` table, and months landed from it.

The same select list runs on Spark and on DuckDB; only the spelling of wall-clock literals and
of a number of seconds differs. Money is built in whole cents, dates and codes carry every kind
of fault the rules look for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift.session import hadoop_path, work_dir, work_root
from faresift.sources.trips import read_month

PERIOD = (2024, 1)
PROCESSING_TIME = "2025-01-01 00:00:00"
MONTH_FILE = "yellow_tripdata_2024-01.parquet"

_SOURCE = """
SELECT event_id AS k, ts,
 CASE WHEN event_id%1009=3 THEN NULL WHEN event_id%997=5 THEN {T}'2002-12-31 22:59:39'
      WHEN event_id%991=7 THEN {T}'2009-01-01 00:00:00' WHEN event_id%983=11 THEN {T}'2099-01-01 00:00:00'
      WHEN event_id%977=23 THEN {T}'2023-01-01 00:00:00' WHEN event_id%499=13 THEN {T}'2023-12-31 23:50:00'
      WHEN event_id%503=17 THEN {T}'2024-02-01 00:00:00' WHEN event_id%487=19 THEN {T}'2023-06-15 12:00:00'
      ELSE ts END AS pickup,
 CASE WHEN event_id%101=0 THEN -30 WHEN event_id%103=0 THEN 0 WHEN event_id%107=0 THEN 86400
      WHEN event_id%109=0 THEN 90000 WHEN event_id%113=0 THEN 82800 WHEN event_id%127=0 THEN 83000+event_id%3000
      WHEN event_id%131=0 THEN 21600 WHEN event_id%137=0 THEN 21601+event_id%50000 WHEN event_id%97=0 THEN 20
      ELSE 60+(event_id*37)%3000 END AS secs,
 CASE WHEN event_id%79=0 THEN -1 ELSE 1 END AS s, 300+(event_id*17)%5000 AS f,
 (event_id%3)*100 + CASE WHEN event_id%4=1 THEN 250 ELSE 0 END AS e, (event_id%7)*50 AS tip,
 CASE WHEN event_id%50=0 THEN 694 ELSE 0 END AS toll, CASE WHEN event_id%12=0 THEN 175 ELSE 0 END AS air
FROM {events}
"""

_TRIPS = """
SELECT k,
 CAST(CASE WHEN k%42=0 THEN 6 WHEN k%4=1 THEN 1 ELSE 2 END AS INT) AS VendorID,
 pickup AS tpep_pickup_datetime,
 CASE WHEN k%1013=29 THEN NULL ELSE coalesce(pickup, ts) + {SEC} END AS tpep_dropoff_datetime,
 CASE WHEN k%21<>0 THEN CAST(k%8 AS DOUBLE) END AS passenger_count,
 CASE WHEN k%89=0 THEN CAST(0 AS DOUBLE) WHEN k%211=0 THEN CAST(-1.5 AS DOUBLE)
      WHEN k%223=0 THEN CAST(312722.3 AS DOUBLE) WHEN k%227=0 THEN CAST(100 AS DOUBLE)
      WHEN k%229=0 THEN CAST(100.01 AS DOUBLE)
      ELSE CAST((k*13)%1500 AS DOUBLE)/CAST(100 AS DOUBLE) END AS trip_distance,
 CASE WHEN k%21=0 THEN NULL WHEN k%53=0 THEN CAST(99 AS DOUBLE) ELSE CAST(1+k%6 AS DOUBLE) END AS RatecodeID,
 CASE WHEN k%21=0 THEN NULL WHEN k%100=1 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
 CAST(1+(k*7)%265 AS INT) AS PULocationID, CAST(1+(k*11)%265 AS INT) AS DOLocationID,
 CAST(CASE WHEN k%21=0 THEN 0 WHEN k%10<7 THEN 1 ELSE k%10-5 END AS BIGINT) AS payment_type,
 CAST(CASE WHEN k%83=0 THEN -1 ELSE s END * f AS DOUBLE)/CAST(100 AS DOUBLE) AS fare_amount,
 CAST(s*e AS DOUBLE)/CAST(100 AS DOUBLE) AS extra,
 CAST(s*50 AS DOUBLE)/CAST(100 AS DOUBLE) AS mta_tax,
 CAST(s*tip AS DOUBLE)/CAST(100 AS DOUBLE) AS tip_amount,
 CAST(s*toll AS DOUBLE)/CAST(100 AS DOUBLE) AS tolls_amount,
 CAST(s*100 AS DOUBLE)/CAST(100 AS DOUBLE) AS improvement_surcharge,
 CAST(CASE WHEN k%167=0 THEN -1 ELSE s END * (f+e+50+tip+toll+100+air+CASE WHEN k%4=1 THEN 0 ELSE 250 END) AS DOUBLE)
   /CAST(100 AS DOUBLE) AS total_amount,
 CASE WHEN k%21<>0 THEN CAST(s*250 AS DOUBLE)/CAST(100 AS DOUBLE) END AS congestion_surcharge,
 CASE WHEN k%21<>0 THEN CAST(s*air AS DOUBLE)/CAST(100 AS DOUBLE) END AS Airport_fee
FROM ({source}) b
"""


def duckdb_trips() -> str:
    """SELECT text of the trips (with ``k``, the position of each) for DuckDB."""
    source = _SOURCE.format(T="TIMESTAMP ", events="events")
    return _TRIPS.format(source=source, SEC="to_seconds(secs)")


def numbered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with ``k``, the position of each in the source."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = _SOURCE.format(T="TIMESTAMP_NTZ ", events="{events}")
    text = _TRIPS.format(source=source, SEC="make_dt_interval(0,0,0,secs)")
    return spark.sql(text, events=events)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as a Parquet scan of the landed month, so that filters and columns reach the files."""
    return read_month(spark, landed_month(spark, sf_dir))


_known: dict[tuple[str, str], str] = {}


def _land(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    """Folder with a table derived from ``events``, written once per state of that table.

    It lies in the shared work folder under a name made of what it is derived from, so later
    sessions read the same copy. It is written aside and renamed when complete: a run that
    dies on the way leaves nothing that could be taken for the table.
    """
    events, fs = hadoop_path(spark, f"{sf_dir}/events.parquet")
    state = fs.getContentSummary(events)
    changed = fs.getFileStatus(events).getModificationTime()
    basis = (fs.makeQualified(events).toString(), state.getLength(), state.getFileCount(), changed, kind, _SOURCE, _TRIPS)
    name = hashlib.sha256(repr(basis).encode()).hexdigest()[:24]
    folder = f"{work_root(spark)}/faresift-trips-{name}"
    target, fs = hadoop_path(spark, folder)
    if not fs.exists(target):
        aside = work_dir(spark)
        write(aside)
        source, _ = hadoop_path(spark, aside)
        # Another session may have been faster; its copy is the same.
        if not fs.rename(source, target) and not fs.exists(target):
            raise OSError(f"Could not land {folder}")
    return folder


def _landed(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None]) -> str:
    key = (f"{spark.sparkContext.applicationId} {sf_dir}", kind)
    if key not in _known:
        _known[key] = _land(spark, sf_dir, kind, write)
    return _known[key]


def landed_month(spark: SparkSession, sf_dir: str) -> str:
    """Path of all trips as one month: a Parquet folder named like a monthly file."""
    write = lambda folder: numbered_trips(spark, sf_dir).drop("k").write.parquet(f"{folder}/{MONTH_FILE}")
    return f"{_landed(spark, sf_dir, 'month', write)}/{MONTH_FILE}"


# Months by vendor; the last one takes every row that no other takes.
VENDOR_MONTHS = {
    1: "yellow_tripdata_2024-01.parquet",
    2: "yellow_tripdata_2024-02.parquet",
    None: "yellow_tripdata_2024-03.parquet",
}


def landed_months(spark: SparkSession, sf_dir: str) -> str:
    """Folder of three months that together hold all trips, whatever their vendor."""
    vendor = F.col("VendorID")
    named = [v for v in VENDOR_MONTHS if v is not None]

    def write(folder: str) -> None:
        for own, name in VENDOR_MONTHS.items():
            rest = vendor.isNull() | ~vendor.isin(named)
            trips(spark, sf_dir).where(rest if own is None else vendor == own).write.parquet(f"{folder}/{name}")

    return _landed(spark, sf_dir, "months by vendor", write)

"""Reading, lineage, writing, landing and the two cleaning jobs on real files."""

import json
import os
import subprocess
import sys
import time
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.operators.cleaning import transform_trips
from faresift.operators.diagnostics import segment_contiguity
from faresift.plans import report
from faresift.plans import clean
from faresift.plans.clean import clean_month, clean_months, clean_new_months
from faresift.sources import landing, sinks
from faresift.sources import trips as source
from faresift.streaming.ingest import ingest_incremental
from trip_rows import FLEX, SOUND

JAN, FEB = "yellow_tripdata_2024-01.parquet", "yellow_tripdata_2024-02.parquet"
NOW = "2025-01-01 00:00:00"
ARROW = {
    "VendorID": pa.int32(),
    S.PICKUP: pa.timestamp("us"),
    S.DROPOFF: pa.timestamp("us"),
    "store_and_fwd_flag": pa.string(),
    "PULocationID": pa.int32(),
    "DOLocationID": pa.int32(),
    "payment_type": pa.int64(),
}


def save(path, *rows, **changed_types):
    types = {c: ARROW.get(c, pa.float64()) for c in S.TRIP_COLUMNS} | changed_types
    filled = [{**{c: SOUND.get(c, 1.0) for c in types}, **row} for row in rows]
    columns = {c: pa.array([r[c] for r in filled], t) for c, t in types.items()}
    pq.write_table(pa.table(columns), path)
    return str(path)


def in_february(**row):
    return {S.PICKUP: datetime(2024, 2, 3, 8), S.DROPOFF: datetime(2024, 2, 3, 9), **row}


def test_nan_is_missing(spark, tmp_path):
    path = save(tmp_path / JAN, {"trip_distance": float("nan")}, {"passenger_count": None})
    df = source.read_trips(spark, path)
    assert df.columns == S.TRIP_COLUMNS
    assert sorted(r["trip_distance"] is None for r in df.collect()) == [False, True]


def test_zoned_timestamps_become_their_utc_reading(spark, tmp_path):
    path = save(tmp_path / JAN, {}, **{S.PICKUP: pa.timestamp("us", "UTC")})
    df = source.read_trips(spark, path)
    assert dict(df.dtypes)[S.PICKUP] == "timestamp_ntz"
    assert df.first()[S.PICKUP] == SOUND[S.PICKUP]


def test_missing_or_empty_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        source.read_trips(spark, str(tmp_path / JAN))
    (tmp_path / JAN).touch()
    with pytest.raises(ValueError, match="empty"):
        source.read_trips(spark, str(tmp_path / JAN))
    with pytest.raises(FileNotFoundError):
        source.month_paths(spark, str(tmp_path / "none"))


def test_months_are_read_in_name_order_with_lineage(spark, tmp_path):
    save(tmp_path / FEB, {}, {})
    save(tmp_path / JAN, {})
    (tmp_path / "other.parquet").touch()
    assert [p.rsplit("/", 1)[-1] for p in source.month_paths(spark, str(tmp_path))] == [JAN, FEB]
    counted = source.read_trips(spark, str(tmp_path)).groupBy("source_file").count().collect()
    assert {r["source_file"]: r["count"] for r in counted} == {JAN: 1, FEB: 2}


def test_each_month_is_held_to_the_schema(spark, tmp_path):
    save(tmp_path / JAN, {})
    save(tmp_path / FEB, {}, cbd_congestion_fee=pa.float64())
    with pytest.raises(ValueError, match=f"{FEB}: unexpected_column cbd_congestion_fee"):
        source.read_trips(spark, str(tmp_path))


def test_months_may_differ_in_number_types(spark, tmp_path):
    save(tmp_path / JAN, {})
    save(tmp_path / FEB, {"passenger_count": 4}, passenger_count=pa.int64(), VendorID=pa.int64())
    df = source.read_trips(spark, str(tmp_path))
    assert sorted(r["passenger_count"] for r in df.collect()) == [1.0, 4.0]


@pytest.mark.parametrize("name", ["yellow_tripdata_2024-1.parquet", f"x_{JAN}", f"{JAN}.tmp", "yellow_tripdata_2024-13.parquet"])
def test_names_that_do_not_fit(spark, name):
    with pytest.raises(ValueError):
        source.reporting_period(name)
    df = spark.createDataFrame([(name,)], "source_file string")
    with pytest.raises(Exception, match="Expected a name like"):
        source.with_reporting_period(df).collect()
    assert source.with_reporting_period(df, strict=False).first()["reporting_year"] is None


def test_reporting_period_of_a_name(spark):
    assert source.reporting_period(JAN) == (2024, 1)
    df = spark.createDataFrame([(JAN,)], "source_file string")
    assert tuple(source.with_reporting_period(df).first()) == (JAN, 2024, 1)


def test_inventory(spark, tmp_path):
    paths = [save(tmp_path / JAN, {}, {}), str(tmp_path / FEB)]
    (tmp_path / FEB).touch()
    found = {r["source_file"]: r for r in source.file_inventory(spark, paths).collect()}
    size = (tmp_path / JAN).stat().st_size
    assert found[JAN]["rows"] == 2 and found[JAN]["size_bytes"] == size
    assert found[JAN]["size_mb"] == size / 1024 / 1024 and not found[JAN]["is_empty"]
    assert found[FEB]["rows"] == 0 and found[FEB]["is_empty"]


def test_segment_position_in_the_file(spark, tmp_path):
    gap = source.with_position(source.read_trips(spark, save(tmp_path / JAN, FLEX, {}, FLEX)))
    row = segment_contiguity(gap, "row_position", "source_path").first()
    assert (row["first_position"], row["last_position"], row["segment_rows"], row["contiguous"]) == (0, 2, 2, False)
    block = source.with_position(source.read_trips(spark, save(tmp_path / FEB, {}, FLEX, FLEX)))
    assert segment_contiguity(block, "row_position").first()["contiguous"]
    none = segment_contiguity(block.where("payment_type = 1"), "row_position").first()
    assert none["segment_rows"] == 0 and none["first_position"] is None and none["contiguous"] is None


def test_first_rows_of_a_month_in_several_files(spark, tmp_path):
    (tmp_path / JAN).mkdir()
    save(tmp_path / JAN / "b.parquet", *[{"extra": float(i)} for i in range(10, 20)])
    save(tmp_path / JAN / "a.parquet", {"extra": 1.0}, {"extra": 2.0})
    assert [r["extra"] for r in source.first_rows(spark, str(tmp_path / JAN), 4).collect()] == [1.0, 2.0, 10.0, 11.0]


def test_clean_month_writes_reconciled_outputs(spark, tmp_path):
    path = save(tmp_path / JAN, {}, {"trip_distance": 0.0}, {S.PICKUP: datetime(2002, 12, 31)})
    out = str(tmp_path / "out")
    summary = {r["metric"]: r["count"] for r in clean_month(spark, path, out, NOW).collect()}
    assert (summary["raw_rows"], summary["processed_rows"], summary["rejected_rows"]) == (3, 2, 1)
    assert summary["has_zero_distance"] == 1
    paths = sinks.current(spark, out, JAN)
    processed = spark.read.parquet(paths["processed"])
    assert len(processed.columns) == 36 and processed.count() == 2
    assert {r["source_file"] for r in processed.collect()} == {JAN}
    csv = spark.read.csv(paths["quality"], header=True)
    assert csv.columns == ["metric", "count", "percentage_of_raw"] and csv.count() == 17

    # A rerun without rejects must not leave the earlier ones in place.
    save(tmp_path / JAN, {})
    spark.catalog.refreshByPath(path)
    clean_month(spark, path, out, NOW)
    rejected = spark.read.parquet(sinks.current(spark, out, JAN)["rejected"])
    assert rejected.count() == 0 and len(rejected.columns) == 21
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["current", "runs"]


STEPS = ["write_half", "write_quality_reports", "write_empty", "point_to"]


@pytest.mark.parametrize("step", STEPS)
def test_a_failure_between_any_steps_leaves_the_earlier_result(spark, tmp_path, monkeypatch, step):
    save(tmp_path / JAN, {}, {S.PICKUP: None})
    out = str(tmp_path / "out")
    clean_months(spark, str(tmp_path), out, NOW)
    before = sinks.current(spark, out, JAN)
    rows = {half: spark.read.parquet(before[half]).count() for half in sinks.HALVES}

    save(tmp_path / JAN, {}, {}, {})
    spark.catalog.refreshByPath(str(tmp_path))

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(clean.sinks, step, broken)
    with pytest.raises(OSError, match="lost"):
        clean_months(spark, str(tmp_path), out, NOW)
    assert sinks.current(spark, out, JAN) == before
    assert {half: spark.read.parquet(before[half]).count() for half in sinks.HALVES} == rows
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 1


def test_only_new_months_are_cleaned(spark, tmp_path):
    save(tmp_path / JAN, {})
    out = str(tmp_path / "out")
    assert clean_new_months(spark, str(tmp_path), out, NOW).select("source_file").distinct().count() == 1
    first = sinks.current(spark, out, JAN)
    assert clean_new_months(spark, str(tmp_path), out, NOW) is None
    save(tmp_path / FEB, in_february())
    again = clean_new_months(spark, str(tmp_path), out, NOW)
    assert {r["source_file"] for r in again.collect()} == {FEB}
    assert sinks.current(spark, out, JAN) == first and sinks.current(spark, out, FEB)


def test_failed_month_writes_nothing(spark, tmp_path):
    path = save(tmp_path / JAN, {"payment_type": 9})
    with pytest.raises(ValueError, match="payment_type"):
        clean_month(spark, path, str(tmp_path / "out"), NOW)
    assert not (tmp_path / "out").exists()


def test_clean_months_equals_month_by_month(spark, tmp_path):
    save(tmp_path / JAN, {}, {S.PICKUP: None}, {"trip_distance": 0.0})
    save(tmp_path / FEB, in_february(), {}, in_february(fare_amount=-1.0))
    together, alone = str(tmp_path / "together"), str(tmp_path / "alone")
    for _ in range(2):
        summary = clean_months(spark, str(tmp_path), together, NOW)
    for name in (JAN, FEB):
        one = clean_month(spark, str(tmp_path / name), alone, NOW)
        mine = summary.where(F.col("source_file") == name).drop("source_file")
        assert mine.collect() == one.collect()
        for half in sinks.HALVES:
            a, b = (spark.read.parquet(sinks.current(spark, o, name)[half]) for o in (together, alone))
            assert a.columns == b.columns
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


CLEAN = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, sys.argv[1])
from faresift.plans.clean import clean_months
folder = sys.argv[2]
logged = {"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": f"file://{folder}/log"}
spark = SparkSession.builder.master("local[2]").config(map=logged | {"spark.sql.session.timeZone": "UTC"}).getOrCreate()
clean_months(spark, f"{folder}/raw", f"{folder}/out", "2025-01-01 00:00:00")
assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
spark.stop()
"""


def test_halves_are_written_without_shuffle_or_sort_in_a_plain_session(tmp_path):
    for name in ("raw", "log"):
        (tmp_path / name).mkdir()
    save(tmp_path / "raw" / JAN, {}, {S.PICKUP: None})
    save(tmp_path / "raw" / FEB, in_february(), {S.PICKUP: None})
    root = str(Path(__file__).resolve().parent.parent)
    subprocess.run([sys.executable, "-c", CLEAN, root, str(tmp_path)], check=True, capture_output=True, timeout=300)
    # The last plan of each execution, by its number.
    plans = {}
    for log in (tmp_path / "log").rglob("events_*"):
        for event in map(json.loads, log.read_text().splitlines()):
            if "physicalPlanDescription" in event:
                plans[event["executionId"]] = event["physicalPlanDescription"]
    writes = [p for p in plans.values() if "InsertIntoHadoopFsRelationCommand" in p and "_source" in p and "Parquet" in p]
    assert len(writes) == 2
    for plan in writes:
        final = plan.partition("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in final
        assert "SortMergeJoin" not in plan
        assert "Sort (" not in final and "Sort [" not in final


def test_clean_months_without_any_rejects(spark, tmp_path):
    save(tmp_path / JAN, {})
    out = str(tmp_path / "out")
    summary = {r["metric"]: r["count"] for r in clean_months(spark, str(tmp_path), out, NOW).collect()}
    assert (summary["processed_rows"], summary["rejected_rows"]) == (1, 0)
    rejected = spark.read.parquet(sinks.current(spark, out, JAN)["rejected"])
    assert rejected.count() == 0 and len(rejected.columns) == 21


def test_clean_months_refuses_an_empty_month_and_unknown_codes(spark, tmp_path):
    save(tmp_path / JAN, {})
    save(tmp_path / FEB)
    with pytest.raises(ValueError, match="empty.*2024-02"):
        clean_months(spark, str(tmp_path), str(tmp_path / "out"), NOW)
    save(tmp_path / FEB, in_february(RatecodeID=7.0))
    with pytest.raises(ValueError, match="unknown_code RatecodeID"):
        clean_months(spark, str(tmp_path), str(tmp_path / "out"), NOW)
    assert not sinks.current(spark, str(tmp_path / "out"), JAN)


def test_pending_and_missing(spark):
    listing = spark.createDataFrame([(JAN,), (FEB,), (FEB,)], "file_name string")
    ledger = landing.landed_files(spark.createDataFrame([(JAN,), (JAN,)], "source_file string"))
    assert [r["file_name"] for r in landing.pending_files(listing, ledger).collect()] == [FEB]
    missing = landing.missing_months(spark, "2023-12", "2024-03", ledger)
    assert sorted(r["file_name"][16:23] for r in missing.collect()) == ["2023-12", "2024-02", "2024-03"]


def test_ingest_takes_each_file_once(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "checkpoint")
    src.mkdir()
    save(src / JAN, {}, {})
    run = lambda: ingest_incremental(spark, str(src), dst, checkpoint)
    counted = lambda: {r[0]: r[1] for r in spark.read.parquet(dst).groupBy("source_file").count().collect()}
    run()
    run()
    assert counted() == {JAN: 2}
    save(src / FEB, {}, float_row := {"trip_distance": float("nan")}, float_row)
    run()
    assert counted() == {JAN: 2, FEB: 3}
    assert spark.read.parquet(dst).where(F.isnan("trip_distance")).count() == 0


def test_ingest_takes_months_of_other_number_types_and_part_files(spark, tmp_path):
    src, dst, checkpoint = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "checkpoint")
    (src / FEB).mkdir(parents=True)
    save(src / JAN, {"passenger_count": 4}, passenger_count=pa.int64(), VendorID=pa.int64())
    save(src / FEB / "part-0.parquet", {}, {})
    for _ in range(2):
        ingest_incremental(spark, str(src), dst, checkpoint)
    landed = spark.read.parquet(dst)
    assert dict(landed.dtypes)["passenger_count"] == "double"
    assert {r[0]: r[1] for r in landed.groupBy("source_file").count().collect()} == {JAN: 1, FEB: 2}


def test_ingest_names_a_month_with_unknown_codes(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    save(src / JAN, {"payment_type": 9})
    with pytest.raises(Exception, match=f"{JAN} payment_type"):
        ingest_incremental(spark, str(src), str(tmp_path / "dst"), str(tmp_path / "checkpoint"))


def test_an_odd_part_file_of_a_month_fails_the_gate_and_the_ingest(spark, tmp_path):
    (tmp_path / "src" / JAN).mkdir(parents=True)
    save(tmp_path / "src" / JAN / "a.parquet", {})
    save(tmp_path / "src" / JAN / "b.parquet", {}, cbd_congestion_fee=pa.float64())
    with pytest.raises(ValueError, match="cbd_congestion_fee"):
        clean_month(spark, str(tmp_path / "src" / JAN), str(tmp_path / "out"), NOW)
    with pytest.raises(ValueError, match="cbd_congestion_fee"):
        source.read_trips(spark, str(tmp_path / "src"))
    with pytest.raises(Exception, match="cbd_congestion_fee"):
        ingest_incremental(spark, str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "checkpoint"))


def test_ingest_stops_at_a_file_that_breaks_the_schema(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    save(src / JAN, {}, cbd_congestion_fee=pa.float64())
    with pytest.raises(Exception, match="cbd_congestion_fee"):
        ingest_incremental(spark, str(src), str(tmp_path / "dst"), str(tmp_path / "checkpoint"))


def test_profile_and_report_run_whole(spark, tmp_path):
    path = save(tmp_path / JAN, {}, FLEX, {S.PICKUP: datetime(2024, 2, 2)})
    profile = report.profile_source(spark, path)
    assert profile["dataset_shape"].first()["rows"] == 3
    assert {r["column"] for r in profile["missing_counts"].collect()} == set(S.BLOCK_COLUMNS)
    df = source.with_position(source.read_trips(spark, path)).drop("source_path")
    found = report.exploratory_report(df, 2024, 1, NOW, position="row_position")
    for frame in found.values():
        frame.collect()
    wanted = {"preview", "segment_contiguity", "period_outliers", "passenger_value_counts", "near_24h_rows", "date_issue_unexplained"}
    assert wanted <= set(found) and len(found) == 42
    assert found["segment_contiguity"].first()["first_position"] == 1


def spoiled(folder, how):
    """A month of two part files, one of which lacks ``extra`` or has it as text."""
    (folder / JAN).mkdir(parents=True, exist_ok=True)
    save(folder / JAN / "a.parquet", {}, {})
    save(folder / JAN / "b.parquet", {})
    table = pq.read_table(folder / JAN / "b.parquet")
    at = table.schema.get_field_index("extra")
    odd = table.drop_columns("extra") if how == "missing_column" else table.set_column(at, "extra", table["extra"].cast(pa.string()))
    pq.write_table(odd, folder / JAN / "b.parquet")


@pytest.mark.parametrize("rule", ["missing_column", "part_type"])
def test_one_odd_part_file_is_refused_by_name(spark, tmp_path, rule):
    src = tmp_path / "src"
    spoiled(src, rule)
    save(src / FEB, in_february())
    named = f"{JAN}/b.parquet: {rule} extra"
    with pytest.raises(ValueError, match=named):
        source.read_trips(spark, str(src))
    with pytest.raises(ValueError, match=named):
        clean_month(spark, str(src / JAN), str(tmp_path / "out"), NOW)
    with pytest.raises(ValueError, match=named):
        clean_months(spark, str(src), str(tmp_path / "out"), NOW)
    with pytest.raises(Exception, match=named):
        ingest_incremental(spark, str(src), str(tmp_path / "dst"), str(tmp_path / "checkpoint"))
    assert not (tmp_path / "out").exists() and not (tmp_path / "dst").exists()


def test_months_of_one_schema_are_one_scan(spark, tmp_path):
    for month in range(1, 13):
        save(tmp_path / f"yellow_tripdata_2024-{month:02}.parquet", {})
    save(tmp_path / "yellow_tripdata_2025-01.parquet", {}, passenger_count=pa.int64())
    plan = source.read_trips(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_clean_months_over_years_and_schemas_equals_month_by_month(spark, tmp_path):
    day = lambda y, m, d=5: {S.PICKUP: datetime(y, m, d), S.DROPOFF: datetime(y, m, d, 1)}
    src, together, alone = tmp_path / "src", str(tmp_path / "together"), str(tmp_path / "alone")
    src.mkdir()
    names = [f"yellow_tripdata_{y}-{m:02}.parquet" for y, m in ((2022, 3), (2022, 11), (2023, 1), (2023, 12))]
    # Rows around each month's trusted start, a year before it: some are rejected in one month and kept in another.
    rows = [day(y, m) for y, m in ((2021, 2), (2021, 4), (2021, 12), (2022, 1), (2022, 12), (2024, 2))] + [{S.PICKUP: None}, day(2030, 1)]
    for name in names[:3]:
        save(src / name, *rows)
    save(src / names[3], *rows, VendorID=pa.int64())
    clean_months(spark, str(src), together, NOW)
    for name in names:
        clean_month(spark, str(src / name), alone, NOW)
        for half in sinks.HALVES:
            a, b = (spark.read.parquet(sinks.current(spark, o, name)[half]) for o in (together, alone))
            assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
            assert a.count() > 0


def test_quarantine_lets_the_other_months_land(spark, tmp_path):
    src, dst, checkpoint, aside = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "checkpoint"), str(tmp_path / "aside")
    spoiled(src, "missing_column")
    save(src / FEB, in_february(), in_february())
    save(src / "yellow_tripdata_2024-03.parquet", {})
    save(src / "yellow_tripdata_2024-04.parquet", {"payment_type": 9}, {"payment_type": 77})
    run = lambda: ingest_incremental(spark, str(src), dst, checkpoint, quarantine=aside).collect()
    counted = lambda: {r[0]: r[1] for r in spark.read.parquet(dst).groupBy("source_file").count().collect()}
    faults = {(r["source_file"], (r["file_name"] or "").rsplit("/", 1)[-1], r["rule"], r["column"]) for r in run()}
    assert faults == {(JAN, "b.parquet", "missing_column", "extra"), ("yellow_tripdata_2024-04.parquet", "", "unknown_code", "payment_type")}
    assert counted() == {FEB: 2, "yellow_tripdata_2024-03.parquet": 1}
    assert {r["source_file"] for r in run()} == {JAN, "yellow_tripdata_2024-04.parquet"}

    save(src / FEB, in_february(), in_february(), in_february())
    spark.catalog.refreshByPath(str(src))
    replaced = [r for r in run() if r["rule"] == "replaced_file"]
    assert [r["source_file"] for r in replaced] == [FEB] and "bytes" in replaced[0]["detail"]
    assert counted() == {FEB: 2, "yellow_tripdata_2024-03.parquet": 1}


def test_sweep_keeps_what_is_pointed_to_or_young(spark, tmp_path):
    path, out = save(tmp_path / JAN, {}), str(tmp_path / "out")
    halves = transform_trips(source.read_trips(spark, path), 2024, 1, JAN, NOW)
    first = sinks.write_outputs(*halves, out, JAN)
    for _ in range(9):
        last = sinks.write_outputs(*halves, out, JAN)
    runs = lambda: sorted(p.name for p in (tmp_path / "out" / "runs").iterdir())
    # The first sweep only marks: a reader of an older run has its time.
    assert sinks.sweep(spark, out, 1.0, time.time() + 7200) == [] and len(runs()) == 10
    assert spark.read.parquet(first["processed"]).count() == 1
    assert sinks.sweep(spark, out, 1.0, time.time() + 7200 + 1800) == []
    # A run in progress, written to just now, stays whatever its mark says.
    (tmp_path / "out" / "runs" / "young").mkdir()
    later = time.time() + 7200 + 3601
    os.utime(tmp_path / "out" / "runs" / "young", (later, later))
    assert len(sinks.sweep(spark, out, 1.0, later)) == 9
    assert len(runs()) == 2 and "young" in runs()
    assert spark.read.parquet(sinks.current(spark, out, JAN)["processed"]).count() == 1 and sinks.current(spark, out, JAN) == last


def test_positions_over_several_part_files(spark, tmp_path):
    (tmp_path / JAN).mkdir()
    save(tmp_path / JAN / "b.parquet", FLEX, {}, {})
    save(tmp_path / JAN / "a.parquet", {}, {}, FLEX)
    placed = source.with_month_position(source.read_month(spark, str(tmp_path / JAN)))
    assert sorted(r["month_position"] for r in placed.collect()) == list(range(6))
    row = segment_contiguity(placed, "month_position", "source_file").first()
    assert (row["first_position"], row["last_position"], row["segment_rows"], row["contiguous"]) == (2, 3, 2, True)


def test_two_hundred_and_forty_months_are_one_short_plan(spark, tmp_path):
    for year in range(2005, 2025):
        for month in range(1, 13):
            save(tmp_path / f"yellow_tripdata_{year}-{month:02}.parquet", {})
    paths = source.month_paths(spark, str(tmp_path))
    source.month_schemas(spark, paths[:2])
    started = time.perf_counter()
    schemas = source.month_schemas(spark, paths)
    years = source.read_alike(spark, schemas, lambda p: source.reporting_period(source.base_name(p))[0])
    plan = source.read_alike(spark, schemas)[None]._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - started < 15
    assert len(paths) == 240 and plan.count("FileScan") == 1 and len(years) == 20

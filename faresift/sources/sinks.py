"""Writing the outputs of cleaned months.

Every run writes into a folder of its own and nothing there is ever moved. What is current for a source
is said by one small pointer file, replaced as the last step, after the counts of what was really
written reconcile. A run that dies at any point leaves the pointer, and so both halves and the report, as
they were. Executors lost on the way only cost retries: each write is one Spark commit.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift.session import hadoop_path

HALVES = ("processed", "rejected")
# Files a task keeps open while it writes a half. Spark deals at most 32 files to a task (128 MB, each counted 4 MB larger).
OPEN_FILES = 32
QUALITY_SCHEMA = "metric string, count bigint, percentage_of_raw double"


def new_run(out: str) -> str:
    return f"{out.rstrip('/')}/runs/{uuid.uuid4().hex}"


def _pointer(out: str, source_file: str) -> str:
    return f"{out.rstrip('/')}/current/{source_file}.json"


def current(spark: SparkSession, out: str, source_file: str) -> dict[str, str]:
    """Paths of both halves and the quality report of a source; empty if it has none yet."""
    place, fs = hadoop_path(spark, _pointer(out, source_file))
    if not fs.exists(place):
        return {}
    return json.loads(_text(fs, place))


def finished_sources(spark: SparkSession, out: str) -> DataFrame:
    """(file_name): sources with a finished result, from a listing of the pointers."""
    pattern, fs = hadoop_path(spark, _pointer(out, "*"))
    names = [s.getPath().getName().removesuffix(".json") for s in fs.globStatus(pattern) or []]
    return spark.createDataFrame([(n,) for n in names], "file_name string")


def point_to(spark: SparkSession, out: str, source_file: str, paths: dict[str, str]) -> None:
    """Make these paths the current result of a source: written aside, then renamed over the pointer."""
    place, fs = hadoop_path(spark, _pointer(out, source_file))
    aside, _ = hadoop_path(spark, f"{_pointer(out, source_file)}.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(paths).encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri()).rename(aside, place, over)


def drop_run(spark: SparkSession, run: str) -> None:
    place, fs = hadoop_path(spark, run)
    fs.delete(place, True)


def _last_change(fs, place) -> int:
    """Latest time, in milliseconds, at which anything below a folder was written."""
    latest, files = fs.getFileStatus(place).getModificationTime(), fs.listFiles(place, True)
    while files.hasNext():
        latest = max(latest, files.next().getModificationTime())
    return latest


def sweep(spark: SparkSession, out: str, min_age_hours: float = 168.0, now: float | None = None) -> list[str]:
    """Remove runs that no source points to any more; returns the paths removed.

    Mark and sweep: a run that is met without a pointer is marked, and goes when a later call finds it still
    without one and both its mark and its last write are older than ``min_age_hours``. So whoever read the pointer before it
    moved has that long to finish, and so has a run in progress between two of its writes. A run that is pointed to
    again loses its mark. ``now`` is the clock in seconds, for tests.
    """
    now = time.time() if now is None else now
    root = out.rstrip("/")
    runs, fs = hadoop_path(spark, f"{root}/runs")
    if not fs.exists(runs):
        return []
    pointers, _ = hadoop_path(spark, _pointer(out, "*"))
    pointed = set()
    for status in fs.globStatus(pointers) or []:
        for path in current(spark, out, status.getPath().getName().removesuffix(".json")).values():
            pointed.add(path.partition("/runs/")[2].partition("/")[0])
    removed = []
    for status in fs.listStatus(runs):
        place, name = status.getPath(), status.getPath().getName()
        mark, _ = hadoop_path(spark, f"{root}/unused/{name}")
        if name in pointed:
            if fs.exists(mark):
                fs.delete(mark, False)
            continue
        if not fs.exists(mark):
            stream = fs.create(mark, True)
            try:
                stream.write(bytearray(str(now).encode()))
            finally:
                stream.close()
        marked = float(_text(fs, mark))
        if min(now - marked, now - _last_change(fs, place) / 1000) >= min_age_hours * 3600:
            fs.delete(place, True)
            fs.delete(mark, False)
            removed.append(f"{root}/runs/{name}")
    return removed


def _text(fs, place) -> str:
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_empty(spark: SparkSession, like: DataFrame, path: str) -> str:
    """A file without rows in the schema of a frame, for a half that got none."""
    spark.createDataFrame([], like.schema).coalesce(1).write.parquet(path)
    return path


def write_half(half: DataFrame, path: str) -> None:
    """Write one half with a folder per source file, without a shuffle and without a sort.

    A task only writes the rows it read, so a month of any size is written by as many tasks as
    read it, each with a file open per source it meets. Only a task that meets more than OPEN_FILES sorts the rest of
    its rows by source, as Spark would sort all rows of every task. The folder column is a copy: ``source_file``
    itself stays in the files.
    """
    conf, name = half.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name, "0")
    conf.set(name, str(max(int(before), OPEN_FILES)))
    try:
        half.withColumn("_source", F.col("source_file")).write.partitionBy("_source").parquet(path)
    finally:
        conf.set(name, before)


def source_folder(path: str, source_file: str) -> str:
    """Folder of a source below a half; names of months need no escapes."""
    return f"{path}/_source={source_file}"


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = hadoop_path(spark, path)
    return fs.exists(place)


def write_outputs(processed: DataFrame, rejected: DataFrame, out: str, source_file: str) -> dict[str, str]:
    """Write both halves of one month as its current result; no rows leave an empty file with the schema."""
    run = new_run(out)
    paths = {half: f"{run}/{half}" for half in HALVES}
    for half, rows in zip(HALVES, (processed, rejected)):
        rows.write.parquet(paths[half])
    point_to(processed.sparkSession, out, source_file, paths)
    return paths


def _report(summary: DataFrame) -> DataFrame:
    return summary.select("metric", *[c for c in summary.columns if c != "metric"]).coalesce(1)


def write_quality(summary: DataFrame, path: str) -> None:
    """Write a quality report (a fixed number of rows) as one CSV part with a header, metric first."""
    _report(summary).write.mode("overwrite").option("header", True).csv(path)


def write_quality_reports(summaries: DataFrame, path: str) -> None:
    """Write the quality reports of many sources in one job, a folder per source file."""
    named = summaries.withColumnRenamed("source_file", "_source")
    _report(named).write.partitionBy("_source").option("header", True).csv(path)

"""Cleaning jobs: one month, or every month of a folder in one pass."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import ntz, union_all
from faresift.operators.cleaning import session_clock, transform_many, transform_trips, untrusted_pickup
from faresift.operators.gate import refuse_faults, unknown_codes, validate_source
from faresift.operators.quality import flag_aggregates, quality_by_source, reconcile, summary_rows
from faresift.sources import landing, sinks
from faresift.sources.trips import (
    base_name,
    month_paths,
    month_schemas,
    read_alike,
    read_month,
    reporting_period,
    require_source,
)

POINTER_WRITERS = 8


def clean_month(
    spark: SparkSession, path: str, out: str, processing_time: datetime | str | None = None
) -> DataFrame:
    """Check, clean and write one month; returns its quality summary.

    The scan and both sinks count their own rows while they are written, and the flags are
    counted by the same write, so the summary costs no further pass. The results become
    current only when the three counts agree and the report is written.
    """
    source_file = base_name(path)
    require_source(spark, path)
    year, month = reporting_period(source_file)
    month_schemas(spark, [path])
    raw = read_month(spark, path)
    validate_source(raw)

    processed, rejected = transform_trips(raw, year, month, source_file, processing_time)
    rows = F.count(F.lit(1))
    seen = {half: Observation(half) for half in sinks.HALVES}
    run = sinks.new_run(out)
    paths = {name: f"{run}/{name}" for name in (*sinks.HALVES, "quality")}
    try:
        processed.observe(seen["processed"], rows.alias("processed_rows"), *flag_aggregates()).write.parquet(
            paths["processed"]
        )
        # The rejects are filtered in the scan by pickup, so this pass skips most row groups.
        rejected.observe(seen["rejected"], rows.alias("rejected_rows")).write.parquet(paths["rejected"])
        counts = {"raw_rows": raw.count(), **seen["processed"].get, **seen["rejected"].get}
        reconcile(counts["raw_rows"], counts["processed_rows"], counts["rejected_rows"])
        summary = summary_rows(
            spark.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])
        )
        sinks.write_quality(summary, paths["quality"])
        sinks.point_to(spark, out, source_file, paths)
    except Exception:
        sinks.drop_run(spark, run)
        raise
    return summary


def clean_months(
    spark: SparkSession,
    folder: str,
    out: str,
    processing_time: datetime | str | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Check, clean and write the months of a folder; returns the quality summary per source file.

    ``only`` names the months to take, by default all. Months of one schema are one scan, whose rows get the bounds
    of their month from a row per file; rejects are scanned year by year, so that literal bounds on the pickup
    reach the files. Each half is written by one job, without a shuffle. The summary is counted on the written files
    themselves, from their flag columns and footers, and reconciled per source file before any source is
    pointed to its new result.
    """
    wanted = [p for p in month_paths(spark, folder) if only is None or base_name(p) in only]
    schemas = month_schemas(spark, wanted)
    periods = {base_name(p): reporting_period(base_name(p)) for p in wanted}
    sources = list(periods)
    raw = read_alike(spark, schemas)[None]
    codes = unknown_codes(raw.select(*S.CODE_DOMAINS))
    refuse_faults(codes.select(F.lit("unknown_code").alias("rule"), "column", F.col("value").alias("detail")))

    now = processing_time or session_clock(spark)
    shape = "source_file string, reporting_year int, reporting_month int"
    listed = spark.createDataFrame([(source, *period) for source, period in periods.items()], shape)
    processed, _ = transform_many(raw, listed, now)
    rejects = []
    for year, months in read_alike(spark, schemas, lambda p: periods[base_name(p)][0]).items():
        # What any month of the year may reject; the year's own pickups lie outside.
        last = max(month for y, month in periods.values() if y == year)
        rejects.append(transform_many(months.where(untrusted_pickup(ntz(datetime(year - 1, last, 1)), ntz(now))), listed, now)[1])
    rejected = union_all(rejects)
    raw = raw.select("source_file")
    run = sinks.new_run(out)
    try:
        written = {}
        for half, rows in zip(sinks.HALVES, (processed, rejected)):
            sinks.write_half(rows, f"{run}/{half}")
            written[half] = spark.read.schema(rows.schema).parquet(f"{run}/{half}")
        summary = quality_by_source(written["processed"], written["rejected"], raw)
        rows = summary.collect()  # seventeen rows per source file
        result = spark.createDataFrame(rows, summary.schema)
        empty = sorted(set(sources) - {r["source_file"] for r in rows})
        if empty:
            raise ValueError(f"Months without rows, empty: {empty}")
        sinks.write_quality_reports(result, f"{run}/quality")
        none = {
            half: sinks.write_empty(spark, like, f"{run}/none_{half}")
            for half, like in zip(sinks.HALVES, (processed, rejected))
            if any(r["metric"] == f"{half}_rows" and not r["count"] for r in rows)
        }
        counts = {(r["source_file"], r["metric"]): r["count"] for r in rows}

        def point(source: str) -> None:
            paths = {
                half: sinks.source_folder(f"{run}/{half}", source) if counts[source, f"{half}_rows"] else none[half]
                for half in sinks.HALVES
            }
            sinks.point_to(spark, out, source, {**paths, "quality": sinks.source_folder(f"{run}/quality", source)})

        with ThreadPoolExecutor(POINTER_WRITERS) as pool:
            list(pool.map(point, sources))
    except Exception:
        # Sources already pointed to this run keep it.
        if not any(run in p for s in sources for p in sinks.current(spark, out, s).values()):
            sinks.drop_run(spark, run)
        raise
    return result


def clean_new_months(
    spark: SparkSession, folder: str, out: str, processing_time: datetime | str | None = None
) -> DataFrame | None:
    """Clean only the months of a folder that have no finished result yet; None if there are none.

    What is finished is read off the pointers, not off the data.
    """
    names = [(base_name(p),) for p in month_paths(spark, folder)]
    listing = spark.createDataFrame(names, "file_name string")
    pending = landing.pending_files(listing, sinks.finished_sources(spark, out))
    new = sorted(r["file_name"] for r in pending.collect())  # a name per month
    return clean_months(spark, folder, out, processing_time, new) if new else None

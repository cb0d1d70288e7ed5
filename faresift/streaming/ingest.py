"""Retry-safe landing of monthly files: a stream of file names, whose new files are checked and landed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.operators.gate import refuse_faults, unknown_codes
from faresift.session import hadoop_path
from faresift.sources.landing import pending_files
from faresift.sources.trips import describe_faults, file_schemas, read_alike, schema_faults, source_name

FILES_PER_BATCH = 1000
LEDGER = "file_name string, batch bigint, length bigint, modified timestamp, landed boolean"
FAULTS = "source_file string, file_name string, rule string, column string, detail string"


@dataclass(frozen=True)
class _File:
    name: str
    month: str
    length: int
    modified: datetime


def file_stream(spark: SparkSession, src: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(file_name, source_file, length, modified) of new monthly files, or part files of monthly folders; contents are not read."""
    found = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.parquet")
        .load(f"{src.rstrip('/')}/{S.FILE_PREFIX}*.parquet")
    )
    return _files(found)


def _files(found: DataFrame) -> DataFrame:
    modified = F.col("modificationTime").alias("modified")
    return found.select(F.col("path").alias("file_name"), source_name(F.col("path")).alias("source_file"), "length", modified)


def _table(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """The table in a folder, empty before its first row is written; columns it lacks are null."""
    place, fs = hadoop_path(spark, path)
    return spark.read.schema(shape).parquet(path) if fs.exists(place) else spark.createDataFrame([], shape)


def _ledger_root(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/landed_files"


def replaced_files(spark: SparkSession, src: str, checkpoint: str) -> DataFrame:
    """(source_file, file_name, rule, column, detail) of files whose length or time differs from when they were taken.

    A stream takes a name once, so a file that was replaced under its name is not taken again. It is listed
    here instead: what was landed from its earlier content is still there.
    """
    place, fs = hadoop_path(spark, f"{src.rstrip('/')}/{S.FILE_PREFIX}*.parquet")
    if not fs.globStatus(place):
        return spark.createDataFrame([], FAULTS)
    now = _files(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(place.toString()))
    taken = _table(spark, _ledger_root(checkpoint), LEDGER).where(F.col("length").isNotNull())
    taken = taken.select("file_name", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    changed = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
    said = F.format_string("taken with %d bytes, has %d now", F.col("_length"), F.col("length"))
    return now.join(taken, "file_name").where(changed).select(
        "source_file", "file_name", F.lit("replaced_file").alias("rule"), F.lit(None).cast("string").alias("column"), said.alias("detail")
    )


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """(source_file, file_name, rule, column, detail): every fault of the months set aside so far."""
    return _table(spark, f"{quarantine.rstrip('/')}/faults", FAULTS).drop("batch")


def ingest_incremental(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
    quarantine: str | None = None,
) -> DataFrame:
    """Land every monthly file that was not landed yet, once, and return when all are in.

    The stream's checkpoint remembers the files taken. Each batch of new files is checked (the schema of every
    file, code domains), cast to the source schema and written to a folder of its own, which a retry
    overwrites; a ledger of the files taken, written after it, keeps a file that shows up again from
    being landed twice. Files landed before are not opened. The checkpoint must lie in storage that outlives the executors.

    Without ``quarantine`` a month that breaks a rule stops the run and is named; earlier batches stay. With it, the new
    files of such a month are set aside: they stay where they are, their faults are listed below that folder,
    the ledger has them as not landed, and the other months land. The result lists, as ``FAULTS``, what was set
    aside so far and files replaced since they were taken.
    """
    ledger_root = _ledger_root(checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        ledger = _table(session, ledger_root, LEDGER)
        new = pending_files(batch, ledger.where(F.col("batch") != batch_id))
        # At most files_per_batch names.
        files = [_File(r["file_name"], r["source_file"], r["length"], r["modified"]) for r in new.collect()]
        if not files:
            return
        schemas = file_schemas(session, [f.name for f in files])
        months = {f.month: {} for f in files}
        for f in files:
            months[f.month][f.name] = schemas[f.name]
        faults = schema_faults(months)
        if faults and not quarantine:
            raise ValueError(f"Not landed for {len(faults)} schema faults: {describe_faults(faults)}")
        bad = {month for month, *_ in faults}
        sound = {name: schema for name, schema in schemas.items() if not any(name in months[m] for m in bad)}
        rows = read_alike(session, sound)[None] if sound else None
        if rows is not None:
            codes = unknown_codes(rows, None, "source_file")
            if quarantine:
                # A row per month, column and odd code met; the months are known by name to the driver.
                codes = codes.groupBy("source_file", "column").agg(
                    F.count(F.lit(1)).alias("codes"), F.min("value").alias("value")
                )
                found = codes.collect()
                said = lambda r: f"{r['codes']} unknown codes, such as {r['value']}"
                faults += [(r["source_file"], None, "unknown_code", r["column"], said(r)) for r in found]
                odd = {r["source_file"] for r in found}
                bad |= odd
                sound = {name: schema for name, schema in sound.items() if not any(name in months[m] for m in odd)}
                rows = read_alike(session, sound)[None] if sound and odd else rows if sound else None
            else:
                named = F.concat_ws(" ", "source_file", "column").alias("column")
                refuse_faults(codes.select(F.lit("unknown_code").alias("rule"), named, F.col("value").alias("detail")))
        if faults:
            listed = session.createDataFrame(faults, FAULTS)
            listed.coalesce(1).write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/faults/batch={batch_id}")
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{dst.rstrip('/')}/batch={batch_id}")
        names = [(f.name, f.length, f.modified, f.month not in bad) for f in files]
        taken = session.createDataFrame(names, "file_name string, length bigint, modified timestamp, landed boolean")
        taken.coalesce(1).write.mode("overwrite").parquet(f"{ledger_root}/batch={batch_id}")

    query = (
        file_stream(spark, src, files_per_batch)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    replaced = replaced_files(spark, src, checkpoint)
    return quarantined(spark, quarantine).unionByName(replaced) if quarantine else replaced

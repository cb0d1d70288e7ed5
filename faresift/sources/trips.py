"""Reading monthly trip files: one month, a folder of months, lineage and reporting period.

A month is a Parquet file ``yellow_tripdata_YYYY-MM.parquet`` or a Parquet folder of that name
as Spark writes it. Its name is the ``source_file`` of its rows in both cases.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faresift import schema as S
from faresift.functions.scalars import union_all
from faresift.operators.cleaning import check_month
from faresift.operators.gate import part_violations
from faresift.session import hadoop_path

FOOTER_READERS = 16
FAULTS_SAID = 20


def require_source(spark: SparkSession, path: str) -> None:
    """Raise if the path does not exist or holds no bytes."""
    place, fs = hadoop_path(spark, path)
    if not fs.exists(place):
        raise FileNotFoundError(f"Source not found: {path}")
    if fs.getContentSummary(place).getLength() == 0:
        raise ValueError(f"Source is empty: {path}")


def month_paths(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all months in a folder in name order; none is an error."""
    pattern, fs = hadoop_path(spark, f"{folder.rstrip('/')}/{S.FILE_PREFIX}*.parquet")
    found = sorted(status.getPath().toString() for status in fs.globStatus(pattern) or [])
    if not found:
        raise FileNotFoundError(f"No {S.FILE_PREFIX}*.parquet in {folder}")
    return found


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def source_name(path: Column) -> Column:
    """Name of the month a file belongs to: its folder if that is named like Parquet, else itself."""
    tail = F.substring_index(path, "/", -2)
    return F.when(tail.contains(".parquet/"), F.substring_index(tail, "/", 1)).otherwise(
        F.substring_index(tail, "/", -1)
    )


def with_lineage(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Add ``source_file``: the given name, or else the name of the file each row was read from."""
    name = F.lit(source_file) if source_file else source_name(F.col("_metadata.file_path"))
    return df.withColumn("source_file", name)


def with_position(df: DataFrame) -> DataFrame:
    """Add ``source_path`` and ``row_position``, the place of each row in its physical file."""
    return df.withColumns(
        {"source_path": F.col("_metadata.file_path"), "row_position": F.col("_metadata.row_index")}
    )


def with_month_position(df: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``month_position``, the place of each row in its month over all its part files in name order.

    The rows before a part are summed up over one row per part file.
    """
    path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    placed = df.withColumns({"source_file": source_name(path), "_path": path, "_index": index})
    parts = placed.groupBy("source_file", F.col("_path").alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source_file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("bigint")).alias("_ahead"))
    found = placed.join(ahead, F.col("_path") == F.col("_part"))
    return found.withColumn("month_position", F.col("_ahead") + F.col("_index")).drop("_path", "_part", "_index", "_ahead")


def first_rows(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First ``n`` rows of a month by the place in its files; no column is read to find the places."""
    placed = with_position(spark.read.parquet(path)).where(F.col("_metadata.row_index") < n)
    return settle(placed.orderBy("source_path", "row_position").limit(n).drop("source_path", "row_position"))


def with_reporting_period(df: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``reporting_year`` and ``reporting_month`` read off ``source_file``.

    The whole name must match. A row from another file fails the query if ``strict``, and
    otherwise has nulls, to be listed as a violation. Meant for small frames with a row per
    file; rows of trips get their period by a lookup of these (see ``transform_many``).
    """
    name = F.col("source_file")
    part = lambda i: F.nullif(F.regexp_extract(name, S.FILE_NAME_REGEX, i), F.lit("")).cast("int")
    month = part(2)
    fits = F.coalesce(month.between(1, 12), F.lit(False))
    unfit = F.raise_error(F.concat(F.lit("Expected a name like yellow_tripdata_2024-01.parquet, got: "), name))
    otherwise = unfit.cast("int") if strict else F.lit(None).cast("int")
    return df.withColumns(
        {
            "reporting_year": F.when(fits, part(1)).otherwise(otherwise),
            "reporting_month": F.when(fits, month).otherwise(otherwise),
        }
    )


def reporting_period(file_name: str) -> tuple[int, int]:
    """Year and month of one file name."""
    match = re.fullmatch(S.FILE_NAME_REGEX, file_name)
    if match is None:
        raise ValueError(f"Expected a name like yellow_tripdata_2024-01.parquet, got: {file_name}")
    year, month = int(match[1]), int(match[2])
    check_month(month)
    return year, month


def _settle(field: T.StructField) -> Column:
    """The column as the engine expects it: NaN as null, zoned timestamps as their UTC clock reading."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast(field.dataType)).alias(field.name)
    if isinstance(field.dataType, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(column), epoch).alias(field.name)
    return column


def settle(df: DataFrame) -> DataFrame:
    return df.select(*[_settle(f) for f in df.schema.fields])


def read_month(spark: SparkSession, path: str) -> DataFrame:
    """One month with the columns and types of its file, for the gate to judge."""
    return settle(_whole_schema(spark, path))


def _whole_schema(spark: SparkSession, path: str) -> DataFrame:
    """A month with every column that any of its part files has; Spark reads all their footers in a job.

    A folder's first footer alone would hide an extra column in another part.
    """
    return spark.read.option("mergeSchema", True).parquet(path)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the data files of a month in name order: the file itself, or those of its folder."""
    place, fs = hadoop_path(spark, path)
    if fs.getFileStatus(place).isFile():
        return [path]
    data = lambda s: s.isFile() and s.getLen() and s.getPath().getName()[0] not in "_."
    return sorted(s.getPath().toString() for s in fs.listStatus(place) if data(s))


def file_schemas(spark: SparkSession, files: list[str]) -> dict[str, T.StructType]:
    """The schema of each file's own footer, read by small Spark jobs side by side."""
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        return dict(zip(files, pool.map(lambda f: spark.read.parquet(f).schema, files), strict=True))


def schema_faults(schemas: dict[str, dict[str, T.StructType]]) -> list[tuple[str, str, str, str, str]]:
    """(month, file, rule, column, detail) over the part files of each month."""
    return [(month, *fault) for month, parts in schemas.items() for fault in part_violations(parts)]


def describe_faults(faults: list[tuple[str, str, str, str, str]]) -> str:
    """The faults as one line, each with its month and, of several parts, the file; the first FAULTS_SAID of them."""
    place = lambda month, file: month if base_name(file) == month else f"{month}/{base_name(file)}"
    said = [f"{place(month, file)}: {rule} {column}" for month, file, rule, column, _ in faults[:FAULTS_SAID]]
    return "; ".join(said) + (f"; {len(faults) - FAULTS_SAID} more" if len(faults) > FAULTS_SAID else "")


def month_schemas(spark: SparkSession, paths: list[str]) -> dict[str, T.StructType]:
    """The schema of each month by its path; months with a part file that breaks the rules are refused by name."""
    parts = {p: part_files(spark, p) for p in paths}
    known = file_schemas(spark, [f for own in parts.values() for f in own])
    faults = schema_faults({base_name(p): {f: known[f] for f in own} for p, own in parts.items()})
    if faults:
        raise ValueError(f"Refused for {len(faults)} schema faults: {describe_faults(faults)}")
    empty = [base_name(p) for p, own in parts.items() if not own]
    if empty:
        raise ValueError(f"Months without data files: {empty}")
    return {p: known[own[0]] for p, own in parts.items()}


def read_alike(spark: SparkSession, schemas: dict[str, T.StructType], group: Callable[[str], object] = lambda p: None) -> dict[object, DataFrame]:
    """Months in the types of the source schema with ``source_file``, by what ``group`` says of their path.

    Months of one schema are one scan, however many; the name comes from the path of each file.
    """
    alike: dict[tuple, list[str]] = {}
    for path, schema in schemas.items():
        alike.setdefault((group(path), tuple(sorted((f.name, f.dataType.simpleString()) for f in schema.fields))), []).append(path)
    found: dict[object, list[DataFrame]] = {}
    for (key, _), paths in alike.items():
        df = settle(spark.read.schema(schemas[paths[0]]).parquet(*paths))
        found.setdefault(key, []).append(typed(df, source_name(F.col("_metadata.file_path")).alias("source_file")))
    return {key: union_all(frames) for key, frames in found.items()}


def typed(df: DataFrame, *more: Column) -> DataFrame:
    """A month in the types of the source schema, to be united with others."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRIP_SCHEMA.fields], *more)


def read_months(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many months as one frame with ``source_file``, in the types of the source schema; see ``read_alike``."""
    return read_alike(spark, month_schemas(spark, paths))[None]


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """One month (the 19 columns), or every month of a folder (with ``source_file`` as well)."""
    if path.rstrip("/").endswith(".parquet"):
        require_source(spark, path)
        return read_month(spark, path)
    return read_months(spark, month_paths(spark, path))


def file_inventory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per source: files, bytes, MB of 1024² bytes, rows, and whether it is empty.

    Sizes come from the listing, rows from footers; no data column is read. Spark passes over
    files without a byte, so the sources asked for are listed by name and the rest is joined on.
    """
    name = source_name(F.col("_metadata.file_path")).alias("source_file")
    named = spark.range(1).select(F.explode(F.array(*[F.lit(base_name(p)) for p in paths])).alias("source_file"))
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(paths)
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size_bytes"))
    )
    rows = spark.read.schema(S.TRIP_SCHEMA).parquet(*paths).groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return (
        named.join(listed, "source_file", "left")
        .join(rows, "source_file", "left")
        .select("source_file", none("files"), none("size_bytes"), none("rows"))
        .withColumns({"size_mb": F.col("size_bytes") / F.lit(1024.0 * 1024.0), "is_empty": F.col("size_bytes") == 0})
    )

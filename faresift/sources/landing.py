"""Which months are still to be landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of the listing that the ledger does not name, each once (both have ``file_name``)."""
    return listing.join(ledger.select("file_name"), "file_name", "left_anti").dropDuplicates(["file_name"])


def file_name_of(month_start: Column) -> Column:
    """Name of the file of a month, from any date or timestamp in it."""
    return F.concat(F.lit(S.FILE_PREFIX), F.date_format(month_start, "yyyy-MM"), F.lit(".parquet"))


def expected_months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(file_name, month) for every month from ``start`` to ``end``, both 'YYYY-MM' and included."""
    first, last = (F.lit(f"{m}-01").cast("date") for m in (start, end))
    months = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month")
    return spark.range(1).select(months).select(file_name_of(F.col("month")).alias("file_name"), "month")


def missing_months(spark: SparkSession, start: str, end: str, ledger: DataFrame) -> DataFrame:
    """Expected months whose file the ledger does not name."""
    return pending_files(expected_months(spark, start, end), ledger)


def landed_files(landed: DataFrame) -> DataFrame:
    """Ledger of a landed table: the distinct names of the files its rows came from."""
    return landed.select(F.col("source_file").alias("file_name")).distinct()

"""Row rules: trusted-timestamp split, measures and quality flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import holds, minutes_between, month_start, ntz, plus_months, speed_mph


def session_clock(spark: SparkSession) -> str:
    """The session's wall clock as text.

    Read once per job. Left to the plan it would be read anew by each action, and a pickup
    between two readings could miss both outputs.
    """
    return spark.sql("SELECT CAST(localtimestamp() AS STRING)").first()[0]


def resolve_processing_time(spark: SparkSession, processing_time: datetime | str | None = None) -> Column:
    """Processing time as a wall-clock literal, by default now."""
    return ntz(processing_time if processing_time is not None else session_clock(spark))


def period_bounds(year: Column, month: Column) -> dict[str, Column]:
    """First instant of the month, of the next month, and of the trusted range a year before."""
    start = month_start(year, month)
    return {
        "reporting_start": start,
        "reporting_end": plus_months(start, 1),
        "trusted_start": plus_months(start, -12),
    }


def check_month(month: int) -> None:
    if not 1 <= month <= 12:
        raise ValueError(f"reporting month must lie between 1 and 12, got {month}")


def untrusted_pickup(trusted_start: Column, processing_time: Column) -> Column:
    """Never null, so that it and its negation split the rows without loss.

    The pickup column stands bare on one side of each comparison: with literal bounds both
    this filter and its negation reach the Parquet scan.
    """
    pickup = F.col(S.PICKUP)
    return pickup.isNull() | (pickup < trusted_start) | (pickup > processing_time)


def measures() -> dict[str, Column]:
    duration = minutes_between(F.col(S.PICKUP), F.col(S.DROPOFF))
    return {S.DURATION: duration, S.SPEED: speed_mph(F.col("trip_distance"), duration)}


def flag_conditions(start: Column, end: Column) -> dict[str, Column]:
    """The quality flags over a frame that already has both measures."""
    pickup, minutes, miles = F.col(S.PICKUP), F.col(S.DURATION), F.col("trip_distance")
    # Each sign is settled before the two are compared: a missing amount is not negative.
    fare_below, total_below = holds(F.col("fare_amount") < 0), holds(F.col("total_amount") < 0)
    return {
        "is_flex_fare_record": holds(F.col("payment_type") == S.FLEX_PAYMENT),
        "is_unknown_ratecode": holds(F.col("RatecodeID") == S.UNKNOWN_RATECODE),
        "is_negative_transaction": total_below,
        "has_amount_sign_mismatch": fare_below != total_below,
        "is_outside_reporting_month": ~holds((pickup >= start) & (pickup < end)),
        "has_nonpositive_duration": holds(minutes <= 0),
        "has_suspicious_long_duration": holds((minutes > S.LONG_MINUTES) & (minutes < S.NEAR_DAY_MINUTES)),
        "has_near_24h_duration": holds((minutes >= S.NEAR_DAY_MINUTES) & (minutes < S.DAY_MINUTES)),
        "has_extreme_duration": holds(minutes >= S.DAY_MINUTES),
        "has_negative_distance": holds(miles < 0),
        "has_zero_distance": holds(miles == 0),
        "has_extreme_distance": holds(miles > S.EXTREME_MILES),
        "has_implausible_speed": holds(F.col(S.SPEED) > S.IMPLAUSIBLE_MPH),
        "has_zero_passengers": holds(F.col("passenger_count") == 0),
    }


def _output_order() -> list[str]:
    flags = S.QUALITY_FLAGS
    return [*flags[:5], S.DURATION, *flags[5:12], S.SPEED, *flags[12:]]


def split_trips(
    df: DataFrame, start: Column, end: Column, trusted_start: Column, processing_time: Column
) -> tuple[DataFrame, DataFrame]:
    """(processed, rejected) for rows that already carry ``source_file``.

    The bounds may be literals (one month) or columns (many months in one scan); columns of
    ``df`` beyond the trip columns and ``source_file`` are left out of both results.
    """
    base = [*S.TRIP_COLUMNS, "source_file"]
    untrusted = untrusted_pickup(trusted_start, processing_time)
    rejected = df.where(untrusted).select(*base, F.lit(S.REJECTION_REASON).alias("rejection_reason"))
    flags = flag_conditions(start, end)
    processed = (
        df.where(~untrusted)
        .withColumns(measures())
        .select(*base, *[flags[c].alias(c) if c in flags else F.col(c) for c in _output_order()])
    )
    return processed, rejected


def transform_trips(
    df: DataFrame,
    year: int,
    month: int,
    source_file: str,
    processing_time: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Clean one month: (processed, rejected), complements of each other."""
    check_month(month)
    first = datetime(year, month, 1)
    following = datetime(year + month // 12, month % 12 + 1, 1)
    return split_trips(
        df.withColumn("source_file", F.lit(source_file)),
        ntz(first),
        ntz(following),
        ntz(first.replace(year=year - 1)),
        resolve_processing_time(df.sparkSession, processing_time),
    )


def transform_many(
    df: DataFrame, periods: DataFrame, processing_time: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Clean rows of any number of months in one scan.

    ``df`` carries ``source_file`` next to the trip columns; ``periods`` names the ``reporting_year`` and
    ``reporting_month`` of each source file. It is brought to one row per file, and a file with two
    periods fails the query, as does a trip of an unlisted file; so no trip is ever multiplied or lost.
    The lookup is broadcast: it has one short row per source file, and a join by shuffle would bring all trips of a
    file to one task.
    """
    period = F.collect_set(F.struct("reporting_year", "reporting_month"))
    twice = F.raise_error(F.concat(F.lit("Several reporting periods for "), F.col("source_file")))
    single = periods.groupBy("source_file").agg(period.alias("p")).select(
        "source_file",
        F.when(F.size("p") == 1, F.get("p", 0)).otherwise(
            twice.cast("struct<reporting_year:int,reporting_month:int>")
        ).alias("p"),
    )
    bounds = period_bounds(F.col("p.reporting_year"), F.col("p.reporting_month"))
    lookup = single.select("source_file", *[c.alias(n) for n, c in bounds.items()])
    unlisted = F.raise_error(F.concat(F.lit("No reporting period for "), F.col("source_file"))).cast("timestamp_ntz")
    dated = df.join(F.broadcast(lookup), "source_file", "left")
    return split_trips(
        dated,
        F.col("reporting_start"),
        F.col("reporting_end"),
        F.coalesce(F.col("trusted_start"), unlisted),
        resolve_processing_time(df.sparkSession, processing_time),
    )


def normal_trips(processed: DataFrame) -> DataFrame:
    """Processed rows fit for ordinary duration, distance and speed analysis of their month."""
    excluded = (
        F.col("is_outside_reporting_month")
        | F.col("has_nonpositive_duration")
        | F.col("has_near_24h_duration")
        | F.col("has_extreme_distance")
        | F.col("has_implausible_speed")
    )
    return processed.where(~excluded)

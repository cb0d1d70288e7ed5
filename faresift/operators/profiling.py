"""Profile of a trip table: shape, missing values, distributions, range checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import (
    all_of,
    in_bin,
    minutes_between,
    percent_of,
    seconds_between,
    speed_mph,
    union_all,
)
from faresift.operators.metrics import count_metrics, true_rows, wide_to_rows
from faresift.operators.quantiles import quantile_values


def with_measures(df: DataFrame) -> DataFrame:
    """Duration and speed as the exploratory checks use them: a negative distance keeps its speed."""
    duration = minutes_between(F.col(S.PICKUP), F.col(S.DROPOFF))
    return df.withColumns(
        {S.DURATION: duration, S.SPEED: speed_mph(F.col("trip_distance"), duration, require_nonneg_distance=False)}
    )


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, column_names. The count reads no column."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )


def preview(df: DataFrame, position: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by a position column.

    The position alone is read to find the n-th place; that bound then reaches the scan as a
    filter, so the other columns are read only where the first rows lie.
    """
    first = df.select(position).orderBy(position).limit(n)
    return df.where(F.col(position) <= first.agg(F.max(position)).scalar()).orderBy(position).limit(n)


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing) for the columns that lack values, most first; no rows when nothing is missing."""
    row = df.agg(*[true_rows(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    counted = wide_to_rows(row, df.columns, "column", "missing")
    return counted.where(F.col("missing") > 0).orderBy(F.desc("missing"), "column")


def value_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows) of columns that share a type, missing values counted as one value."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, dtype, missing, missing_pct, unique_including_na) for every column.

    Columns are counted one type at a time, so each is read once and a shuffled record is a
    single value with its count, not a row of the whole table per column. ``approximate``
    replaces the exact distinct counts by sketches in one pass.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if approximate:
        return _sketched_profile(df, types)
    profiles = []
    for dtype in sorted(set(types.values())):
        frequencies = value_frequencies(df, [c for c in df.columns if types[c] == dtype])
        missing = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0).cast("bigint"))
        profiles.append(
            frequencies.groupBy("column").agg(
                F.lit(dtype).alias("dtype"),
                missing.alias("missing"),
                percent_of(missing, F.sum("rows"), 2).alias("missing_pct"),
                F.count(F.lit(1)).alias("unique_including_na"),
            )
        )
    return union_all(profiles)


def _sketched_profile(df: DataFrame, types: dict[str, str]) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggregates += [
            true_rows(F.col(f"`{c}`").isNull()).alias(f"_m{i}"),
            F.approx_count_distinct(F.col(f"`{c}`")).alias(f"_d{i}"),
        ]
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("dtype"),
            F.col(f"_m{i}").alias("missing"),
            percent_of(F.col(f"_m{i}"), F.col("_rows"), 2).alias("missing_pct"),
            (F.col(f"_d{i}") + (F.col(f"_m{i}") > 0).cast("bigint")).alias("unique_including_na"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))


def profile_sketches(df: DataFrame, by: str = "source_file", lg_size: int = 14) -> DataFrame:
    """(by, column, dtype, rows, missing, sketch): what a profile needs of each source, to be kept and united.

    A HyperLogLog sketch of 2**lg_size registers stands for the distinct values, with a standard error of about
    0.83 / sqrt(2**lg_size), 0.65 % by default. A new month costs its own scan and no other.
    """
    fields = [f for f in df.schema.fields if f.name != by]
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        value = F.col(f"`{f.name}`")
        aggregates += [
            true_rows(value.isNull()).alias(f"_m{i}"),
            F.hll_sketch_agg(value.cast("string"), lg_size).alias(f"_s{i}"),
        ]
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("_rows").alias("rows"),
            F.col(f"_m{i}").alias("missing"),
            F.col(f"_s{i}").alias("sketch"),
        )
        for i, f in enumerate(fields)
    ]
    return df.groupBy(by).agg(*aggregates).select(by, F.inline(F.array(*cells)))


def united_profile(sketches: DataFrame) -> DataFrame:
    """(column, dtype, missing, missing_pct, unique_including_na) over the sources of ``profile_sketches``.

    Counts of missing values are exact, distinct values are estimated from the united sketches. A column must have one type.
    """
    missing = F.sum("missing")
    distinct = F.hll_sketch_estimate(F.hll_union_agg("sketch", True)) + (missing > 0).cast("bigint")
    return sketches.groupBy("column", "dtype").agg(
        missing.alias("missing"),
        percent_of(missing, F.sum("rows"), 2).alias("missing_pct"),
        distinct.alias("unique_including_na"),
    )


def percentile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def describe_numeric(
    df: DataFrame, columns: list[str] = S.METRIC_COLUMNS, percentiles: tuple[float, ...] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """(column, count, mean, std, min, percentiles, max), one row per column; exact percentiles.

    The percentiles are settled when this is called and stand in the plan as literals; the rest is one scan.
    """
    found = quantile_values(df, {c: list(percentiles) for c in columns})
    aggregates, cells = [], []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).alias(f"_n{i}"),
            F.avg(x).alias(f"_avg{i}"),
            F.stddev_samp(x).alias(f"_std{i}"),
            F.min(x).alias(f"_min{i}"),
            F.max(x).alias(f"_max{i}"),
        ]
        named = [F.lit(found.get((c, float(p)))).cast("double").alias(percentile_name(p)) for p in percentiles]
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_n{i}").alias("count"),
                F.col(f"_avg{i}").alias("mean"),
                F.col(f"_std{i}").alias("std"),
                F.col(f"_min{i}").alias("min"),
                *named,
                F.col(f"_max{i}").alias("max"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))


def value_counts(
    df: DataFrame,
    value: str | Column,
    keep_nulls: bool = False,
    order: str = "count",
    percent: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """(value, count[, percentage]) by falling count or by value; ties in value order.

    Percentages refer to the rows counted, so to non-null rows unless ``keep_nulls``.
    """
    column = F.col(value) if isinstance(value, str) else value
    counted = df.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if not keep_nulls:
        counted = counted.where(F.col("value").isNotNull())
    if percent:
        # A subquery for the total: a window over everything would gather all values in one task.
        total = counted.agg(F.sum("count")).scalar()
        counted = counted.withColumn("percentage", percent_of(F.col("count"), total, 2))
    ordered = counted.orderBy("value") if order == "value" else counted.orderBy(F.desc("count"), "value")
    return ordered.limit(limit) if limit else ordered


def anomaly_screen(df: DataFrame) -> DataFrame:
    """(condition, count, percentage of all rows) of eight first-look conditions, largest share first."""
    conditions = {
        "trip_distance = 0": F.col("trip_distance") == 0,
        "trip_distance > 100": F.col("trip_distance") > 100,
        "fare_amount < 0": F.col("fare_amount") < 0,
        "total_amount < 0": F.col("total_amount") < 0,
        "tip_amount < 0": F.col("tip_amount") < 0,
        "passenger_count = 0": F.col("passenger_count") == 0,
        "fare_amount = 0": F.col("fare_amount") == 0,
        "total_amount = 0": F.col("total_amount") == 0,
    }
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[true_rows(c).alias(n) for n, c in conditions.items()])
    cells = [
        F.struct(
            F.lit(n).alias("condition"),
            F.col(f"`{n}`").alias("count"),
            percent_of(F.col(f"`{n}`"), F.col("_rows"), 4).alias("percentage"),
        )
        for n in conditions
    ]
    return row.select(F.inline(F.array(*cells))).orderBy(F.desc("percentage"), "condition")


def negative_amounts(df: DataFrame, columns: tuple[str, ...] = ("fare_amount", "total_amount", "tip_amount")) -> DataFrame:
    """(column, negative, rows, min) for each money column."""
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        aggregates += [true_rows(F.col(c) < 0).alias(f"_neg{i}"), F.min(c).alias(f"_min{i}")]
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_neg{i}").alias("negative"),
            F.col("_rows").alias("rows"),
            F.col(f"_min{i}").alias("min"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*cells)))


def period_outliers(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row on the pickups outside the month: rows, first, last, and the years met.

    Sound pickups fall to a filter that reaches the Parquet scan; a missing pickup is not outside.
    """
    pickup = F.col(S.PICKUP)
    years = (
        df.where((pickup < start) | (pickup >= end))
        .groupBy(F.year(S.PICKUP).alias("year"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(S.PICKUP).alias("first"), F.max(S.PICKUP).alias("last"))
    )
    return years.agg(
        F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows"),
        F.min("first").alias("earliest"),
        F.max("last").alias("latest"),
        F.when(F.count("year") > 0, F.array_sort(F.collect_list("year"))).alias("years"),
    )


def distance_profile(df: DataFrame) -> DataFrame:
    """One row: rows at zero, rows above 100 miles, longest distance."""
    miles = F.col("trip_distance")
    return df.agg(
        true_rows(miles == 0).alias("zero_distance"),
        true_rows(miles > S.EXTREME_MILES).alias("over_100_miles"),
        F.max(miles).alias("max_distance"),
    )


def passenger_conditions() -> dict[str, Column]:
    seats = F.col("passenger_count")
    return {
        "missing passenger_count": seats.isNull(),
        "passenger_count = 0": seats == 0,
        "passenger_count between 1 and 6": (seats >= 1) & (seats <= 6),
        "passenger_count > 6": seats > 6,
        "passenger_count < 0": seats < 0,
    }


def passenger_checks(df: DataFrame) -> DataFrame:
    return count_metrics(df, passenger_conditions())


def zone_pairs(df: DataFrame) -> DataFrame:
    """Rows per pair of pickup and dropoff zone: the small table both zone checks are read from."""
    return df.groupBy(F.col("PULocationID").alias("pu"), F.col("DOLocationID").alias("do")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("bigint"))


def location_checks(df: DataFrame) -> DataFrame:
    """(metric, value): per end missing, not positive, least, greatest, distinct, sentinel rows."""
    measures = {}
    for end, label in (("pu", "PULocationID"), ("do", "DOLocationID")):
        zone = F.col(end)
        measures[f"{label} missing"] = _rows_where(zone.isNull())
        measures[f"{label} <= 0"] = _rows_where(zone <= 0)
        measures[f"{label} minimum"] = F.min(zone)
        measures[f"{label} maximum"] = F.max(zone)
        measures[f"{label} unique"] = F.count_distinct(zone)
        measures[f"{label} in 264, 265"] = _rows_where(zone.isin(S.SENTINEL_ZONES))
    row = zone_pairs(df).agg(*[m.alias(name) for name, m in measures.items()])
    return wide_to_rows(row, list(measures), "metric", "value")


def zone_range_checks(df: DataFrame) -> DataFrame:
    """(metric, value): per end sentinel rows and rows outside 1..265; rows with sentinels at both ends."""
    pu, do = F.col("pu"), F.col("do")
    outside = lambda zone: (zone < 1) | (zone > S.MAX_ZONE)
    measures = {
        "PULocationID unknown zone": _rows_where(pu.isin(S.SENTINEL_ZONES)),
        "PULocationID outside 1-265": _rows_where(outside(pu)),
        "DOLocationID unknown zone": _rows_where(do.isin(S.SENTINEL_ZONES)),
        "DOLocationID outside 1-265": _rows_where(outside(do)),
        "both ends unknown": _rows_where(pu.isin(S.SENTINEL_ZONES) & do.isin(S.SENTINEL_ZONES)),
    }
    row = zone_pairs(df).agg(*[m.alias(name) for name, m in measures.items()])
    return wide_to_rows(row, list(measures), "metric", "value")


def duration_conditions() -> dict[str, Column]:
    minutes = F.col(S.DURATION)
    return {
        "duration < 0": minutes < 0,
        "duration = 0": minutes == 0,
        "0 < duration < 1 minute": (minutes > 0) & (minutes < 1),
        "duration > 6 hours": minutes > S.LONG_MINUTES,
        "duration > 24 hours": minutes > S.DAY_MINUTES,
    }


def duration_checks(df: DataFrame) -> DataFrame:
    return count_metrics(with_measures(df), duration_conditions())


def _hours() -> Column:
    return seconds_between(F.col(S.PICKUP), F.col(S.DROPOFF)) / F.lit(3600.0)


def duration_hours_checks(df: DataFrame) -> DataFrame:
    """One row: trips over a day, over six hours, longest trip in hours, dropoffs before pickup."""
    return df.agg(
        true_rows(_hours() > 24).alias("over_24_hours"),
        true_rows(_hours() > 6).alias("over_6_hours"),
        F.max(_hours()).alias("max_hours"),
        true_rows(F.col(S.DROPOFF) < F.col(S.PICKUP)).alias("dropoff_before_pickup"),
    )


def speed_conditions() -> dict[str, Column]:
    speed = F.col(S.SPEED)
    return {
        "speed = 0": speed == 0,
        "speed > 80 mph": speed > 80,
        "speed > 100 mph": speed > 100,
        "speed > 200 mph": speed > 200,
    }


def speed_checks(df: DataFrame) -> DataFrame:
    return count_metrics(with_measures(df), speed_conditions())


def speed_profile(df: DataFrame) -> DataFrame:
    """One row over trips that took time: trips above 80 mph and the highest speed."""
    speed = F.when(_hours() > 0, F.try_divide(F.col("trip_distance"), _hours()))
    return df.agg(true_rows(speed > S.IMPLAUSIBLE_MPH).alias("over_80_mph"), F.max(speed).alias("max_speed_mph"))


def duration_bin_conditions() -> dict[str, Column]:
    return {label: in_bin(F.col(S.DURATION), S.DURATION_EDGES, i) for i, label in enumerate(S.DURATION_BINS)}


def duration_bins(df: DataFrame) -> DataFrame:
    """(duration_range, count) of the seven right-closed bins in order, empty ones with 0."""
    return count_metrics(with_measures(df), duration_bin_conditions(), "duration_range", "count")


def histogram(
    df: DataFrame,
    column: str,
    bins: int = 100,
    low: float | None = None,
    high: float | None = None,
    low_quantile: float | None = None,
    high_quantile: float | None = None,
) -> DataFrame:
    """(bin, lower, upper, count): equal bins over the rows with low <= value <= high.

    Each limit is a number, an exact quantile of the column, or absent. The bins span the values
    that are left, the last bin is closed, and empty bins are listed with 0. Limits and span are settled when this is
    called, so the count is a single scan between literals.
    """
    x = F.col(column).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    wanted = sorted({float(p) for p in (low_quantile, high_quantile) if p is not None})
    limits = quantile_values(values, {"x": wanted})
    at = lambda p: None if p is None else limits.get(("x", float(p)), math.nan)
    lows, highs = [v for v in (low, at(low_quantile)) if v is not None], [v for v in (high, at(high_quantile)) if v is not None]
    kept = values.where(all_of([F.col("x") >= v for v in lows] + [F.col("x") <= v for v in highs] or [F.lit(True)]))

    # A single value gets a bin range of width 1 around it, no value at all the range 0..1.
    least, most = kept.agg(F.min("x"), F.max("x")).first()
    if least is None:
        least, most = 0.0, 1.0
    elif least == most:
        least, most = least - 0.5, most + 0.5
    first, last, n = F.lit(least), F.lit(most), F.lit(float(bins))
    # The last edge is the largest value itself, not the first edge plus so many steps.
    edge = lambda i: F.when(i == bins, last).otherwise(i * ((last - first) / n) + first)
    # The scaled position may be off by one bin at an edge, so it is checked against the edges.
    guess = F.least(F.floor((F.col("x") - first) / (last - first) * n), F.lit(bins - 1).cast("bigint"))
    settled = (
        F.when(F.col("x") < edge(F.col("guess")), F.col("guess") - 1)
        .when((F.col("x") >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = (
        kept.withColumn("guess", guess)
        .groupBy(settled.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint")))
    every = df.sparkSession.range(1).select(numbers.alias("bin"))
    # One row per bin on either side.
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )

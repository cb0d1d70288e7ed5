"""Diagnostic queries behind the cleaning rules: segments, signs, residuals, dates, speed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions import conditions as C
from faresift.functions.scalars import holds, in_bin, label_of, ntz, percent_of
from faresift.operators.metrics import count_metrics, true_rows
from faresift.operators.profiling import describe_numeric, value_counts, with_measures

RECORD_GROUPS = ["flex_fare_group", "standard_group"]


def enrich(df: DataFrame) -> DataFrame:
    """All derived diagnostic columns in one projection."""
    return with_measures(df).withColumns(
        {
            "is_flex_fare_record": C.flex_segment(),
            "is_negative_transaction": C.negative("total_amount"),
            "amount_residual_diagnostic": C.strict_residual(),
        }
    )


# --- Missing values and the flex-fare segment -----------------------------------------


def missing_pattern_conditions() -> dict[str, Column]:
    return {
        **C.flex_signs(),
        "all six conditions": C.flex_segment(),
        "some but not all conditions": C.partial_flex_segment(),
    }


def missing_pattern(df: DataFrame) -> DataFrame:
    """Rows with each sign of a flex-fare record, with all of them, and with only some."""
    return count_metrics(df, missing_pattern_conditions())


def _flex_rows() -> Column:
    """The segment as a filter: the plain comparison beside it reaches the scan and skips row groups."""
    return (F.col("payment_type") == S.FLEX_PAYMENT) & C.flex_segment()


def segment_contiguity(df: DataFrame, position: str | Column, source: str | None = None) -> DataFrame:
    """First and last position and size of the flex-fare segment, and whether it has no gap.

    Without gaps the positions span exactly as many places as there are rows, so no ordering or
    window is needed. ``source`` counts each file by itself; without it an empty segment gives nulls.
    """
    place = F.col(position) if isinstance(position, str) else position
    found = df.where(_flex_rows())
    return found.groupBy(*([source] if source else [])).agg(
        F.min(place).alias("first_position"),
        F.max(place).alias("last_position"),
        F.count(F.lit(1)).alias("segment_rows"),
        (F.max(place) - F.min(place) + 1 == F.count(F.lit(1))).alias("contiguous"),
    )


def segment_vendor_mix(df: DataFrame) -> DataFrame:
    """(vendor, segment_rows, all_rows); a code without a label is kept as a null vendor."""
    return df.groupBy(label_of(F.col("VendorID"), S.VENDOR_SLUGS).alias("vendor")).agg(
        true_rows(C.missing_block()).alias("segment_rows"), F.count(F.lit(1)).alias("all_rows")
    )


def _groups() -> dict[str, Column]:
    flex = C.flex_segment()
    return dict(zip(RECORD_GROUPS, [flex, ~flex]))


def record_sign_crosstab(df: DataFrame) -> DataFrame:
    """Record group by sign of the total, with margins; a missing total counts as positive."""
    total = F.col("total_amount")
    negative, zero = holds(total < 0), holds(total == 0)
    signs = {"negative": negative, "zero": zero, "positive": ~negative & ~zero, "All": F.lit(True)}
    rows = {**_groups(), "All": F.lit(True)}
    cells = {(g, s): f"{g}|{s}" for g in rows for s in signs}
    counted = df.agg(*[true_rows(rows[g] & signs[s]).alias(name) for (g, s), name in cells.items()])
    lines = [
        F.struct(F.lit(g).alias("record_group"), *[F.col(f"`{cells[g, s]}`").alias(s) for s in signs]) for g in rows
    ]
    return counted.select(F.inline(F.array(*lines)))


# --- Signs and payment types ----------------------------------------------------------


def sign_populations(df: DataFrame) -> DataFrame:
    return count_metrics(df, C.sign_populations(), "population", "rows")


def payment_by_population(df: DataFrame) -> DataFrame:
    """(payment, rows per sign population) for the payment labels that occur in any of them."""
    fare, total, tip = (C.negative(c) for c in ("fare_amount", "total_amount", "tip_amount"))
    populations = {
        "negative_fare_and_total": fare & total,
        "negative_fare_or_total_mismatch": fare != total,
        "negative_tip_only": tip & ~fare & ~total,
    }
    counted = df.groupBy(label_of(F.col("payment_type"), S.PAYMENT_LABELS).alias("payment")).agg(
        *[true_rows(c).alias(name) for name, c in populations.items()]
    )
    return counted.where(F.col("payment").isNotNull() & (F.greatest(*populations) > 0))


def payment_mix(df: DataFrame) -> DataFrame:
    """(value, count, percentage) of the payment labels over all labelled rows."""
    return value_counts(df, label_of(F.col("payment_type"), S.PAYMENT_SLUGS), percent=True)


# --- Amount residuals -----------------------------------------------------------------


def residual_counts_by_vendor(df: DataFrame) -> DataFrame:
    """(VendorID, residual, n): residual is null for rows that lack a part of the total.

    Residuals are whole cents and mostly equal, so counting them first leaves little to shuffle
    and no vendor, however large, weighs on a single task.
    """
    return df.groupBy("VendorID", C.strict_residual().alias("residual")).agg(F.count(F.lit(1)).alias("n"))


def reconcile_by_vendor(df: DataFrame) -> DataFrame:
    """Per vendor: complete rows, rows within a cent, their share, median and largest residual.

    A vendor without complete rows is kept, with 0 rows and nulls.
    """
    residual, n = F.col("residual"), F.col("n")
    zero = F.lit(0).cast("bigint")
    complete = F.when(residual.isNotNull(), n).otherwise(zero)
    vendor = Window.partitionBy("VendorID")
    up_to = vendor.orderBy("residual").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (
        residual_counts_by_vendor(df)
        .withColumn("_upto", F.sum(complete).over(up_to))
        .withColumn("_all", F.sum(complete).over(vendor))
    )
    # The residuals at the two middle ranks, read off the running counts.
    middle = lambda rank: F.max(
        F.when(residual.isNotNull() & (rank < F.col("_upto")) & (rank >= F.col("_upto") - n), residual)
    )
    low, high = middle(F.floor((F.col("_all") - 1) / 2)), middle(F.ceil((F.col("_all") - 1) / 2))
    complete_rows = F.sum(complete)
    matching = F.coalesce(F.sum(F.when(F.abs(residual) <= S.CENT, n)), zero)
    return counts.groupBy("VendorID").agg(
        complete_rows.alias("complete_rows"),
        matching.alias("matching_within_1_cent"),
        percent_of(matching, complete_rows, 4).alias("matching_percentage"),
        (low + (high - low) / 2).alias("median_residual"),
        F.max(F.abs(residual)).alias("maximum_absolute_residual"),
    )


def top_residuals_by_vendor(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent residuals of each vendor; ties go to the smaller residual."""
    rank = F.row_number().over(Window.partitionBy("VendorID").orderBy(F.desc("n"), "residual"))
    return (
        residual_counts_by_vendor(df)
        .where(F.col("residual").isNotNull())
        .withColumn("rank", rank)
        .where(F.col("rank") <= n)
        .select("VendorID", F.col("residual").alias("amount_residual"), F.col("n").alias("count"))
    )


def flex_residual_counts(df: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent residuals of the flex-fare segment over the parts that are there, with their share."""
    segment = df.where(_flex_rows()).select(C.lenient_residual().alias("residual"))
    counted = segment.groupBy("residual").agg(F.count(F.lit(1)).alias("count"))
    total = counted.agg(F.sum("count")).scalar()
    return (
        counted.where(F.col("residual").isNotNull())
        .withColumn("percentage", percent_of(F.col("count"), total, 4))
        .orderBy(F.desc("count"), "residual")
        .limit(n)
    )


def total_inconsistency(df: DataFrame) -> DataFrame:
    """One row: rows whose total is more than a cent off the unrounded sum of parts, and their share."""
    off = true_rows(C.inconsistent_total())
    return df.agg(
        off.alias("inconsistent_rows"), percent_of(off, F.count(F.lit(1)), 2).alias("inconsistent_percentage")
    )


def total_gap_describe(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, range and quartiles of the absolute gap of inconsistent rows."""
    gap = df.where(C.inconsistent_total()).select(F.abs(C.unrounded_gap()).alias("gap"))
    return describe_numeric(gap, ["gap"]).drop("column")


def inconsistency_driver_conditions() -> dict[str, Column]:
    gap = C.unrounded_gap()
    return {
        "total > components": gap > S.CENT,
        "total < components": gap < -S.CENT,
        "inconsistent and missing block": C.inconsistent_total() & C.missing_block(),
    }


def inconsistency_drivers(df: DataFrame) -> DataFrame:
    """Direction of the gap and its overlap with the missing block."""
    return count_metrics(df, inconsistency_driver_conditions())


def inconsistent_top_values(df: DataFrame, column: str, keep_nulls: bool, n: int = 5) -> DataFrame:
    """Most frequent values of a column among inconsistent rows."""
    return value_counts(df.where(C.inconsistent_total()), column, keep_nulls=keep_nulls, limit=n)


# --- Dates ----------------------------------------------------------------------------


class DateClasses:
    """Row conditions that sort pickups by their distance from the reporting month."""

    def __init__(self, year: int, month: int, processing_time: Column):
        start, end = datetime(year, month, 1), datetime(year + month // 12, month % 12 + 1, 1)
        margin = timedelta(days=S.BOUNDARY_DAYS)
        pickup = F.col(S.PICKUP)
        before, after = pickup < ntz(start), pickup >= ntz(end)
        self.outside = holds(before | after)
        self.boundary = holds((before & (pickup >= ntz(start - margin))) | (after & (pickup < ntz(end + margin))))
        self.untrustworthy = (
            pickup.isNull() | (pickup < ntz(start.replace(year=year - 1))) | (pickup > processing_time)
        )
        self.unexplained = self.outside & ~self.boundary & ~self.untrustworthy


def date_checks(df: DataFrame, year: int, month: int, processing_time: Column) -> DataFrame:
    """One row: first and last pickup, and the rows of each date class."""
    classes = DateClasses(year, month, processing_time)
    return df.agg(
        F.min(S.PICKUP).alias("earliest_pickup"),
        F.max(S.PICKUP).alias("latest_pickup"),
        true_rows(classes.outside).alias("outside_month"),
        true_rows(classes.boundary).alias("boundary_dates"),
        true_rows(classes.untrustworthy).alias("untrustworthy_dates"),
        true_rows(classes.unexplained).alias("unexplained_dates"),
    )


def date_issue_listing(
    df: DataFrame, year: int, month: int, processing_time: Column, unexplained_only: bool = False
) -> DataFrame:
    """The outside-month rows by pickup, each with the class of its date."""
    classes = DateClasses(year, month, processing_time)
    issue = (
        F.when(classes.unexplained, "other outside-month date")
        .when(classes.untrustworthy, "ancient/untrustworthy date")
        .when(classes.boundary, "month-boundary record")
    )
    return (
        with_measures(df.where(classes.unexplained if unexplained_only else classes.outside))
        .select(S.PICKUP, S.DROPOFF, S.DURATION, "trip_distance", "total_amount", issue.alias("date_issue_type"))
        .orderBy(S.PICKUP)
    )


# --- Speed, near-day durations, distance ----------------------------------------------


def high_speed_conditions() -> dict[str, Column]:
    fast = F.col(S.SPEED) > S.IMPLAUSIBLE_MPH
    return {
        "all high-speed records": fast,
        "duration < 1 minute": fast & (F.col(S.DURATION) < 1),
        "trip_distance > 100 miles": fast & (F.col("trip_distance") > 100),
        "trip_distance > 500 miles": fast & (F.col("trip_distance") > 500),
        "Flex Fare group": fast & C.flex_segment(),
        "negative transaction": fast & (F.col("total_amount") < 0),
    }


def high_speed_diagnostics(df: DataFrame) -> DataFrame:
    return count_metrics(with_measures(df), high_speed_conditions())


def top_speed(df: DataFrame, n: int = 20) -> DataFrame:
    """The fastest trips; equal speeds in order of the columns shown."""
    shown = [S.PICKUP, S.DROPOFF, S.DURATION, "trip_distance", S.SPEED, "fare_amount", "total_amount"]
    return (
        enrich(df)
        .where(F.col(S.SPEED).isNotNull())
        .select(*shown, "is_flex_fare_record")
        .orderBy(F.desc(S.SPEED), *shown, "is_flex_fare_record")
        .limit(n)
    )


def near_24h_rows(df: DataFrame) -> DataFrame:
    """Trips of 23 to 24 hours with the complement to a full day and the speed it would imply."""
    minutes = F.col(S.DURATION)
    complement = F.lit(S.DAY_MINUTES) - minutes
    return (
        with_measures(df)
        .where((minutes >= S.NEAR_DAY_MINUTES) & (minutes < S.DAY_MINUTES))
        .select(
            minutes.alias("original_duration_minutes"),
            complement.alias("hypothetical_duration_minutes"),
            "trip_distance",
            F.try_divide(F.col("trip_distance"), complement / F.lit(60.0)).alias("hypothetical_speed_mph"),
            "fare_amount",
            "total_amount",
        )
    )


def near_24h_checks(df: DataFrame) -> DataFrame:
    speed = F.col("hypothetical_speed_mph")
    return count_metrics(
        near_24h_rows(df),
        {
            "records": F.lit(True),
            "hypothetical duration <= 0": F.col("hypothetical_duration_minutes") <= 0,
            "hypothetical speed <= 80 mph": (speed >= 0) & (speed <= S.IMPLAUSIBLE_MPH),
            "hypothetical speed > 80 mph": speed > S.IMPLAUSIBLE_MPH,
        },
    )


def near_24h_describe(df: DataFrame) -> DataFrame:
    rows = near_24h_rows(df)
    return describe_numeric(rows, rows.columns, (0.01, 0.25, 0.5, 0.75, 0.99))


def distance_bins_by_group(df: DataFrame) -> DataFrame:
    """Record group by right-closed distance bin, as percentages of the group's rows with a distance.

    Bins and groups without rows are kept.
    """
    groups = _groups()
    miles = F.col("trip_distance")
    cells = {(g, b): f"{g}|{b}" for g in groups for b in S.DISTANCE_BINS}
    counted = df.agg(
        *[true_rows(groups[g] & miles.isNotNull()).alias(g) for g in groups],
        *[
            true_rows(groups[g] & in_bin(miles, S.DISTANCE_EDGES, S.DISTANCE_BINS.index(b))).alias(name)
            for (g, b), name in cells.items()
        ],
    )
    lines = [
        F.struct(
            F.lit(g).alias("record_group"),
            *[percent_of(F.col(f"`{cells[g, b]}`"), F.col(g), 4).alias(b) for b in S.DISTANCE_BINS],
        )
        for g in groups
    ]
    return counted.select(F.inline(F.array(*lines)))


# --- Duplicates -----------------------------------------------------------------------


def duplicate_counts(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: rows in groups of equal keys, and rows beyond the first of each group.

    Missing equals missing. Copies are counted before the shuffle, so a row repeated many times
    costs one record per task. Without ``keys`` whole rows are compared.
    """
    n = F.col("n")
    columns = [f"`{c}`" for c in keys or df.columns]
    hashed = [F.xxhash64(*columns).alias("_h1"), F.xxhash64(F.lit(1), *columns).alias("_h2")]
    # Only rows whose 128-bit hash is met twice are compared, and shuffled, in full.
    twice = df.select(*hashed).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n")).where(n > 1).drop("n")
    suspects = df.select(*columns, *hashed).join(twice, ["_h1", "_h2"], "left_semi")
    groups = suspects.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(n > 1)
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.coalesce(F.sum(n), zero).alias("rows_in_duplicate_groups"),
        F.coalesce(F.sum(n - 1), zero).alias("removable_rows"),
    )


def exact_duplicates(df: DataFrame) -> DataFrame:
    return duplicate_counts(df)


def business_duplicates(df: DataFrame, keys: list[str] = S.IDENTITY_COLUMNS) -> DataFrame:
    return duplicate_counts(df, keys)

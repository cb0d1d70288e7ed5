"""Source profile and exploratory report as sets of lazy frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions import conditions as C
from faresift.operators import diagnostics as D
from faresift.operators import gate, profiling
from faresift.operators.cleaning import period_bounds, resolve_processing_time
from faresift.operators.metrics import grouped_count_metrics
from faresift.operators.quantiles import quantiles
from faresift.sources.trips import file_inventory, read_month, require_source

# The quantiles the report asks for.
DURATION_POINTS = [0.0, 0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999, 1.0]
SPEED_POINTS = [0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999, 1.0]
DISTANCE_POINTS = [0.995]
TOTAL_POINTS = [0.005, 0.995]


def profile_source(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Size, shape and missing values of one source, after it passed the gate."""
    require_source(spark, path)
    df = read_month(spark, path)
    gate.validate_source(df)
    return {
        "file_inventory": file_inventory(spark, [path]),
        "dataset_shape": profiling.dataset_shape(df),
        "missing_counts": profiling.missing_counts(df),
    }


def check_conditions() -> dict[str, dict[str, Column]]:
    """Every pure row count of the report, by check."""
    return {
        "missing_pattern": D.missing_pattern_conditions(),
        "passenger_checks": profiling.passenger_conditions(),
        "sign_populations": C.sign_populations(),
        "inconsistency_drivers": D.inconsistency_driver_conditions(),
        "duration_checks": profiling.duration_conditions(),
        "duration_bins": profiling.duration_bin_conditions(),
        "speed_checks": profiling.speed_conditions(),
        "high_speed_diagnostics": D.high_speed_conditions(),
    }


def check_counts(df: DataFrame) -> DataFrame:
    """(check, metric, value): all row counts of the report from a single scan."""
    return grouped_count_metrics(profiling.with_measures(df), check_conditions())


def measure_quantiles(df: DataFrame) -> DataFrame:
    """(column, probability, quantile) of duration, speed, distance and total, in shared passes."""
    points = {
        S.DURATION: DURATION_POINTS,
        S.SPEED: SPEED_POINTS,
        "trip_distance": DISTANCE_POINTS,
        "total_amount": TOTAL_POINTS,
    }
    return quantiles(profiling.with_measures(df), points)


def exploratory_report(
    df: DataFrame,
    year: int,
    month: int,
    processing_time: datetime | str | None = None,
    position: str | None = None,
) -> dict[str, DataFrame]:
    """All exploratory queries over one month of trips, by name; each runs when it is asked for.

    Counts that need nothing but the row are fused into ``check_counts``, so they cost one scan
    together. ``df`` may be persisted by the caller if it fits; nothing here requires it.
    ``position`` names a column with the place of each row in the source (see ``with_position``); the
    preview and the segment's contiguity are reported only where there is one.
    """
    placed = {}
    if position:
        placed = {
            "preview": profiling.preview(df, position),
            "segment_contiguity": D.segment_contiguity(df, position),
        }
        df = df.drop(position)
    start, end = (bound for name, bound in period_bounds(F.lit(year), F.lit(month)).items() if name != "trusted_start")
    now = resolve_processing_time(df.sparkSession, processing_time)
    measured = profiling.with_measures(df)
    return {
        **placed,
        "period_outliers": profiling.period_outliers(df, start, end),
        "passenger_value_counts": profiling.value_counts(df, "passenger_count", keep_nulls=True, order="value"),
        "near_24h_rows": D.near_24h_rows(df),
        "date_issue_unexplained": D.date_issue_listing(df, year, month, now, unexplained_only=True),
        "dataset_shape": profiling.dataset_shape(df),
        "column_profile": profiling.column_profile(df),
        "describe_numeric": profiling.describe_numeric(df),
        "domain_report": gate.domain_report(df),
        "string_domain_report": gate.string_domain_report(
            df, "store_and_fwd_flag", S.CODE_DOMAINS["store_and_fwd_flag"]
        ),
        "location_checks": profiling.location_checks(df),
        "zone_range_checks": profiling.zone_range_checks(df),
        "check_counts": check_counts(df),
        "anomaly_screen": profiling.anomaly_screen(df),
        "negative_amounts": profiling.negative_amounts(df),
        "distance_profile": profiling.distance_profile(df),
        "duration_hours_checks": profiling.duration_hours_checks(df),
        "speed_profile": profiling.speed_profile(df),
        "record_sign_crosstab": D.record_sign_crosstab(df),
        "segment_vendor_mix": D.segment_vendor_mix(df),
        "payment_by_population": D.payment_by_population(df),
        "payment_mix": D.payment_mix(df),
        "reconcile_by_vendor": D.reconcile_by_vendor(df),
        "top_residuals_by_vendor": D.top_residuals_by_vendor(df),
        "flex_residual_counts": D.flex_residual_counts(df),
        "total_inconsistency": D.total_inconsistency(df),
        "total_gap_describe": D.total_gap_describe(df),
        "top_inconsistent_surcharges": D.inconsistent_top_values(df, "congestion_surcharge", keep_nulls=True),
        "top_inconsistent_extras": D.inconsistent_top_values(df, "extra", keep_nulls=False),
        "measure_quantiles": measure_quantiles(df),
        "distance_histogram": profiling.histogram(df, "trip_distance", low=0, high_quantile=0.995),
        "total_histogram": profiling.histogram(df, "total_amount", low_quantile=0.005, high_quantile=0.995),
        "speed_histogram": profiling.histogram(measured, S.SPEED, low=0, high_quantile=0.999),
        "date_checks": D.date_checks(df, year, month, now),
        "date_issue_listing": D.date_issue_listing(df, year, month, now),
        "top_speed": D.top_speed(df),
        "near_24h_checks": D.near_24h_checks(df),
        "near_24h_describe": D.near_24h_describe(df),
        "distance_bins_by_group": D.distance_bins_by_group(df),
        "exact_duplicates": D.exact_duplicates(df),
        "business_duplicates": D.business_duplicates(df),
    }

"""Registered queries: one per operator, each over whole tables of a data folder.

Rounded columns are sums or quotients whose last bits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import half_even, ntz
from faresift.operators import cleaning, diagnostics as D, gate, profiling, quality
from faresift.operators.quantiles import quantiles
from faresift.plans import report
from faresift.plans.clean import clean_months
from faresift.plans.derived_trips import (
    MONTH_FILE,
    PERIOD,
    PROCESSING_TIME,
    landed_month,
    landed_months,
    numbered_trips,
    trips,
)
from faresift.session import work_dir
from faresift.sources import landing, sinks
from faresift.sources import trips as source
from faresift.streaming.ingest import ingest_incremental

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TRIP_KEY = [S.PICKUP, S.DROPOFF, "PULocationID", "DOLocationID", "trip_distance", "total_amount"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return cleaning.transform_trips(trips(spark, sf_dir), *PERIOD, MONTH_FILE, PROCESSING_TIME)


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column half-even."""
    doubles = {c: half_even(F.col(f"`{c}`"), digits) for c, t in df.dtypes if t == "double"}
    return df.withColumns(doubles) if doubles else df


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    """Render array columns as comma-joined text."""
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in columns})


def _on_trips(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(trips(spark, sf_dir))


def _flag(name: str) -> Query:
    return lambda spark, sf_dir: _halves(spark, sf_dir)[0].select(*TRIP_KEY, name)


# --- Sources, lineage, sinks ----------------------------------------------------------


def scan_month(spark, sf_dir):
    return source.read_trips(spark, landed_month(spark, sf_dir))


def scan_months(spark, sf_dir):
    rows = source.read_trips(spark, landed_months(spark, sf_dir))
    return rows.groupBy("source_file", "VendorID").agg(
        F.count(F.lit(1)).alias("rows"), F.min(S.PICKUP).alias("earliest"), F.max(S.PICKUP).alias("latest")
    )


def file_inventory(spark, sf_dir):
    listed = source.file_inventory(spark, [f"{sf_dir}/{t}.parquet" for t in TABLES])
    return listed.select("source_file", "rows", "is_empty", (F.col("size_mb") > 0).alias("has_size"))


def _named_orders(spark, sf_dir):
    """Orders with the name of a monthly file each; those of one priority have a name that does not fit."""
    name = landing.file_name_of(F.col("o_orderdate"))
    unfit = F.col("o_orderpriority") == "1-URGENT"
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.when(unfit, F.concat(F.lit("x_"), name)).otherwise(name).alias("source_file")
    )


def reporting_period(spark, sf_dir):
    named = source.with_reporting_period(_named_orders(spark, sf_dir), strict=False)
    return named.select("o_orderkey", "source_file", "reporting_year", "reporting_month")


def with_lineage(spark, sf_dir):
    month = source.read_month(spark, landed_month(spark, sf_dir))
    return source.with_lineage(month).select("source_file", *TRIP_KEY)


def write_outputs(spark, sf_dir):
    paths = sinks.write_outputs(*_halves(spark, sf_dir), work_dir(spark), MONTH_FILE)
    halves = [
        spark.read.parquet(path).select(
            F.lit(half).alias("half"),
            "source_file",
            *TRIP_KEY,
            F.col("rejection_reason") if half == "rejected" else F.lit(None).cast("string").alias("rejection_reason"),
        )
        for half, path in paths.items()
    ]
    return halves[0].unionByName(halves[1])


def write_quality(spark, sf_dir):
    path = f"{work_dir(spark)}/quality"
    sinks.write_quality(quality_summary(spark, sf_dir), path)
    return spark.read.schema(sinks.QUALITY_SCHEMA).csv(path, header=True)


def pending_files(spark, sf_dir):
    listing = _table(spark, sf_dir, "orders").select(landing.file_name_of(F.col("o_orderdate")).alias("file_name"))
    ledger = _table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return landing.pending_files(listing, ledger.select(landing.file_name_of(F.col("l_shipdate")).alias("file_name")))


def pending_quarter_ends(spark, sf_dir):
    """Months of orders, in part without a name, whose file is not among those of shipments in other months of a quarter."""
    name = F.when(F.col("o_orderpriority") != "5-LOW", landing.file_name_of(F.col("o_orderdate")))
    ledger = _table(spark, sf_dir, "lineitem").where(F.month("l_shipdate") % 3 != 0)
    listing = _table(spark, sf_dir, "orders").select(name.alias("file_name"))
    return landing.pending_files(listing, ledger.select(landing.file_name_of(F.col("l_shipdate")).alias("file_name")))


def missing_months(spark, sf_dir):
    ledger = _table(spark, sf_dir, "orders").select(landing.file_name_of(F.col("o_orderdate")).alias("file_name"))
    return landing.missing_months(spark, "1991-01", "2024-12", ledger)


def ingest(spark, sf_dir):
    """Land the three months twice: the second run must add nothing."""
    out = work_dir(spark)
    for _ in range(2):
        ingest_incremental(spark, landed_months(spark, sf_dir), f"{out}/landed", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/landed").groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def ingest_with_quarantine(spark, sf_dir):
    """Land the three months, one of them with undocumented payment types, which is set aside; list both."""
    out, months = work_dir(spark), landed_months(spark, sf_dir)
    spoil = F.when(F.col("trip_distance") > S.EXTREME_MILES, F.col("payment_type") + 9).otherwise(F.col("payment_type"))
    for path in source.month_paths(spark, months):
        rows = source.read_month(spark, path)
        name = source.base_name(path)
        rows = rows.withColumn("payment_type", spoil) if name.endswith("02.parquet") else rows
        rows.write.parquet(f"{out}/raw/{name}")
    aside = ingest_incremental(spark, f"{out}/raw", f"{out}/landed", f"{out}/checkpoint", quarantine=f"{out}/aside")
    landed = spark.read.parquet(f"{out}/landed").groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("string")
    return landed.select("source_file", "rows", none.alias("rule"), none.alias("column")).union(
        aside.select("source_file", F.lit(0).cast("bigint"), "rule", "column")
    )


# --- Validation gate ------------------------------------------------------------------


def _faulty(spark, sf_dir):
    """Trips with undocumented codes."""
    far = F.col("trip_distance") > S.EXTREME_MILES
    return trips(spark, sf_dir).withColumns(
        {
            "payment_type": F.when(far, F.col("payment_type") + 9).otherwise(F.col("payment_type")),
            "RatecodeID": F.when(far, F.col("RatecodeID") + 0.5).otherwise(F.col("RatecodeID")),
            "store_and_fwd_flag": F.when(F.col("tolls_amount") > 0, "X").otherwise(F.col("store_and_fwd_flag")),
        }
    )


def check_not_empty(spark, sf_dir):
    return gate.violations(trips(spark, sf_dir).where(F.col("total_amount") > 1e9))


def check_missing_columns(spark, sf_dir):
    return gate.violations(_faulty(spark, sf_dir).withColumnRenamed("Airport_fee", "airport_fee").drop("extra"))


def check_unexpected_columns(spark, sf_dir):
    return gate.violations(trips(spark, sf_dir).withColumn("cbd_congestion_fee", F.col("extra")))


def check_datetime_types(spark, sf_dir):
    return gate.violations(trips(spark, sf_dir).withColumn(S.PICKUP, F.col(S.PICKUP).cast("string")))


def check_domains(spark, sf_dir):
    return gate.unknown_codes(_faulty(spark, sf_dir))


def validate_source(spark, sf_dir):
    """The faults that the raising form would list, of a source with an extra column and unknown codes."""
    return gate.violations(_faulty(spark, sf_dir).withColumn("cbd_congestion_fee", F.col("extra")))


def domain_report(spark, sf_dir):
    return gate.domain_report(_faulty(spark, sf_dir))


def observed_codes(spark, sf_dir):
    domains = {c: v for c, v in S.CODE_DOMAINS.items() if c != "store_and_fwd_flag"}
    return gate.observed_codes(_faulty(spark, sf_dir), domains)


def string_domain_report(spark, sf_dir):
    return gate.string_domain_report(_faulty(spark, sf_dir), "store_and_fwd_flag", ["N", "Y"])


def order_status_report(spark, sf_dir):
    return gate.string_domain_report(_table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


# --- Row rules and quality ------------------------------------------------------------


def period_bounds(spark, sf_dir):
    day = F.col("o_orderdate")
    months = _table(spark, sf_dir, "orders").select(F.year(day).alias("year"), F.month(day).alias("month")).distinct()
    bounds = cleaning.period_bounds(F.col("year"), F.col("month"))
    return months.select("year", "month", *[c.alias(n) for n, c in bounds.items()])


def transform_trips(spark, sf_dir):
    processed, rejected = _halves(spark, sf_dir)
    return processed.unionByName(rejected, allowMissingColumns=True)


def transform_many(spark, sf_dir):
    """Both halves of three months cleaned in one scan, each month by its own bounds."""
    raw = source.read_trips(spark, landed_months(spark, sf_dir))
    periods = source.with_reporting_period(raw.select("source_file").distinct())
    processed, rejected = cleaning.transform_many(raw, periods, PROCESSING_TIME)
    shown = [*TRIP_KEY, "source_file", "is_outside_reporting_month", "rejection_reason"]
    return processed.unionByName(rejected, allowMissingColumns=True).select(*shown)


def reconcile_counts(spark, sf_dir):
    processed, rejected = _halves(spark, sf_dir)
    n = F.count(F.lit(1))
    counted = trips(spark, sf_dir).agg(n.alias("raw_rows")).withColumns(
        {"processed_rows": processed.agg(n).scalar(), "rejected_rows": rejected.agg(n).scalar()}
    )
    return counted.withColumn("reconciles", F.expr("raw_rows = processed_rows + rejected_rows"))


def quality_summary(spark, sf_dir):
    return quality.quality_summary(*_halves(spark, sf_dir), trips(spark, sf_dir))


def quality_by_source(spark, sf_dir):
    return clean_months(spark, landed_months(spark, sf_dir), work_dir(spark), PROCESSING_TIME)


def flag_counts(spark, sf_dir):
    return quality.flag_counts(_halves(spark, sf_dir)[0])


# --- Profiling ------------------------------------------------------------------------


def _bounds() -> tuple[Column, Column]:
    return ntz("2024-01-01 00:00:00"), ntz("2024-02-01 00:00:00")


def period_outliers(spark, sf_dir):
    return _joined(profiling.period_outliers(trips(spark, sf_dir), *_bounds()), "years")


def column_profile_orders(spark, sf_dir):
    return profiling.column_profile(_table(spark, sf_dir, "orders"))


def describe_events(spark, sf_dir):
    return _rounded(profiling.describe_numeric(_table(spark, sf_dir, "events"), ["value", "user_id"]))


def preview(spark, sf_dir):
    return profiling.preview(numbered_trips(spark, sf_dir), "k").drop("k")


def preview_of_files(spark, sf_dir):
    """First rows of the landed month by the place in its part files."""
    return source.first_rows(spark, landed_month(spark, sf_dir))


def _placed(spark, sf_dir):
    months = spark.read.schema(S.TRIP_SCHEMA).parquet(*source.month_paths(spark, landed_months(spark, sf_dir)))
    return source.with_month_position(months)


def month_positions(spark, sf_dir):
    """Per landed month: rows, and the places they have over all its part files."""
    place = F.col("month_position")
    return _placed(spark, sf_dir).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(place).alias("first_position"),
        F.max(place).alias("last_position"),
        F.count_distinct(place).alias("positions"),
    )


def segment_contiguity_of_files(spark, sf_dir):
    """The flex-fare segment of each landed month by the places in its files."""
    found = D.segment_contiguity(_placed(spark, sf_dir), "month_position", "source_file")
    return found.select("source_file", "segment_rows", "contiguous")


def column_profile_united(spark, sf_dir):
    """The profile from sketches of three months, with whether each estimate is within 3 % of the exact count."""
    united = profiling.united_profile(profiling.profile_sketches(source.read_trips(spark, landed_months(spark, sf_dir))))
    exact = profiling.column_profile(trips(spark, sf_dir)).select("column", F.col("unique_including_na").alias("exact"))
    near = F.abs(F.col("unique_including_na") - F.col("exact")) <= 0.03 * F.col("exact")
    return united.join(exact, "column").select("column", "dtype", "missing", "missing_pct", near.alias("estimate_is_near"))


def passenger_value_counts(spark, sf_dir):
    return profiling.value_counts(trips(spark, sf_dir), "passenger_count", keep_nulls=True, order="value")


def event_type_counts(spark, sf_dir):
    return profiling.value_counts(_table(spark, sf_dir, "events"), "event_type", percent=True)


def measure_quantiles(spark, sf_dir):
    return _rounded(report.measure_quantiles(trips(spark, sf_dir)), 6)


def event_quantiles(spark, sf_dir):
    points = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    return _rounded(quantiles(_table(spark, sf_dir, "events"), {"value": points}), 6)


def _histogram(column: str, measured: bool = False, **limits) -> Query:
    def query(spark, sf_dir):
        df = trips(spark, sf_dir)
        found = profiling.histogram(profiling.with_measures(df) if measured else df, column, **limits)
        return _rounded(found, 6)

    return query


# --- Diagnostics ----------------------------------------------------------------------


def segment_contiguity(spark, sf_dir):
    return D.segment_contiguity(numbered_trips(spark, sf_dir), "k")


def date_checks(spark, sf_dir):
    return D.date_checks(trips(spark, sf_dir), *PERIOD, ntz(PROCESSING_TIME))


def date_issue_listing(spark, sf_dir):
    return D.date_issue_listing(trips(spark, sf_dir), *PERIOD, ntz(PROCESSING_TIME))


def date_issue_unexplained(spark, sf_dir):
    return D.date_issue_listing(trips(spark, sf_dir), *PERIOD, ntz(PROCESSING_TIME), unexplained_only=True)


def lineitem_exact_duplicates(spark, sf_dir):
    return D.exact_duplicates(_table(spark, sf_dir, "lineitem"))


def lineitem_business_duplicates(spark, sf_dir):
    return D.business_duplicates(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def enriched(spark, sf_dir):
    columns = ["is_flex_fare_record", "is_negative_transaction", "amount_residual_diagnostic", S.DURATION, S.SPEED]
    return D.enrich(trips(spark, sf_dir)).select(*TRIP_KEY, *columns)


QUERIES: dict[str, Query] = {
    "scan_month": scan_month,
    "scan_months": scan_months,
    "file_inventory": file_inventory,
    "reporting_period": reporting_period,
    "with_lineage": with_lineage,
    "write_outputs": write_outputs,
    "write_quality": write_quality,
    "pending_files": pending_files,
    "pending_quarter_ends": pending_quarter_ends,
    "missing_months": missing_months,
    "ingest_incremental": ingest,
    "ingest_with_quarantine": ingest_with_quarantine,
    "check_not_empty": check_not_empty,
    "check_missing_columns": check_missing_columns,
    "check_unexpected_columns": check_unexpected_columns,
    "check_datetime_types": check_datetime_types,
    "check_domains": check_domains,
    "validate_source": validate_source,
    "domain_report": domain_report,
    "observed_codes": observed_codes,
    "string_domain_report": string_domain_report,
    "order_status_report": order_status_report,
    "period_bounds": period_bounds,
    "rejected": lambda spark, sf_dir: _halves(spark, sf_dir)[1],
    "processed": lambda spark, sf_dir: _halves(spark, sf_dir)[0],
    **{name: _flag(name) for name in [*S.QUALITY_FLAGS, S.DURATION, S.SPEED]},
    "transform_trips": transform_trips,
    "transform_many": transform_many,
    "reconcile_counts": reconcile_counts,
    "quality_summary": quality_summary,
    "quality_by_source": quality_by_source,
    "flag_counts": flag_counts,
    "dataset_shape": _on_trips(profiling.dataset_shape),
    "period_outliers": period_outliers,
    "missing_counts": _on_trips(profiling.missing_counts),
    "column_profile": _on_trips(profiling.column_profile),
    "column_profile_orders": column_profile_orders,
    "describe_numeric": _on_trips(lambda df: _rounded(profiling.describe_numeric(df))),
    "describe_events": describe_events,
    "preview": preview,
    "preview_of_files": preview_of_files,
    "month_positions": month_positions,
    "column_profile_united": column_profile_united,
    "value_counts": passenger_value_counts,
    "event_type_counts": event_type_counts,
    "anomaly_screen": _on_trips(profiling.anomaly_screen),
    "negative_amounts": _on_trips(profiling.negative_amounts),
    "distance_profile": _on_trips(profiling.distance_profile),
    "passenger_checks": _on_trips(profiling.passenger_checks),
    "location_checks": _on_trips(profiling.location_checks),
    "zone_range_checks": _on_trips(profiling.zone_range_checks),
    "quantiles": measure_quantiles,
    "event_quantiles": event_quantiles,
    "histogram": _histogram("trip_distance", low=0, high_quantile=0.995),
    "total_histogram": _histogram("total_amount", low_quantile=0.005, high_quantile=0.995),
    "speed_histogram": _histogram(S.SPEED, measured=True, low=0, high_quantile=0.999),
    "histogram_of_one_value": _histogram("extra", low=4.4, high=5.4),
    "histogram_of_no_value": _histogram("extra", low=100.0, high=200.0),
    "duration_checks": _on_trips(profiling.duration_checks),
    "duration_hours_checks": _on_trips(lambda df: _rounded(profiling.duration_hours_checks(df), 6)),
    "speed_checks": _on_trips(profiling.speed_checks),
    "speed_profile": _on_trips(lambda df: _rounded(profiling.speed_profile(df), 6)),
    "duration_bins": _on_trips(profiling.duration_bins),
    "check_counts": _on_trips(report.check_counts),
    "missing_pattern": _on_trips(D.missing_pattern),
    "segment_contiguity": segment_contiguity,
    "segment_contiguity_of_files": segment_contiguity_of_files,
    "segment_vendor_mix": _on_trips(D.segment_vendor_mix),
    "record_sign_crosstab": _on_trips(D.record_sign_crosstab),
    "sign_populations": _on_trips(D.sign_populations),
    "payment_by_population": _on_trips(D.payment_by_population),
    "payment_mix": _on_trips(D.payment_mix),
    "reconcile_by_vendor": _on_trips(lambda df: _rounded(D.reconcile_by_vendor(df), 6)),
    "top_residuals_by_vendor": _on_trips(D.top_residuals_by_vendor),
    "flex_residual_counts": _on_trips(D.flex_residual_counts),
    "total_inconsistency": _on_trips(D.total_inconsistency),
    "total_gap_describe": _on_trips(lambda df: _rounded(D.total_gap_describe(df))),
    "inconsistency_drivers": _on_trips(D.inconsistency_drivers),
    "inconsistency_top_surcharges": _on_trips(
        lambda df: D.inconsistent_top_values(df, "congestion_surcharge", keep_nulls=True)
    ),
    "inconsistency_top_extras": _on_trips(lambda df: D.inconsistent_top_values(df, "extra", keep_nulls=False)),
    "date_checks": date_checks,
    "date_issue_listing": date_issue_listing,
    "date_issue_unexplained": date_issue_unexplained,
    "high_speed_diagnostics": _on_trips(D.high_speed_diagnostics),
    "top_speed": _on_trips(D.top_speed),
    "near_24h_rows": _on_trips(D.near_24h_rows),
    "near_24h_checks": _on_trips(D.near_24h_checks),
    "near_24h_describe": _on_trips(lambda df: _rounded(D.near_24h_describe(df))),
    "distance_bins_by_group": _on_trips(D.distance_bins_by_group),
    "exact_duplicates": _on_trips(D.exact_duplicates),
    "business_duplicates": _on_trips(D.business_duplicates),
    "lineitem_exact_duplicates": lineitem_exact_duplicates,
    "lineitem_business_duplicates": lineitem_business_duplicates,
    "enrich": enriched,
    "normal_trips": lambda spark, sf_dir: cleaning.normal_trips(_halves(spark, sf_dir)[0]),
}

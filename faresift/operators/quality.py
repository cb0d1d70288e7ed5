"""Quality summary of a cleaned month and the row reconciliation it rests on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import percent_of
from faresift.operators.metrics import count_metrics, true_rows

SUMMARY_COUNTS = ["raw_rows", "processed_rows", "rejected_rows", *S.QUALITY_FLAGS]


def require_flags(processed: DataFrame) -> None:
    missing = sorted(set(S.QUALITY_FLAGS) - set(processed.columns))
    if missing:
        raise ValueError(f"The cleaned rows lack {len(missing)} flags: {', '.join(missing)}")


def reconcile(raw: int, processed: int, rejected: int) -> None:
    """Raise unless every raw row went to exactly one of the two outputs."""
    if raw != processed + rejected:
        raise ValueError(
            f"Row counts do not reconcile: raw={raw:,}, processed={processed:,}, rejected={rejected:,}"
        )


def flag_aggregates() -> list[Column]:
    return [true_rows(F.col(f)).alias(f) for f in S.QUALITY_FLAGS]


def flag_counts(processed: DataFrame) -> DataFrame:
    """(metric, count) for each of the fourteen flags, from one pass over the flag columns."""
    require_flags(processed)
    return count_metrics(processed, {f: F.col(f) for f in S.QUALITY_FLAGS}, value_column="count")


def summary_rows(counts: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Lay wide counts out as (metric, count, percentage_of_raw) rows, refusing counts that do not add up."""
    balanced = F.col("raw_rows") == F.col("processed_rows") + F.col("rejected_rows")
    message = F.format_string(
        "Row counts do not reconcile: raw=%d, processed=%d, rejected=%d",
        F.col("raw_rows"),
        F.col("processed_rows"),
        F.col("rejected_rows"),
    )
    # The check sits in the value itself, so no rewrite of the plan can leave it out.
    raw = F.when(balanced, F.col("raw_rows")).otherwise(F.raise_error(message).cast("bigint"))
    cells = [
        F.struct(
            F.lit(name).alias("metric"),
            (raw if name == "raw_rows" else F.col(name)).alias("count"),
            percent_of(F.col(name), raw, 4).alias("percentage_of_raw"),
        )
        for name in SUMMARY_COUNTS
    ]
    return counts.select(*keys, F.inline(F.array(*cells)))


def quality_summary(processed: DataFrame, rejected: DataFrame, raw: DataFrame | int) -> DataFrame:
    """Seventeen (metric, count, percentage_of_raw) rows; raises at run time if rows went missing.

    The three row counts are taken independently. The raw count needs no column and the rejected
    one only the pickup, so the flags are the only real scan.
    """
    require_flags(processed)
    rows = F.count(F.lit(1))
    raw_rows = F.lit(raw).cast("bigint") if isinstance(raw, int) else raw.agg(rows).scalar()
    counts = processed.agg(rows.alias("processed_rows"), *flag_aggregates()).withColumns(
        {"raw_rows": raw_rows, "rejected_rows": rejected.agg(rows).scalar()}
    )
    return summary_rows(counts)


def quality_by_source(processed: DataFrame, rejected: DataFrame, raw: DataFrame) -> DataFrame:
    """The quality summary of each source file: source_file first, then as ``quality_summary``.

    Each input is reduced to one row per source file before the three are brought together.
    """
    require_flags(processed)
    rows = F.count(F.lit(1))
    parts = [
        raw.groupBy("source_file").agg(rows.alias("raw_rows")),
        processed.groupBy("source_file").agg(rows.alias("processed_rows"), *flag_aggregates()),
        rejected.groupBy("source_file").agg(rows.alias("rejected_rows")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    counts = stacked.groupBy("source_file").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in SUMMARY_COUNTS]
    )
    return summary_rows(counts, ["source_file"])

"""Many counts from one scan, laid out as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def true_rows(condition: Column) -> Column:
    """Number of rows for which the condition is true, as a bigint."""
    return F.count_if(condition)


def wide_to_rows(row: DataFrame, names: list[str], name_column: str, value_column: str) -> DataFrame:
    """Turn the columns of a one-row aggregate into (name, value) rows, in the given order."""
    pairs = [
        F.struct(F.lit(n).alias(name_column), F.col(f"`{n}`").cast("bigint").alias(value_column)) for n in names
    ]
    return row.select(F.inline(F.array(*pairs)))


def count_metrics(
    df: DataFrame,
    conditions: dict[str, Column],
    name_column: str = "metric",
    value_column: str = "value",
) -> DataFrame:
    """Rows satisfying each named condition.

    All conditions are counted in a single pass with map-side partial counts, so only one
    short row per task is shuffled whatever the size of the input.
    """
    row = df.agg(*[true_rows(c).alias(name) for name, c in conditions.items()])
    return wide_to_rows(row, list(conditions), name_column, value_column)


def grouped_count_metrics(df: DataFrame, checks: dict[str, dict[str, Column]]) -> DataFrame:
    """Several named sets of conditions counted together in one pass: (check, metric, value)."""
    flat = [(check, metric, c) for check, conditions in checks.items() for metric, c in conditions.items()]
    row = df.agg(*[true_rows(c).alias(f"m{i}") for i, (_, _, c) in enumerate(flat)])
    cells = [
        F.struct(F.lit(check).alias("check"), F.lit(metric).alias("metric"), F.col(f"m{i}").alias("value"))
        for i, (check, metric, _) in enumerate(flat)
    ]
    return row.select(F.inline(F.array(*cells)))

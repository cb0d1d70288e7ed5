"""Source gate: schema and code-domain rules, reported as rows or raised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faresift import schema as S
from faresift.functions.scalars import any_of, union_all
from faresift.session import work_dir

VIOLATION_SCHEMA = "rule string, column string, detail string"


def schema_violations(schema: T.StructType) -> list[tuple[str, str, str]]:
    """(rule, column, detail) for every fault that the schema alone shows.

    Names are compared as they are spelled: Spark itself would take ``airport_fee`` for ``Airport_fee``.
    """
    present, required = set(schema.fieldNames()), set(S.TRIP_COLUMNS)
    found = [("missing_column", c, "required column is missing") for c in sorted(required - present)]
    found += [("unexpected_column", c, "column is not part of the source schema") for c in sorted(present - required)]
    if not required - present:
        wall_clock = (T.TimestampNTZType, T.TimestampType)
        found += [
            ("not_datetime", c, f"column is {schema[c].dataType.simpleString()}, not a datetime")
            for c in S.DATETIME_COLUMNS
            if not isinstance(schema[c].dataType, wall_clock)
        ]
    return found


def part_violations(parts: dict[str, T.StructType]) -> list[tuple[str, str, str, str]]:
    """(file, rule, column, detail) for the faults of each part file of a month, by the schema of its own footer.

    A merged schema would fill a column that one part lacks with nulls. Parts must also agree on types.
    """
    found = []
    first: dict[str, T.DataType] = {}
    for file, schema in parts.items():
        found += [(file, *fault) for fault in schema_violations(schema)]
        for field in schema.fields:
            known = first.setdefault(field.name, field.dataType)
            if known != field.dataType:
                detail = f"{field.dataType.simpleString()} here, {known.simpleString()} in another part"
                found.append((file, "part_type", field.name, detail))
    return found


def _rows(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], VIOLATION_SCHEMA)
    cells = [
        F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("rule", "column", "detail"), row)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def _outside(column: str, allowed: list) -> Column:
    return F.col(f"`{column}`").isNotNull() & ~F.col(f"`{column}`").isin(allowed)


def unknown_codes(df: DataFrame, domains: dict[str, list] | None = None, *by: str) -> DataFrame:
    """Distinct (column, value) outside the allowed codes, one row each (per ``by``), missing values left alone.

    Sound rows fall to the filter right after the scan, so only faulty ones are unfolded and shuffled.
    """
    domains = domains or S.CODE_DOMAINS
    cells = [
        F.when(
            _outside(c, allowed),
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")),
        )
        for c, allowed in domains.items()
    ]
    return (
        df.where(any_of([_outside(c, allowed) for c, allowed in domains.items()]))
        .select(*by, F.inline(F.array_compact(F.array(*cells))))
        .distinct()
    )


def violations(df: DataFrame) -> DataFrame:
    """Every fault of a source as (rule, column, detail) rows; none for a sound source.

    Code and type rules are skipped while a column is missing, as they could not be complete.
    """
    faults = schema_violations(df.schema)
    parts = [
        df.limit(1)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == 0)
        .select(F.lit("empty").alias("rule"), F.lit(None).cast("string").alias("column"), F.lit("no rows").alias("detail"))
    ]
    if faults:
        parts.append(_rows(df.sparkSession, faults))
    if not any(rule == "missing_column" for rule, _, _ in faults):
        parts.append(
            unknown_codes(df).select(F.lit("unknown_code").alias("rule"), "column", F.col("value").alias("detail"))
        )
    return union_all(parts)


def refuse_faults(found: DataFrame, report: str | None = None) -> None:
    """Raise if a (rule, column, detail) frame holds rows, which are then written in full for reading up.

    Only the number of faults of each rule and column comes to the driver. ``report`` is the folder of the
    written table, by default one in the shared scratch folder; the error names it.
    """
    counted = found.groupBy("rule", "column").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        return
    path = report or f"{work_dir(found.sparkSession)}/violations"
    found.write.mode("overwrite").parquet(path)
    said = sorted(f"{r['rule']}{f' {r["column"]}' if r['column'] else ''} ({r['n']:,})" for r in counted)
    raise ValueError(f"{len(said)} rules broken: {'; '.join(said)}. All faults are listed in {path}")


def validate_source(df: DataFrame, report: str | None = None) -> None:
    """Refuse a source that breaks any rule; see ``refuse_faults``."""
    refuse_faults(violations(df), report)


def observed_codes(df: DataFrame, domains: dict[str, list]) -> DataFrame:
    """(column, code, rows, documented) for each distinct code, read as a whole number.

    Each column's codes are counted before the shuffle, so a code held by most rows costs nothing extra.
    """
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("bigint").alias("code")) for c in domains
    ]
    documented = any_of([(F.col("column") == c) & F.col("code").isin(codes) for c, codes in domains.items()])
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("code").isNotNull())
        .groupBy("column", "code")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("documented", documented)
    )


def domain_report(df: DataFrame, domains: dict[str, list] | None = None) -> DataFrame:
    """(column, code, rows, documented, all_documented): every code met, however many there are.

    A column without any code has one row with a null code and counts as documented.
    """
    domains = domains or {c: v for c, v in S.CODE_DOMAINS.items() if c != "store_and_fwd_flag"}
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in domains])).alias("column"))
    codes = observed_codes(df, domains)
    # One row per described column.
    whole = codes.groupBy("column").agg(F.bool_and("documented").alias("all_documented"))
    listed = codes.join(F.broadcast(whole), "column")
    return names.join(listed, "column", "left").select(
        "column",
        "code",
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
        "documented",
        F.coalesce("all_documented", F.lit(True)).alias("all_documented"),
    )


def string_domain_report(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """(value, rows, is_outside): every value met; rows without a value are the null one, never outside."""
    value = F.col("value")
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("is_outside", F.coalesce(~value.isin(allowed), F.lit(False)))

"""Exact linear-interpolation quantiles that no single task has to hold.

``percentile`` keeps every distinct value of a group in one buffer, which breaks down on a
measure such as speed. Here the wanted ranks are found by radix selection instead. Every value has a
64-bit key in the order of the values. Three passes look at a third of its bits each, the highest first:
a pass counts the rows per digit, adds the counts up, and keeps the digits that hold a wanted rank; the
next pass drops all other rows in the scan. A cell whose least and largest key are equal is settled and
needs no further look, so most measures take two passes.

Each pass is a plan of its own over the rows and the few cells left open, one scan and two exchanges,
so plans do not grow from pass to pass. Equal digits are counted before the shuffle: a task ships one
short record per cell, whatever the values' skew.
"""

from __future__ import annotations

import math
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faresift.functions.scalars import union_all
from faresift.session import work_dir

# The first digit has the sign, the exponent and ten bits of the fraction of a double.
SHIFTS = (42, 21, 0)
INTEGRAL = ("tinyint", "smallint", "int", "bigint")
# The 64-bit floating point format: fraction bits, exponent offset, least normal and least positive number.
FRACTION, OFFSET = 1 << 52, 1023
LEAST_NORMAL, LEAST = 2.0**-1022, 5e-324
INFINITE = 2047 * FRACTION


def with_key(rows: DataFrame, integral: bool) -> DataFrame:
    """``value`` as ``key``, a whole number in the order of the values; rows without a value, or with NaN, go.

    Whole numbers are their own keys. The key of a double is the bits of its magnitude, with the sign. Powers of two and
    the divisions by them are exact, and a logarithm that lies on the wrong side of a whole number is set right, so
    each double has its own key; both zeros share one. The steps are columns of their own, to be computed once.
    """
    value = F.col("value")
    if integral:
        return rows.where(value.isNotNull()).withColumn("key", F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))).drop("value")
    size, guess, power = F.col("_size"), F.col("_guess"), F.col("_power")
    normal = (size >= LEAST_NORMAL) & (size < float("inf"))
    over, under = power > size, power * 2 <= size
    exponent = F.when(over, guess - 1).when(under, guess + 1).otherwise(guess)
    scaled = F.when(over, size / power * 2).when(under, size / power / 2).otherwise(size / power)
    fraction = ((scaled - 1) * F.lit(float(FRACTION))).cast("bigint")
    bits = (
        F.when(normal, (exponent + OFFSET) * F.lit(FRACTION) + fraction)
        .when(size < LEAST_NORMAL, (size / F.lit(LEAST)).cast("bigint"))
        .otherwise(F.lit(INFINITE))
    )
    number = value.cast("double")
    return (
        rows.withColumn("value", number)
        .where(value.isNotNull() & ~F.isnan(value))
        .withColumn("_size", F.abs(value))
        .withColumn("_guess", F.when(normal, F.least(F.floor(F.log2(size)), F.lit(OFFSET).cast("bigint"))))
        .withColumn("_power", F.pow(F.lit(2.0), guess))
        .withColumn("_bits", bits)
        # Never null, and said to be so: the planner would push a test of it down to the scan, steps and all.
        .withColumn("key", F.coalesce(F.when(value < 0, -F.col("_bits")).otherwise(F.col("_bits")), F.lit(0).cast("bigint")))
        .drop("value", "_size", "_guess", "_power", "_bits")
    )


def key_value(key: int) -> float:
    """The double of a key."""
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(key)))[0], key)


def _key_column_value(key: Column) -> Column:
    """``key_value`` in a frame."""
    size = F.abs(key)
    exponent, fraction = F.shiftright(size, 52), F.pmod(size, F.lit(FRACTION)).cast("double")
    normal = (fraction / F.lit(float(FRACTION)) + 1) * F.pow(F.lit(2.0), exponent - OFFSET)
    found = (
        F.when(size == INFINITE, F.lit(float("inf"))).when(exponent == 0, fraction * F.lit(LEAST)).otherwise(normal)
    )
    return F.when(key < 0, -found).otherwise(found)


def long_form(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(number of the column, key) of every value of numeric columns; see ``with_key``."""
    kinds = dict(df.select(*[F.col(c) for c in columns.values()]).dtypes)
    parts = []
    for integral, kind in ((True, "bigint"), (False, "double")):
        own = {i: c for i, c in columns.items() if (kinds[c] in INTEGRAL) == integral}
        cells = [F.struct(F.lit(i).alias("series"), F.col(c).cast(kind).alias("value")) for i, c in own.items()]
        if cells:
            parts.append(with_key(df.select(F.inline(F.array(*cells))), integral))
    return union_all(parts)


def _inside(wanted: Column, before: Column, n: Column) -> Column:
    hit = F.filter(wanted, lambda w: (w["rank"] >= before) & (w["rank"] < before + n))
    return F.transform(hit, lambda w: F.struct(w["slot"].alias("slot"), (w["rank"] - before).alias("rank")))


def _slots(probabilities: Column, total: Column) -> Column:
    """Slot 2i is the rank just below the i-th probability, slot 2i + 1 the one just above."""
    position = lambda p: p * (total - 1)
    return F.flatten(
        F.transform(
            probabilities,
            lambda p, i: F.array(
                F.struct((i * 2).alias("slot"), F.floor(position(p)).alias("rank")),
                F.struct((i * 2 + 1).alias("slot"), F.ceil(position(p)).alias("rank")),
            ),
        )
    )


def _pass(
    rows: DataFrame, keys: list[str], shift: int, probabilities: Column, open_: DataFrame | None, weight: str | None, hint
) -> DataFrame:
    """(keys, cell, least, most, total, wanted): the cells of this digit that hold a wanted rank, with the
    ranks now counted inside the cell. ``open_`` has the cells of the digit before that are still to be looked into."""
    n = (F.coalesce(F.sum(weight), F.lit(0).cast("bigint")) if weight else F.count(F.lit(1))).alias("n")
    cell = F.shiftright("key", shift).alias("cell")
    aggregates = [n, F.min("key").alias("least"), F.max("key").alias("most")]
    if open_ is None:
        own = Window.partitionBy(*keys)
        counts = rows.groupBy(*keys, cell).agg(*aggregates).withColumn("total", F.sum("n").over(own))
        counts = counts.withColumn("wanted", _slots(probabilities, F.col("total")))
    else:
        named = open_.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("cell").alias("_cell"), "total", "wanted")
        before = SHIFTS[SHIFTS.index(shift) - 1]
        looked = lambda whole: reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.shiftright(whole, before - shift).eqNullSafe(F.col("_cell"))
        )
        inner = rows.withColumn("cell", cell).join(hint(named.drop("total", "wanted")), looked(F.col("cell")), "left_semi")
        counts = inner.groupBy(*keys, "cell").agg(*aggregates)
        counts = counts.join(hint(named), looked(F.col("cell"))).drop(*[f"_{k}" for k in keys])
        own = Window.partitionBy(*keys, "_cell")
    running = own.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("before", F.sum("n").over(running) - F.col("n"))
    counts = counts.withColumn("wanted", _inside(F.col("wanted"), F.col("before"), F.col("n")))
    return counts.where(F.size("wanted") > 0).select(*keys, "cell", "least", "most", "total", "wanted")


def ranked_values(
    values: DataFrame,
    keys: list[str],
    probabilities: Column,
    bounded: bool,
    weight: str | None = None,
) -> DataFrame:
    """Quantiles of ``value`` per group: ``keys``, probability, quantile. The passes run when this is called.

    ``probabilities`` is an array column over the keys. There may be any number of groups: each pass writes its
    cells to the shared scratch folder. ``bounded`` states that the number of groups has a fixed small
    bound, which is what permits the broadcast of the open cells. ``weight`` names a column with the
    number of rows a value stands for. Null values count for nothing.
    """
    spark, hint = values.sparkSession, F.broadcast if bounded else (lambda d: d)
    integral = dict(values.dtypes)["value"] in INTEGRAL
    rows = with_key(values.select(*keys, "value", *([weight] if weight else [])), integral)
    settled, open_ = [], None
    for shift in SHIFTS:
        path = f"{work_dir(spark)}/rank-cells"
        found = _pass(rows, keys, shift, probabilities, open_, weight, hint)
        found.write.parquet(path)
        found = spark.read.schema(found.schema).parquet(path)
        settled.append(found.where(F.col("least") == F.col("most")))
        open_ = found.where(F.col("least") < F.col("most"))
        if open_.isEmpty():
            break
    found = union_all([f.select(*keys, "total", "least", F.inline("wanted")) for f in settled])
    value = F.col("least").cast("double") if integral else _key_column_value(F.col("least"))
    at = lambda side: F.max(F.when(F.col("slot") % 2 == side, F.col("value")))
    p = F.get(probabilities, F.col("_i"))
    share = p * (F.col("total") - 1) - F.floor(p * (F.col("total") - 1))
    return (
        found.withColumn("value", value)
        .groupBy(*keys, "total", F.floor(F.col("slot") / 2).cast("int").alias("_i"))
        .agg(at(0).alias("_low"), at(1).alias("_high"))
        .select(
            *keys,
            p.alias("probability"),
            F.when(F.col("_low") == F.col("_high"), F.col("_low"))
            .otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * share)
            .alias("quantile"),
        )
    )


def _literal(value) -> Column:
    if isinstance(value, list):
        return F.array(*map(_literal, value))
    return F.struct(*map(_literal, value)) if isinstance(value, tuple) else F.lit(value)


def _listed(df: DataFrame, rows: list[tuple], shape: str) -> DataFrame:
    """A frame of a few literal rows."""
    return df.sparkSession.range(1).select(F.inline(_literal(rows).cast(f"array<struct<{shape}>>")))


def quantile_values(df: DataFrame, points: dict[str, list[float]]) -> dict[tuple[str, float], float]:
    """Exact quantiles of numeric columns by (column, probability); none for a column without any value.

    All columns share the passes, which run when this is called. At most two cells per requested quantile come
    to the driver after each pass and go back as literals.
    """
    columns = [c for c, ps in points.items() if ps]
    if not columns:
        return {}
    kinds = dict(df.dtypes)
    rows = long_form(df, dict(enumerate(columns)))
    lists = F.array(*[F.array(*[F.lit(float(p)) for p in points[c]]) for c in columns])
    found: dict[tuple[int, int], tuple[int, int]] = {}
    open_ = None
    for shift in SHIFTS:
        cells = _pass(rows, ["series"], shift, F.get(lists, F.col("series")), open_, None, F.broadcast).collect()
        for c in cells:
            if c["least"] == c["most"]:
                found |= {(c["series"], w["slot"]): (c["least"], c["total"]) for w in c["wanted"]}
        left = [c for c in cells if c["least"] < c["most"]]
        if not left:
            break
        literals = [(c["series"], c["cell"], c["total"], [(w["slot"], w["rank"]) for w in c["wanted"]]) for c in left]
        open_ = _listed(df, literals, "series:int,cell:bigint,total:bigint,wanted:array<struct<slot:int,rank:bigint>>")
    values = {}
    for i, c in enumerate(columns):
        decode = float if kinds.get(c) in INTEGRAL else key_value
        for k, p in enumerate(points[c]):
            if (i, 2 * k) in found:
                (low, total), (high, _) = found[i, 2 * k], found[i, 2 * k + 1]
                low, high, position = decode(low), decode(high), float(p) * (total - 1)
                values[c, float(p)] = low if low == high else low + (high - low) * (position - math.floor(position))
    return values


def quantiles(df: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """Exact quantiles of numeric columns: (column, probability, quantile). See ``quantile_values``.

    ``points`` maps each column to its probabilities. A column without any value has no rows.
    """
    rows = [(c, p, q) for (c, p), q in quantile_values(df, points).items()]
    return _listed(df, rows, "column:string,probability:double,quantile:double")


def approx_quantiles(df: DataFrame, points: dict[str, list[float]], accuracy: int = 10_000) -> DataFrame:
    """Opt-in approximate form: one pass, an actual value within 1/accuracy of the rank."""
    row = df.agg(
        *[
            F.percentile_approx(c, F.array(*[F.lit(float(p)) for p in ps]), F.lit(accuracy)).cast("array<double>").alias(c)
            for c, ps in points.items()
        ]
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(float(p)).alias("probability"), F.col(c)[i].alias("quantile")
        )
        for c, ps in points.items()
        for i, p in enumerate(ps)
    ]
    return row.select(F.inline(F.array(*cells))).where(F.col("quantile").isNotNull())

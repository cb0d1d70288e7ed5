"""Column expressions shared by the operators.

Everything here stays inside Catalyst: no Python runs per row.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ntz(moment: datetime | str) -> Column:
    """Wall-clock timestamp literal. A zone on ``moment`` is dropped, its clock reading kept."""
    if isinstance(moment, datetime):
        moment = moment.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def holds(condition: Column) -> Column:
    """The condition as a two-valued boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def half_even(value: Column, digits: int) -> Column:
    """Round halves to the even neighbour on the scaled float.

    ``F.round`` rounds halves up on the decimal rendering, which gives other results.
    """
    scale = float(10**digits)
    # Adding 0.0 turns a negative zero into a plain one.
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; null where ``whole`` is 0."""
    return half_even(F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0), digits)


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds between two wall-clock timestamps, free of zone and DST effects.

    The difference of two zone-free timestamps is a plain interval; read as seconds it is the exact
    number of microseconds, so the double is the same as microseconds / 1e6. This takes two thirds
    of the time of ``timestamp_diff``, which goes through calendar fields.
    """
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes between two wall-clock timestamps."""
    return seconds_between(start, end) / F.lit(60.0)


def speed_mph(miles: Column, minutes: Column, require_nonneg_distance: bool = True) -> Column:
    """Miles per hour, null where the duration (or, if asked, the distance) is unusable."""
    usable = minutes > 0
    if require_nonneg_distance:
        usable = usable & (miles >= 0)
    return F.when(usable, F.try_divide(miles, minutes / F.lit(60.0)))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def label_of(code: Column, labels: dict[int, str]) -> Column:
    """Label of a code; null for a code without one."""
    first, *rest = labels.items()
    chain = F.when(code == first[0], F.lit(first[1]))
    for key, label in rest:
        chain = chain.when(code == key, F.lit(label))
    return chain


def in_bin(value: Column, edges: list[float], index: int) -> Column:
    """True where ``value`` lies in the right-closed bin ``index`` cut by ``edges``."""
    if index == 0:
        return value <= edges[0]
    if index == len(edges):
        return value > edges[-1]
    return (value > edges[index - 1]) & (value <= edges[index])


def row_total(columns: list[str], fill: list[str] = ()) -> Column:
    """Sum of columns from left to right; null if any is, but for those in ``fill`` (taken as 0)."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) if c in fill else F.col(c) for c in columns])


def month_start(year: Column, month: Column) -> Column:
    zero = F.lit(0)
    return F.make_timestamp_ntz(year, month, F.lit(1), zero, zero, zero)


def plus_months(moment: Column, months: int) -> Column:
    """Shift by calendar months and stay a timestamp (``add_months`` would give a date)."""
    return moment + F.make_ym_interval(F.lit(months // 12), F.lit(months % 12))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames, paired up so that the plan is analyzed in few rounds."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionAll(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]

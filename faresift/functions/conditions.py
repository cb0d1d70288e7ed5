"""Named row conditions over trip columns, each a two-valued boolean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faresift import schema as S
from faresift.functions.scalars import all_of, any_of, half_even, holds, row_total


def missing_block() -> Column:
    """All five columns of the block are missing."""
    return all_of([F.col(c).isNull() for c in S.BLOCK_COLUMNS])


def flex_signs() -> dict[str, Column]:
    """The six separate signs of a flex-fare row."""
    signs = {f"{c}_missing": F.col(c).isNull() for c in S.BLOCK_COLUMNS}
    signs["payment_type_zero"] = holds(F.col("payment_type") == S.FLEX_PAYMENT)
    return signs


def flex_segment() -> Column:
    """Row shows all six signs of a flex-fare record."""
    return all_of(list(flex_signs().values()))


def partial_flex_segment() -> Column:
    signs = list(flex_signs().values())
    return any_of(signs) & ~all_of(signs)


def negative(column: str) -> Column:
    return holds(F.col(column) < 0)


def sign_populations() -> dict[str, Column]:
    """Disjoint and overlapping groups of rows by the signs of fare, total and tip."""
    fare, total, tip = negative("fare_amount"), negative("total_amount"), negative("tip_amount")
    return {
        "fare < 0 and total < 0": fare & total,
        "fare < 0 and total >= 0": fare & ~total,
        "fare >= 0 and total < 0": ~fare & total,
        "tip < 0 with fare < 0 and total < 0": tip & fare & total,
        "tip < 0 only": tip & ~fare & ~total,
    }


def strict_residual() -> Column:
    """Total minus all eight parts in whole cents; null unless every part is there."""
    return half_even(F.col("total_amount") - row_total(S.AMOUNT_PARTS), 2)


def lenient_residual() -> Column:
    """Total minus the parts that are there, in whole cents."""
    return half_even(F.col("total_amount") - row_total(S.AMOUNT_PARTS, fill=S.AMOUNT_PARTS), 2)


def unrounded_gap() -> Column:
    """Signed total minus parts, with only the two late surcharges taken as 0, not rounded."""
    return F.col("total_amount") - row_total(S.AMOUNT_PARTS, fill=["congestion_surcharge", "Airport_fee"])


def inconsistent_total() -> Column:
    return holds(F.abs(unrounded_gap()) > S.CENT)

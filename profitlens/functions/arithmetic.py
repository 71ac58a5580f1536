"""Column expressions for totals, means, ratios and scaling.

A sum of doubles depends on the order of addition, that is on the partitioning.
Totals are therefore added up in whole numbers, and means are built on totals.
Nothing is rounded here: what is shown or compared is rounded there.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE = float(1 << 24)  # values are whole multiples of this, whole numbers below it, and two fractions
PART = float(1 << 24)  # the first fraction counts in steps of 2^-24, the other in steps of 2^-48
LIMIT = float(1 << 86)


def finite(value: Column) -> Column:
    """NaN, infinite values and those of 2^86 or more become null."""
    return F.when(F.abs(value) < F.lit(LIMIT), value)


def _pieces(value: Column | str) -> tuple[Column, Column, Column, Column]:
    """Four whole numbers per value, largest unit first; null for a value that does not count."""
    value = finite((F.col(value) if isinstance(value, str) else value).cast("double"))
    large = (value / F.lit(LARGE)).cast("bigint")
    rest = value - large * F.lit(LARGE)
    whole = rest.cast("bigint")
    fraction = (rest - whole) * F.lit(PART)
    coarse = fraction.cast("bigint")
    return large, whole, coarse, F.rint((fraction - coarse) * F.lit(PART)).cast("bigint")


def _joined(large: Column, whole: Column, coarse: Column, fine: Column) -> Column:
    below_one = (coarse + fine / F.lit(PART)) / F.lit(PART)
    return F.coalesce(large * F.lit(LARGE) + (whole + below_one), F.lit(0.0))


def total(value: Column | str) -> Column:
    """Exact sum of the values to 2^-48 (4e-15) each; 0 for a group without values.

    Every value is cut into four whole numbers that integer sums add up in any
    order. Values that are not finite do not count.
    """
    return _joined(*[F.sum(piece) for piece in _pieces(value)])


PARTIALS = ("large", "whole", "coarse", "fine", "n")


#: A sum of the first may come near 2^63 for one row; the others grow by 2^24 a row, so 64 bits hold them for 2^39 rows.
KEPT_TYPES = ("decimal(38, 0)", "bigint", "bigint", "bigint", "bigint")


def partial_sums(value: Column | str, name: str) -> list[Column]:
    """Aggregates that a table can keep: the four sums of ``total``, and how many values counted."""
    pieces = _pieces(value)
    sums = [F.sum(piece) for piece in pieces] + [F.count(pieces[0])]
    return [
        F.coalesce(part, F.lit(0)).cast(kept).alias(f"{name}_{kind}") for part, kind, kept in zip(sums, PARTIALS, KEPT_TYPES, strict=True)
    ]


def exact_sum(parts: Sequence[int]) -> Fraction:
    """The value of the first four kept sums, without rounding."""
    large, whole, coarse, fine = parts
    return large * int(LARGE) + whole + Fraction(coarse, int(PART)) + Fraction(fine, int(PART) ** 2)


def merged_sums(name: str) -> list[Column]:
    """Kept sums of several groups as those of one."""
    return [F.sum(f"{name}_{kind}").cast(kept).alias(f"{name}_{kind}") for kind, kept in zip(PARTIALS, KEPT_TYPES, strict=True)]


def merged_total(name: str) -> Column:
    """``total`` of all rows behind the kept sums, to the same bits."""
    return _joined(*[F.sum(f"{name}_{kind}").cast("double") for kind in PARTIALS[:4]])


def merged_count(name: str) -> Column:
    return F.coalesce(F.sum(f"{name}_n").cast("bigint"), F.lit(0))


def merged_mean(name: str) -> Column:
    return F.try_divide(merged_total(name), merged_count(name))


def mean(value: Column | str) -> Column:
    """Mean over the present values; null when there are none."""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_divide(total(value), F.count(finite(value.cast("double"))))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, null when the divisor is 0 or null."""
    return F.try_divide(top, bottom)


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """``top / bottom`` for a positive divisor, else 0."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def percent(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom) * 100


def percent_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(percent(top, bottom), F.lit(0.0))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant column scales to 0."""
    return F.when(high == low, F.lit(0.0)).otherwise(F.try_divide(value - low, high - low))


def min_max_soft(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1 with a divisor that never is 0."""
    return (value - low) / (high - low + F.lit(1e-9))


def null_if_nan(value: Column) -> Column:
    """NaN becomes null: Spark orders NaN above every number, so ``NaN > 3`` would hold."""
    return F.when(~F.isnan(value), value)


def null_if_not_finite(value: Column) -> Column:
    """NaN and infinite values become null."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def zero_if_not_finite(value: Column) -> Column:
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def holds(condition: Column) -> Column:
    """A condition as a plain boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation over the rows where both sides are present; null for a constant side.

    ``corr`` divides by zero on a constant column in ANSI mode.
    """
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)

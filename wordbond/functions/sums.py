"""Sums of doubles that do not depend on the order of their rows, and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A number is cut into whole multiples of 2**-20, 2**-40 and 2**-60.
_LIMB = 2.0**20
# Numbers of at least this are no scores, and are added as they are.
_LARGE = 2.0**20
# Scaled numbers below this are off by less than an eighth of what must lie between them and a half.
_EXACT, _HALF = 2.0**40, 2.0**-9


def exact_sum(column: Column | str) -> Column:
    """The sum of a double column, the same to the last bit on every partitioning.

    Each number is cut into three whole numbers, which add up in longs without any
    rounding, and only their sums become a double again. What lies below ``2**-60``
    is cut off, number by number, so the sum of n numbers differs from the true one
    by less than ``n * 2**-60``. NaN and infinities give what they do in any order;
    finite numbers of a million and more, which no score is, are added as doubles.
    Nulls are left out; without any number the sum is null.
    """
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    small = F.abs(value) < _LARGE  # NaN is above all numbers
    scaled = F.when(small, value) * _LIMB
    upper = F.floor(scaled)
    rest = (scaled - upper) * _LIMB
    middle = F.floor(rest)
    lower = F.floor((rest - middle) * _LIMB)

    def whole(limb: Column) -> Column:
        return F.sum(limb).cast("decimal(38,0)")

    step = F.lit(int(_LIMB)).cast("decimal(38,0)")
    total = ((whole(upper) * step + whole(middle)) * step + whole(lower)).cast("double") / (_LIMB * _LIMB * _LIMB)
    rare = F.sum(F.when(~small, value))
    return F.when(
        F.count(value) > 0, F.coalesce(total, F.lit(0.0)) + F.coalesce(rare, F.lit(0.0))
    )


def rounded(column: Column | str, digits: int) -> Column:
    """``F.round`` of a double to the last bit, for a third of the time or less.

    Spark rounds the decimal text of a number. A scaled number away from the half between
    two whole ones rounds the same way in floating point, and a whole number divided by a power
    of ten is the double nearest to that decimal. All others take ``F.round``.
    """
    value = F.col(column) if isinstance(column, str) else column
    step = F.lit(10.0**digits)
    scaled = value * step
    clear = (F.abs(scaled) < _EXACT) & (F.abs(scaled - F.floor(scaled) - 0.5) > _HALF)
    return F.when(clear, F.floor(scaled + 0.5) / step).otherwise(F.round(value, digits))

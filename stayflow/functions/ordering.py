"""Whole numbers in the order of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64
_FRACTION = 1 << 52
_LEAST_EXPONENT, _GREATEST_EXPONENT = -1022, 1023
_INFINITE = (_GREATEST_EXPONENT + 1024) * _FRACTION


def _magnitude(value: Column) -> Column:
    """The bits of a finite double that is not negative: exponent, then fraction.

    Dividing by a power of two is exact. The logarithm may be off by one next to a power of two, which the quotient shows.
    """
    logarithm = F.floor(F.log2(value)).cast("int")
    guess = F.least(F.greatest(logarithm, F.lit(_LEAST_EXPONENT)), F.lit(_GREATEST_EXPONENT))
    quotient = value / F.pow(F.lit(2.0), guess)
    above, below = quotient >= 2, (quotient < 1) & (guess > _LEAST_EXPONENT)
    exponent = F.when(above, guess + 1).when(below, guess - 1).otherwise(guess)
    fraction = F.when(above, quotient / 2).when(below, quotient * 2).otherwise(quotient)
    return (exponent - _LEAST_EXPONENT).cast("long") * _FRACTION + (fraction * float(_FRACTION)).cast("long")


def ordered_bits(value: Column) -> Column:
    """A long that grows with the double and is equal for equal ones: its bits, negated below zero.

    Both zeros are 0; infinities lie outside of all finite numbers, NaN above them, null stays null.
    """
    size = F.abs(value)
    bits = F.when(size == 0, F.lit(0)).when(size == float("inf"), F.lit(_INFINITE)).otherwise(_magnitude(size))
    signed = F.when(value < 0, -bits).otherwise(bits)
    return F.when(F.isnan(value), F.lit(_INFINITE + 1)).when(value.isNotNull(), signed)


def leading(bits: Column, count: int) -> Column:
    """The first ``count`` of 64 ordered bits; the order stays, as the sign is kept."""
    return F.shiftright(bits, BITS - count)

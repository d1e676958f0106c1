"""Exact decimal helpers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(28, 2)


def ratio2(num: Column, den: Column) -> Column:
    """``num / den`` to two decimals, half up; NULL when ``den`` is zero.

    Both sides are brought to decimal(18,2) first, so Spark keeps 20 decimals of
    the quotient.  That is more than a two-decimal half point can be approached
    by such operands, hence the second rounding is exact.
    """
    quotient = num.cast(MONEY) / F.nullif(den.cast(MONEY), F.lit(0).cast(MONEY))
    return F.round(quotient, 2).cast(MONEY)


def as_total(col: Column) -> Column:
    return col.cast(TOTAL)


def as_count(col: Column) -> Column:
    return col.cast(T.LongType())


def to_cents(col: Column) -> Column:
    """A two-decimal amount as a whole number of cents.

    Sums of 64-bit cents need a fraction of the time and shuffle space of wide
    decimals.  They hold 92 quadrillion units and fail, not wrap, beyond that; the
    two-decimal ratios stop at 10 quadrillion anyway.
    """
    return (col.cast(MONEY) * 100).cast(T.LongType())


def from_cents(cents: Column) -> Column:
    """Cents, whole or fractional, back to units with every decimal kept."""
    return cents * F.lit(Decimal("0.01"))

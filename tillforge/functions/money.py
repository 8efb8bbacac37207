"""Exact money arithmetic: whole cents, rounded half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
AMOUNT = "decimal(12,2)"
WIDE = "decimal(20,2)"
TOTAL = "decimal(28,2)"


def total(amount: Column) -> Column:
    """Sum of an amount, wide enough for 10^24 units and equal in every engine."""
    return F.sum(amount).cast(TOTAL)


def half_up(numerator: Column, denominator: Column) -> Column:
    """Nearest whole number to a ratio; ties go away from zero.

    Works on integers only, so no double and no intermediate rounding is involved.
    """
    n = numerator.cast("decimal(38,0)")
    d = denominator.cast("decimal(18,0)")
    magnitude = F.call_function("div", F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    return F.when((n < 0) != (d < 0), -magnitude).otherwise(magnitude)


def cents(amount: Column) -> Column:
    """Amount with two decimals as a whole number of cents."""
    return (amount * 100).cast("decimal(36,0)")


def from_cents(whole: Column, kind: str = TOTAL) -> Column:
    """Whole cents back to an amount with two decimals."""
    return (whole.cast("decimal(26,0)") / 100).cast(kind)


def average(amount: Column) -> Column:
    """Average of an amount rounded to two decimals, NULLs ignored."""
    return from_cents(half_up(cents(F.sum(amount)), F.count(amount)))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, two decimals, for whole numbers; NULL when whole is 0."""
    scaled = part.cast("decimal(26,0)") * 10000
    return F.when(whole > 0, from_cents(half_up(scaled, whole), "decimal(9,2)"))

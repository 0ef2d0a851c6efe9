"""Ratios with an explicit zero-denominator rule.

Modes for a zero (or, in "zero" mode, non-positive or NULL) denominator:
  "zero": 0.0 (the SQL mart rule: ``CASE WHEN den > 0 THEN ... ELSE 0``)
  "ieee": +inf / -inf for x/0, NaN for 0/0 (the pandas rule); NULL input stays NULL
  "null": NULL
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("zero", "ieee", "null")


def _d(c: Column) -> Column:
    # numbers convert as a cast does; text that is not a number becomes NULL, never an error
    return c.try_cast("double")


def ratio(num: Column, den: Column, on_zero: str = "null") -> Column:
    num, den = _d(num), _d(den)
    if on_zero == "zero":
        return F.when(den > 0, num / den).otherwise(F.lit(0.0))
    if on_zero == "null":
        return F.try_divide(num, den)
    if on_zero == "ieee":
        return (
            F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
            .when(den != 0, num / den)
            .when(num > 0, F.lit(float("inf")))
            .when(num < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan")))
        )
    raise ValueError(f"on_zero must be one of {MODES}, got {on_zero!r}")


def per90_guarded(x: Column, minutes: Column) -> Column:
    """Mart rule: ``x * 90 / minutes`` when minutes > 0, else 0."""
    m = _d(minutes)
    return F.when(m > 0, _d(x) * 90.0 / m).otherwise(F.lit(0.0))


def per90(x: Column, minutes: Column, on_zero: str = "ieee") -> Column:
    """Live rule: ``x / (minutes / 90)``."""
    return ratio(x, _d(minutes) / 90.0, on_zero)


def price(now_cost: Column) -> Column:
    """Cost is stored in tenths."""
    return _d(now_cost) / 10.0


def round_half_even(c: Column, scale: int = 2) -> Column:
    """Half to even on the binary value: ``rint(x * 10^s) / 10^s`` (numpy's ``round``)."""
    factor = float(10 ** scale)
    return F.rint(c.cast("double") * factor) / factor


def round_fixed(c: Column, decimals: int = 6) -> Column:
    """Round half to even on the binary value: ``rint(x * 10^d) / 10^d``, at every magnitude.

    Plain IEEE arithmetic, so any engine doing the same operations gets the same double
    (``round`` rounds the shortest decimal text instead, which differs at exact ties).
    Infinities and NaN stay what they are.
    """
    scale = float(10 ** decimals)
    return F.rint(c.cast("double") * scale) / scale

"""Exact money, order-free averages and the rounding rules of the data model.

Sums run on decimals, so a retried or differently merged partial aggregate gives
the same figure. Ratios are brought back to a fixed number of decimals before
they are summed again, for the same reason.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATE = "decimal(28,6)"  # sums and squares of large series fit


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: Column | str) -> Column:
    return col(c).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """Double quotient, NULL for a zero or missing divisor."""
    return F.try_divide(dbl(a), dbl(b))


def fixed(c: Column | str) -> Column:
    """Six-decimal value of a double, halves going up."""
    v = dbl(c)
    # Above 2^33 a double has no more than six decimals, and scaling it first would leave the range of a long.
    units = F.floor(F.when(F.abs(v) < 2.0**33, v) * 1e6 + 0.5).cast("decimal(18,0)")
    return F.coalesce((units * F.lit(Decimal("0.000001"))).cast(RATE), v.cast(RATE))


def mean_of(c: Column | str) -> Column:
    """Average as exact sum over count."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)))


def money_sum(c: Column | str) -> Column:
    return F.sum(col(c)).cast(MONEY)


def rate_sum(c: Column | str) -> Column:
    return F.sum(col(c)).cast(RATE)


def cents(c: Column | str) -> Column:
    """Two decimals, halves to even on the scaled value."""
    return F.rint(dbl(c) * 100) / 100


def depth_step(percent: Column) -> Column:
    """Round a discount to steps of 5 above 5 %, to steps of 2.5 from 0 to 5 %."""
    p = dbl(percent)
    return F.when(p > 5, F.round(p / 5) * 5).when(p >= 0, F.round(p / 2.5) * 2.5)


def plain(c: Column | str) -> Column:
    """Number as text without trailing zeros: 15.0 -> 15, 2.50 -> 2.5."""
    text = col(c).cast("string")
    fraction = F.contains(text, F.lit(".")) & ~F.contains(text, F.lit("E"))  # an exponent keeps its zeros
    return F.when(fraction, F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)


def percent_off(step: Column) -> Column:
    return F.concat(plain(step), F.lit("% off"))

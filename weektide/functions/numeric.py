"""Arithmetic shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weektide.schema import AMOUNT_DIGITS

# Bits of an amount that go to the lower accumulator of an exact sum.
_LOW_BITS = 20


def rnd(col: Column, digits: int) -> Column:
    """Half-up rounding that ignores binary noise, as DOUBLE.

    The value is first taken to a decimal four digits finer than asked, which
    removes the part of a floating-point sum that depends on row order.  NaN
    and infinities become NULL.
    """
    return F.round(col.try_cast(f"decimal(38,{digits + 4})"), digits).cast("double")


def fixed_sum(col: Column) -> Column:
    """SUM of amounts as DOUBLE, exact for amounts with up to four decimals; NULL over
    no rows.

    Such amounts are added as whole ten-thousandths.  Their upper and lower parts are
    summed separately, so both accumulators are machine words (a DECIMAL
    accumulator costs several times the scan) and neither overflows below 10^12
    rows of any amount a DOUBLE holds exactly.  Amounts that are finer, or too large
    for whole ten-thousandths in a word, go to a third, floating accumulator: none is
    lost.  NaN counts as missing.
    """
    scale = 10**AMOUNT_DIGITS
    value = col.cast("double")
    value = F.when(~F.isnan(value), value)
    scaled = value * scale
    units = F.rint(scaled)
    # Binary noise of an amount with four decimals stays far below this.
    fits = (F.abs(units) < 2.0**62) & (
        F.abs(scaled - units) <= F.greatest(F.lit(1e-3), F.abs(units) * 1e-12)
    )
    whole = F.when(fits, units.cast("bigint"))
    upper = F.sum(F.shiftright(whole, _LOW_BITS)).cast("decimal(20,0)")
    lower = F.sum(whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    exact = (upper * (1 << _LOW_BITS) + lower).cast("double") / scale
    other = F.sum(F.when(~fits, value))
    return F.when(
        exact.isNotNull() | other.isNotNull(),
        F.coalesce(exact, F.lit(0.0)) + F.coalesce(other, F.lit(0.0)),
    )


def fixed_mean(col: Column) -> Column:
    """Mean of amounts, from the exact sum; NULL over no rows."""
    return ratio(fixed_sum(col), F.count(col))


def total(col: Column) -> Column:
    """Exact sum of amounts that is 0 over no rows."""
    return F.coalesce(fixed_sum(col), F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` in DOUBLE, NULL for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL for a zero denominator."""
    return rnd(ratio(num, den) * 100, digits)


def percent_or_zero(num: Column, den: Column, digits: int = 2) -> Column:
    """Rounded percentage, 0 unless the denominator is positive."""
    return F.when(den > 0, percent(num, den, digits)).otherwise(F.lit(0.0))


def is_close(a: Column, b: Column, atol: float, rtol: float = 1e-5) -> Column:
    """``|a - b| <= atol + rtol * |b|``."""
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)

"""Rounding with one exact meaning each.

`round_binary` rounds the exact binary value half to even, as IEEE-correct decimal formatting does.
`ratio_units` is exact integer arithmetic, half up, for ratios of counts and sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIE_BAND = 1e-6


def round_binary(x: Column, digits: int) -> Column:
    """Round a double to `digits` decimals from its exact binary value, ties to even.

    Away from a tie, scaling and flooring gives the same double and is cheap. Only values within a
    hair of a tie go through decimal formatting, which reads the exact binary value.
    """
    scale = float(10**digits)
    scaled = x * F.lit(scale)
    near_tie = F.abs(scaled - F.floor(scaled) - F.lit(0.5)) < F.lit(_TIE_BAND)
    exact = F.translate(F.format_number(x, digits), ",", "").cast("double")
    plain = F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(near_tie, exact).otherwise(plain)


def int_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)


def ratio_units(num: Column, den: Column, digits: int) -> Column:
    """num/den as an integer count of 10^-digits, half up; NULL where den is 0. Both sides >= 0.

    Splitting off the whole part keeps the products far below the long range even for sums over
    10^12 rows.
    """
    scale = 10**digits
    num = num.cast("long")
    den = F.nullif(den.cast("long"), F.lit(0).cast("long"))
    rest = num % den
    return int_div(num, den) * F.lit(scale) + int_div(rest * F.lit(2 * scale) + den, den * F.lit(2))


def percent(num: Column, den: Column) -> Column:
    """num/den in percent with two decimals; NULL where den is 0."""
    return ratio_units(num * F.lit(100), den, 2) / F.lit(100.0)


def mean2(total: Column, n: Column) -> Column:
    """Mean of integers with two decimals, half away from zero; NULL for no rows."""
    size = ratio_units(F.abs(total), n, 2) / F.lit(100.0)
    return F.when(total < 0, -size).otherwise(size)


def stable_hash(*parts: Column) -> Column:
    """A non-negative long from the MD5 of the parts as text, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")

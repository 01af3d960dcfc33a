"""Numeric parsing, rounding and ratios.

Two rounding families live side by side on purpose: reports round half away
from zero and return NULL on a zero denominator; the product review and
snapshot use a zero default, and the review's text rounds half to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,10)"


def repair_number(c: Column) -> Column:
    """Collapse repeated decimal points: ``776..03`` -> ``776.03``."""
    return F.regexp_replace(c, r"\.{2,}", ".")


def floor_int(c: Column) -> Column:
    return F.floor(c.cast(WIDE)).cast("int")


def money(c: Column) -> Column:
    return c.cast("decimal(14,2)")


def rate(c: Column) -> Column:
    return c.cast("decimal(12,6)")


def lenient_decimal(c: Column) -> Column:
    """NULL, blank or unparseable text counts as zero."""
    return F.coalesce(c.try_cast(WIDE), F.lit(0).cast(WIDE))


def fixed_text(c: Column, places: int) -> Column:
    """Fixed-place text, ties to even."""
    return F.bround(c, places).cast(f"decimal(38,{places})").cast("string")


def safe_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """``round(n / d)`` half away from zero; NULL when the denominator is zero.

    The operand types keep at least 16 fraction digits in the quotient, so the
    final rounding sees the true value for any count below ten billion.
    """
    n = numerator.cast("decimal(24,2)")
    d = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(n / d, places)


def exact_ratio(numerator: Column, denominator: Column, places: int, half_even: bool) -> Column:
    """Quotient of two wide decimals rounded once, from the exact remainder.

    Dividing two wide decimals directly leaves only six fraction digits, and
    rounding that again can move a tie. The denominator must not be zero.
    """
    scaled = F.abs(numerator).cast("decimal(28,10)") * F.lit(10**places).cast("decimal(7,0)")
    divisor = F.abs(denominator).cast("decimal(28,10)")
    rest = scaled % divisor
    whole = ((scaled - rest) / divisor).cast("decimal(28,0)")
    twice = rest * F.lit(2).cast("decimal(1,0)")
    if half_even:
        up = (twice > divisor) | ((twice == divisor) & (whole % 2 == 1))
    else:
        up = twice >= divisor
    units = F.when(up, whole + 1).otherwise(whole).cast("decimal(28,0)")
    signed = F.when((numerator < 0) != (denominator < 0), -units).otherwise(units)
    # Moving the decimal point is exact.
    return (signed * F.lit(f"{10.0 ** -places:.{places}f}").cast(f"decimal({places + 1},{places})")).cast(
        f"decimal(38,{places})"
    )


def ratio_or_zero(numerator: Column, denominator: Column, places: int, half_even: bool) -> Column:
    zero = F.lit(0).cast(f"decimal(38,{places})")
    return F.when(denominator != 0, exact_ratio(numerator, denominator, places, half_even)).otherwise(zero)

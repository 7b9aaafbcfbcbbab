"""Money, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(column: Column, scale: int = 2) -> Column:
    """Round a double as SQL engines with binary doubles do: scale, round half away from zero, scale back.

    Spark's own `round(x, 2)` goes through the decimal text of the double, so 1.005 would become 1.01.
    """
    factor = F.lit(float(10 ** scale))
    return F.round(column * factor, 0) / factor


def round_half_even(column: Column, scale: int = 2) -> Column:
    """Round a double as numpy does; used for figures that were rounded in a data frame, not in SQL."""
    factor = F.lit(float(10 ** scale))
    return F.rint(column * factor) / factor


def divide(numerator: Column, denominator: Column, integer: bool = False) -> Column:
    """Quotient, null for a zero divisor. `integer` truncates, as a division of two bigints does in SQL engines."""
    divisor = F.nullif(denominator, F.lit(0))
    if not integer:
        return numerator / divisor
    return F.call_function("div", numerator, divisor)


def safe_ratio(numerator: Column, denominator: Column, scale: int = 2, integer: bool = False) -> Column:
    return round_half_up(divide(numerator, denominator, integer).cast("double"), scale)


def as_money(column: Column, strict: bool = False) -> Column:
    """Double from a number or text. Bad text is null; with `strict` it is an error, whatever the session makes of casts."""
    value = column.try_cast("double")
    if not strict:
        return value
    bad = F.raise_error(F.concat(F.lit("CAST_INVALID_INPUT: no amount of money: "), column.cast("string")))
    return F.when(column.isNotNull() & value.isNull(), bad).otherwise(value)


def sum_money(column: Column, strict: bool = False) -> Column:
    return F.sum(as_money(column, strict))

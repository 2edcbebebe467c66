"""Numeric column helpers that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INFINITY = float("inf")


def finite(value: Column) -> Column:
    """The value, or NULL for NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(INFINITY)), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL on a zero divisor."""
    return F.try_divide(numerator, denominator)


def ieee_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NaN or an infinity on a zero divisor, as plain double arithmetic does."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    on_zero = (
        F.when(top > 0, F.lit(INFINITY)).when(top < 0, F.lit(-INFINITY)).when(top.isNotNull(), F.lit(float("nan")))
    )
    return F.when(bottom == 0, on_zero).otherwise(F.try_divide(top, bottom))


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, each cut to whole seconds first."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def general_format(value: Column, digits: int = 6, sign: bool = False) -> Column:
    """Shortest text with ``digits`` significant digits, the way printf ``%g`` writes it.

    A decimal half is rounded up.
    """
    flag = "+" if sign else ""
    scientific = F.format_string(f"%{flag}.{digits - 1}e", value)
    exponent = F.regexp_extract(scientific, r"e([+-]\d+)$", 1).cast("int")
    decimals = F.greatest(F.lit(digits - 1) - exponent, F.lit(0))
    fixed = F.call_function("format_string", F.concat(F.lit(f"%{flag}."), decimals.cast("string"), F.lit("f")), value)
    mantissa = F.regexp_extract(scientific, r"^(.*)e", 1)
    trim = lambda text: F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    short = trim(mantissa)
    return (
        F.when(F.isnan(value) | value.isNull(), F.lit("nan"))
        .when(F.abs(value) == F.lit(INFINITY), F.when(value > 0, F.lit(f"{flag}inf")).otherwise(F.lit("-inf")))
        .when((exponent >= -4) & (exponent < digits), trim(fixed))
        .otherwise(F.concat(short, F.regexp_extract(scientific, r"(e[+-]\d+)$", 1)))
    )


def morton(col: Column, row: Column) -> Column:
    """The place of a column and row, each from -2**30 to 2**30, on the Morton curve: their bits in turn."""

    def apart(value: Column) -> Column:
        spaced = (value + (1 << 30)).cast("bigint")
        # the halves of each group of bits go apart, down to single bits (fixed values)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            spaced = spaced.bitwiseOR(F.shiftleft(spaced, shift)).bitwiseAND(F.lit(mask))
        return spaced

    return apart(col).bitwiseOR(F.shiftleft(apart(row), 1))

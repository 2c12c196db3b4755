"""Numeric coercion of raw text and the number formats of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_number(text: Column) -> Column:
    """Stripped text to double, or null when it is not a plain decimal number.

    The pattern keeps Java-only spellings such as ``1d`` out of the cast.
    """
    number = F.when(text.rlike(_DECIMAL_TEXT), text).try_cast("double")
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def to_count(text: Column) -> Column:
    """Whole number cut towards zero, 0 when missing or not numeric."""
    return F.coalesce(to_number(text).try_cast("bigint"), F.lit(0).cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that answers 0 for an empty or zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")),
                      F.lit(0.0))


def one_decimal(value: Column) -> Column:
    """Text with one decimal, halves away from zero, no thousands separator; null stays null."""
    return F.when(value.isNotNull(), F.format_string("%.1f", F.round(value, 1)))


def hours_minutes(hours: Column) -> Column:
    """H7: ``1h 48m``; floor on both parts, also below zero; ``n/a`` when empty."""
    whole = F.floor(hours)
    minutes = F.floor((hours - whole) * 60)
    return F.coalesce(
        F.concat(whole.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m")),
        F.lit("n/a"))

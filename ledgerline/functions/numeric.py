"""Decimal checks on text and on typed numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted number syntax, and the words that parse but are not finite.
NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
NOT_FINITE_TEXT = r"(?i)^[+-]?(nan|snan|inf|infinity)$"
# At most two fraction digits once trailing zeros are dropped (100.000 passes).
TWO_PLACES_TEXT = r"^[+-]?([0-9]+(\.[0-9]{0,2}0*)?|\.[0-9]{1,2}0*)$"

WIDE = T.DecimalType(38, 18)
WHOLE_DIGIT_LIMIT = 16  # DECIMAL(18,2): 16 whole digits


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.IntegralType)


def number_value(c: Column, dtype: T.DataType, stripped: Column | None = None) -> Column:
    """The value as DECIMAL(38,18); null for overflow, non-numbers and non-finite floats."""
    if is_text(dtype):
        s = stripped if stripped is not None else c
        return F.when(s.rlike(NUMBER_TEXT), s.try_cast(WIDE))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c.try_cast(WIDE))
    return c.try_cast(WIDE)


def two_places(c: Column, dtype: T.DataType, value: Column, stripped: Column | None = None) -> Column:
    """True when the number has at most two fraction digits (trailing zeros free)."""
    if is_text(dtype):
        s = stripped if stripped is not None else c
        return F.when(s.rlike(PLAIN_NUMBER_TEXT), s.rlike(TWO_PLACES_TEXT)).otherwise(value == F.round(value, 2).cast(WIDE))
    if isinstance(dtype, T.DecimalType) and dtype.scale <= 2:
        return F.lit(True)
    if is_integral(dtype):
        return F.lit(True)
    # Compare with the value rounded to two places, cast back to the same DECIMAL(38,18):
    # ``value * 100`` or a comparison of two decimal types widens past precision 38 and
    # drops the tiny fractions of exponent forms.
    return value == F.round(value, 2).cast(WIDE)


def whole_digits_ok(value: Column) -> Column:
    return F.abs(value) < F.lit(10**WHOLE_DIGIT_LIMIT).cast(WIDE)

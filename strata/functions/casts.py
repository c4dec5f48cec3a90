"""Text-to-number casts that yield NULL on bad input, whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType

# Text that is a whole number or a decimal inside optional blanks or control
# characters. Up to ten digits after leading zeros can be an INT; more always overflow.
_BLANKS = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANKS}[+-]?0*[0-9]{{1,10}}([.][0-9]*)?{_BLANKS}$"
_BELOW_ONE = rf"^{_BLANKS}[+-]?[.][0-9]*{_BLANKS}$"


def lenient_int(value: Column) -> Column:
    """Text to INT: blanks ignored, decimals truncated toward zero, anything else NULL.

    The patterns come first because a failing ``try_cast`` raises and catches an exception
    inside the engine, which on dirty data costs ten times as much as the whole row.
    """
    text = value.cast("string")
    whole = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(_WHOLE), whole).when(text.rlike(_BELOW_ONE), F.lit(0))


def lenient_double(value: Column) -> Column:
    """Text to DOUBLE, exponents, NaN and infinities included; anything else NULL."""
    return value.try_cast("double")


def lenient(value: Column, target: DataType) -> Column:
    """Cast ``value`` to the type a schema declares."""
    if isinstance(target, IntegerType):
        return lenient_int(value)
    if isinstance(target, DoubleType):
        return lenient_double(value)
    return value.cast(target)

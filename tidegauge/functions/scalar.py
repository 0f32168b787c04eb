"""Scalar column functions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the outputs must carry.
LATE_TEXT = "*** late reading *** "
FREEZING_TEXT = "Freezing Alarm for "
FIRE_TEXT = "Risk of fire! "
RISE_TEXT = ("Temperature of sensor '", "' monotonically increased for 1 second.")

# What separates words, as a pattern and as characters.
ONE_SPACE = (" ", " ")
WHITESPACE = (r"[ \t\n\x0B\f\r]+", " \t\n\x0b\f\r")

# doubles from here on are spaced too widely to have three decimal places
EXACT_BELOW = 1e14


def to_celsius(temperature: Column) -> Column:
    return (temperature - F.lit(32.0)) * F.lit(5.0 / 9.0)


def as_decimal(value: Column) -> Column:
    """The decimal a double prints as, so that ties are ties on paper."""
    return F.when(F.abs(value) < EXACT_BELOW, value).cast("string").cast("decimal(30,15)")


def _or_itself(rounded: Column, value: Column) -> Column:
    """Values that have no three decimal places (huge ones, NaN) are their own rounding."""
    return F.when(F.abs(value) < EXACT_BELOW, rounded).otherwise(value)


def round_half_up(value: Column, places: int = 3) -> Column:
    return _or_itself(F.round(as_decimal(value), places).cast("double"), value)


def round_half_down(value: Column, places: int = 3) -> Column:
    scale = 10**places
    exact = as_decimal(value)
    steps = F.ceil(F.abs(exact) * F.lit(scale) - F.lit(0.5).cast("decimal(2,1)"))
    # the division of two whole numbers is the nearest double to the decimal
    return _or_itself(F.signum(value) * (steps.cast("double") / F.lit(float(scale))), value)


def exceeds(value: Column, threshold: float, inclusive: bool = False) -> Column:
    """A plain comparison: NaN is not above anything."""
    return (value >= threshold if inclusive else value > threshold) & ~F.isnan(value)


def split_words(line: Column, separator: tuple[str, str] = ONE_SPACE) -> Column:
    """Words of a line; leading and inner empty words stay, trailing ones go.

    An empty line is one empty word; a line of separators only has no words.
    """
    pattern, characters = separator
    trimmed = F.rtrim(line, F.lit(characters))
    words = F.split(trimmed, pattern)
    only_separators = (trimmed == "") & (line != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(words)


def reading_text(id_: Column, timestamp: Column, temperature: Column) -> Column:
    return F.concat(
        F.lit("SensorReading("), id_, F.lit(", "), timestamp.cast("string"),
        F.lit(", "), temperature.cast("string"), F.lit(")"),
    )


def int_to_bytes(number: Column) -> Column:
    """Four bytes, most significant first, two's complement."""
    digits = F.hex(number.cast("int").cast("bigint"))
    return F.unhex(F.right(F.concat(F.lit("00000000"), digits), F.lit(8)))


def bytes_to_int(value: Column) -> Column:
    unsigned = F.conv(F.hex(value), 16, 10).cast("bigint")
    signed = F.when(unsigned >= 2**31, unsigned - F.lit(2**32)).otherwise(unsigned)
    return signed.cast("int")

"""Text and number conversions with the source database's rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that read as a number; no type suffixes such as '8d'.
NUMBER_PATTERN = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
)


def text_to_int(text: Column) -> Column:
    """'8.0' is 8, '8.5' is 9, '1e1' is 10; anything else is null.

    A plain string-to-int cast gives null for all three, and going through double
    would read '8d' as 8, so the detour is by decimal.
    """
    return F.round(text.try_cast("decimal(38,10)"), 0).try_cast("int")


def text_to_load(text: Column) -> Column:
    """Load in kg; text that is no number, or too large, is null."""
    return text.try_cast("decimal(6,2)")


def strip(text: Column) -> Column:
    """Drop white space of every kind at both ends (``trim`` drops blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def last_word_int(text: Column) -> Column:
    """The last word as a whole number, null when it isn't one."""
    return F.regexp_extract(text, r"(?U)(?<!\S)(\S++)\s*$", 1).try_cast("int")


def clock_text(text: Column) -> Column:
    """'7:05' and '07:05:00' as '07:05:00'; null when it is no time of day."""
    hour = F.regexp_extract(text, r"^\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d*)?)?\s*$", 1)
    minute = F.regexp_extract(text, r"^\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d*)?)?\s*$", 2)
    second = F.regexp_extract(text, r"^\s*(\d{1,2}):(\d{2})(?::(\d{2})(?:\.\d*)?)?\s*$", 3)
    second = F.when(second == "", F.lit("00")).otherwise(second)
    valid = (hour != "") & (hour.try_cast("int") < 24) & (minute.try_cast("int") < 60) & (
        second.try_cast("int") < 60
    )
    return F.when(valid, F.concat_ws(":", F.lpad(hour, 2, "0"), minute, second))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; null when the whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), 1)


def one_decimal(number: Column) -> Column:
    """Text with one decimal, rounded from the exact binary value, ties to even, as the
    C and Python formats do: 82.25 is '82.2'. (Java's format would give '82.3'.)

    The fraction is taken as a whole number of 2^-58 units, exact for sizes from 1/64 up.
    """
    size = F.abs(number)
    whole = F.floor(size).cast("bigint")
    tenths = ((size - whole) * F.lit(float(1 << 58))).cast("bigint") * 10
    digit = F.shiftright(tenths, 58)
    rest = tenths.bitwiseAND(F.lit((1 << 58) - 1))
    half = F.lit(1 << 57)
    up = ((rest > half) | ((rest == half) & (digit % 2 == 1))).cast("bigint")
    total = whole * 10 + digit + up
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(total / 10).cast("string"), F.lit("."),
                    (total % 10).cast("string"))

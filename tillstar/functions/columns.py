"""Column helpers: text cleaning and exact text-to-value conversions.

All of them are built-in expressions, so they stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar import fixed_values as fixed


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Strip spaces (U+0020 only: tabs and no-break spaces are content)."""
    return F.trim(_column(c))


def norm_key(c: Column | str) -> Column:
    """Name-matching key: lower case without outer spaces; inner spaces count."""
    return F.trim(F.lower(_column(c)))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, or NULL when nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def is_number_text(c: Column | str) -> Column:
    """Plain decimal text: digits with an optional fraction, nothing else."""
    return trimmed(c).rlike(fixed.NUMBER_PATTERN)


def parse_serial_date(c: Column | str) -> Column:
    """Spreadsheet day number to DATE, half days to the even number; else NULL."""
    days = F.rint(trimmed(c).try_cast("double")).try_cast("int")
    epoch = F.lit(fixed.SERIAL_DATE_EPOCH).cast("date")
    return F.when(is_number_text(c), F.date_add(epoch, days))


def parse_price(c: Column | str) -> Column:
    """Text to DECIMAL(10,2), half away from zero; NULL when it does not fit."""
    return trimmed(c).try_cast("decimal(10,2)")


def parse_count(c: Column | str) -> Column:
    """Text to INTEGER; fractions, words and overflow give NULL."""
    return _column(c).try_cast("int")


def parse_timestamp(c: Column | str) -> Column:
    """Text to a zone-free timestamp: ISO, or month/day/year with an optional time.

    Slashed dates are rewritten to ISO text instead of being parsed through the
    session time zone, where a daylight-saving gap would shift them.
    """
    text = F.trim(_column(c))
    slashed = F.regexp_replace(
        text, r"\A([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?=\z|[ T])", "$3-$1-$2"
    )
    iso = F.when(F.contains(text, F.lit("/")), slashed).otherwise(text)
    whole_date = iso.rlike(r"\A[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}(\z|[ T])")
    return F.when(whole_date, iso.try_cast("timestamp_ntz"))


def money(quantity: Column | str, unit_price: Column | str) -> Column:
    """Amount as DECIMAL(10,2); ANSI mode raises on overflow rather than wrapping."""
    return (_column(quantity) * _column(unit_price)).cast("decimal(10,2)")

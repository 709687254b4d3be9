"""Time expressions. Texts are read and written in the session zone, which ``prepare`` sets to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallystream import fixed_values as fixed

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def epoch_offset_seconds(start: str, offset: Column) -> Column:
    return F.unix_timestamp(F.lit(start)) + offset


def epoch_offset(start: str, offset: Column) -> Column:
    """Timestamp a number of seconds after a start.

    Built from the number directly: the way over text loses an hour where clocks go back.
    """
    return F.timestamp_seconds(epoch_offset_seconds(start, offset))


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, ISO_MICROS)


def whole_second(moment: Column) -> Column:
    return F.unix_seconds(moment.cast("timestamp"))


def tick(moment: Column, seconds: int = fixed.TICK_SECONDS) -> Column:
    """Start of the interval of ``seconds`` that a moment falls into, in epoch seconds."""
    second = whole_second(moment)
    return second - F.pmod(second, F.lit(seconds))

"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: float, high: float) -> Column:
    """Bound a value; null stays null (``least`` and ``greatest`` alone would return a bound)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def bounded_reading(value: Column, low: float, high: float, places: int = 2) -> Column:
    return F.round(clamp(value, low, high), places)


def pick(options: list[str], position: Column) -> Column:
    """The option at a 1-based position; a position outside the list raises."""
    return F.element_at(F.array(*[F.lit(option) for option in options]), position.cast("int"))


def try_pick(options: list[str], position: Column) -> Column:
    """Like ``pick`` for positions that are data: null outside the list."""
    return F.try_element_at(F.array(*[F.lit(option) for option in options]), position.cast("int"))

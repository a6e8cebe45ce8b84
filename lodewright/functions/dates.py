"""Calendar helpers on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year(day: Column) -> Column:
    """``%W``: weeks counted from the year's first Monday, ``'00'`` before it, two digits.

    Not ISO weeks: 2023-01-01 is week ``'00'`` here and week 52 in ISO.
    """
    week = F.floor((F.dayofyear(day) + F.lit(6) - F.weekday(day)) / F.lit(7))
    return F.lpad(week.cast("string"), 2, "0")


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + F.lit(1)

"""The workday calendar, and facts classified by it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodewright.functions.dates import iso_weekday, week_of_year
from lodewright.operators.joins import lookup_join
from lodewright.sources import holidays as china

# The kinds of days shown in ``date_type``, besides the holiday names.
WORKDAY = "工作日"
MAKEUP_WORKDAY = "法定上班"
WEEKEND = "周末"


def date_span(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row ``(start, end)``."""
    return spark.range(0, 1, 1, 1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def days_in(start: date, end: date) -> int:
    return (end - start).days + 1


def workday_calendar(
    span: DataFrame,
    holidays: DataFrame | None = None,
    makeup_days: DataFrame | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end`` of the one-row DataFrame ``span``.

    ``holidays(date, name)`` and ``makeup_days(date)`` hold each date once; ``names(name, shown)``
    maps holiday names to the shown ones, and a holiday without a shown name gets a NULL
    ``date_type``. Without them the public holidays of 2023 and 2024 apply. A year counts as covered if
    ``holidays`` has a row in it; days of other years have a NULL ``date_type`` and ``is_workday``.
    """
    spark = span.sparkSession
    holidays = china.holidays(spark) if holidays is None else holidays
    makeup_days = china.makeup_days(spark) if makeup_days is None else makeup_days
    names = china.holiday_names(spark) if names is None else names

    day = F.col("date")
    off = holidays.join(names, "name", "left").select(
        "date", F.lit(True).alias("is_off"), "shown"
    )
    worked = makeup_days.select("date", F.lit(True).alias("is_makeup"))
    # One row, joined to the one row of the span before its days are made.
    covered = holidays.agg(F.collect_set(F.year("date")).alias("covered"))
    known = F.array_contains("covered", F.year(day))
    days = span.join(covered).select(F.explode(F.sequence("start", "end")).alias("date"), "covered")
    weekday = iso_weekday(day)
    is_makeup = F.col("is_makeup").isNotNull()
    is_off = F.col("is_off").isNotNull()
    is_workday = is_makeup | ((weekday < F.lit(6)) & ~is_off)
    date_type = (
        F.when(~known, F.lit(None))
        .when(is_workday & (weekday >= F.lit(6)), F.lit(MAKEUP_WORKDAY))
        .when(is_workday, F.lit(WORKDAY))
        .when(is_off, F.col("shown"))
        .otherwise(F.lit(WEEKEND))
    )
    return (
        days.join(off, "date", "left")
        .join(worked, "date", "left")
        .select(
            day,
            F.year(day).alias("uyear"),
            F.month(day).alias("umonth"),
            F.dayofmonth(day).alias("uday"),
            week_of_year(day).alias("week"),
            weekday.alias("weekday"),
            date_type.alias("date_type"),
            F.when(known, is_workday.cast("int")).alias("is_workday"),
        )
    )


def classify_by_calendar(
    facts: DataFrame, when: str | Column, calendar: DataFrame, max_days: int | None = None
) -> DataFrame:
    """Add ``date_type`` and ``is_workday`` of the day of ``when`` to each fact.

    Facts outside the calendar stay, with NULLs. ``max_days`` is the calendar's length where the
    caller knows it; up to ``BROADCAST_ROWS`` the calendar is then broadcast and no fact is
    shuffled. Works on batches and on streams.
    """
    timestamp = F.col(when) if isinstance(when, str) else when
    key = "_day"
    days = calendar.select(F.col("date").alias(key), "date_type", "is_workday")
    return lookup_join(
        facts.withColumn(key, F.to_date(timestamp)), days, key, max_rows=max_days
    ).drop(key)


def workday_index(calendar: DataFrame) -> DataFrame:
    """One row for a calendar without gaps: its ``first`` day, how many workdays there are up to each day (``done``), how
    many days of unknown kind (``unknown``), and the ``workdays`` themselves in order."""
    until = Window.orderBy("date")
    days = calendar.select(
        "date",
        "is_workday",
        F.sum(F.coalesce("is_workday", F.lit(0))).over(until).cast("int").alias("done"),
        F.sum(F.col("is_workday").isNull().cast("int")).over(until).cast("int").alias("unknown"),
    )
    rows = days.agg(
        F.min("date").alias("first"),
        F.array_sort(F.collect_list(F.struct("date", "done", "unknown"))).alias("days"),
        F.array_sort(F.collect_list(F.when(F.col("is_workday") == 1, F.col("date")))).alias("workdays"),
    )
    return rows.select("first", F.col("days.done").alias("done"), F.col("days.unknown").alias("unknown"), "workdays")


class Workdays:
    """Looks days up in the row of a ``workday_index`` that stands beside each fact; see ``with_workdays``.

    Results are NULL for days outside the calendar, and where a day of unknown kind lies between.
    """

    def __init__(self, row: str):
        self.index = {name: F.col(f"{row}.{name}") for name in ("first", "done", "unknown", "workdays")}

    def _place(self, day: Column) -> Column:
        """The day's place in the arrays, from 1; NULL outside."""
        place = F.datediff(day, self.index["first"]) + 1
        return F.when((place >= 1) & (place <= F.size(self.index["done"])), place)

    def _at(self, name: str, place: Column) -> Column:
        return F.try_element_at(self.index[name], place)

    def between(self, start: Column, end: Column) -> Column:
        """How many workdays lie after ``start`` up to ``end``; negative if ``end`` is before."""
        one, two = self._place(start), self._place(end)
        same = self._at("unknown", one) == self._at("unknown", two)
        return F.when(same, self._at("done", two) - self._at("done", one))

    def after(self, day: Column, number: Column | int) -> Column:
        """The ``number``-th workday after the day, before it if negative; for 0 the day, or the next workday."""
        number = number if isinstance(number, Column) else F.lit(number)
        place = self._place(day)
        done = self._at("done", place)
        before = F.coalesce(self._at("done", F.when(place > 1, place - 1)), F.lit(0))
        wanted = (
            F.when(number > 0, done + number)
            .when(number < 0, before + 1 + number)
            .otherwise(before + 1)
        )
        found = F.when(place.isNotNull() & (wanted >= 1), self._at("workdays", F.when(wanted >= 1, wanted)))
        same = self._at("unknown", self._place(found)) == self._at("unknown", place)
        return F.when(same, found)


def with_workdays(
    facts: DataFrame, index: DataFrame, columns: Mapping[str, Callable[[Workdays], Column]]
) -> DataFrame:
    """The facts with columns that are made of ``Workdays``.

    The index is one row, as long as the calendar has days, and goes to every task; facts are not moved, and
    nothing is joined by day.
    """
    row = "_workdays"
    one = F.broadcast(index.select(F.struct("first", "done", "unknown", "workdays").alias(row)))
    days = Workdays(row)
    made = [column(days).alias(name) for name, column in columns.items()]
    return facts.join(one).select(*(F.col(name) for name in facts.columns), *made)

"""Chinese public holidays and make-up working days of 2023 and 2024."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from lodewright.sources.rows import inline_rows

# The holiday names, as published and as shown in the calendar.
HOLIDAY_NAMES = {
    "New Year's Day": "元旦节",
    "Spring Festival": "春节",
    "Tomb-sweeping Day": "清明节",
    "Labour Day": "劳动节",
    "Dragon Boat Festival": "端午节",
    "Mid-autumn Festival": "中秋节",
    "National Day": "国庆节",
}

# First and last day off of each holiday.
HOLIDAYS = [
    ("New Year's Day", date(2023, 1, 1), date(2023, 1, 2)),
    ("Spring Festival", date(2023, 1, 21), date(2023, 1, 27)),
    ("Tomb-sweeping Day", date(2023, 4, 5), date(2023, 4, 5)),
    ("Labour Day", date(2023, 4, 29), date(2023, 5, 3)),
    ("Dragon Boat Festival", date(2023, 6, 22), date(2023, 6, 24)),
    ("Mid-autumn Festival", date(2023, 9, 29), date(2023, 9, 29)),
    ("National Day", date(2023, 9, 30), date(2023, 10, 6)),
    ("New Year's Day", date(2024, 1, 1), date(2024, 1, 1)),
    ("Spring Festival", date(2024, 2, 10), date(2024, 2, 17)),
    ("Tomb-sweeping Day", date(2024, 4, 4), date(2024, 4, 6)),
    ("Labour Day", date(2024, 5, 1), date(2024, 5, 5)),
    ("Dragon Boat Festival", date(2024, 6, 10), date(2024, 6, 10)),
    ("Mid-autumn Festival", date(2024, 9, 15), date(2024, 9, 17)),
    ("National Day", date(2024, 10, 1), date(2024, 10, 7)),
]

# Weekend days worked in exchange.
MAKEUP_DAYS = [
    date(2023, 1, 28),
    date(2023, 1, 29),
    date(2023, 4, 23),
    date(2023, 5, 6),
    date(2023, 6, 25),
    date(2023, 10, 7),
    date(2023, 10, 8),
    date(2024, 2, 4),
    date(2024, 2, 18),
    date(2024, 4, 7),
    date(2024, 4, 28),
    date(2024, 5, 11),
    date(2024, 9, 14),
    date(2024, 9, 29),
    date(2024, 10, 12),
]


def holidays(spark: SparkSession) -> DataFrame:
    """``(date, name)``, one row per day off, names as published."""
    schema = StructType(
        [
            StructField("name", StringType()),
            StructField("first", DateType()),
            StructField("last", DateType()),
        ]
    )
    spans = inline_rows(spark, HOLIDAYS, schema)
    return spans.select(F.explode(F.sequence("first", "last")).alias("date"), "name")


def makeup_days(spark: SparkSession) -> DataFrame:
    """``(date)``, one row per weekend day worked."""
    return inline_rows(
        spark, [(day,) for day in MAKEUP_DAYS], StructType([StructField("date", DateType())])
    )


def holiday_names(spark: SparkSession) -> DataFrame:
    """``(name, shown)``, the published and the shown name of each holiday."""
    schema = StructType([StructField("name", StringType()), StructField("shown", StringType())])
    return inline_rows(spark, list(HOLIDAY_NAMES.items()), schema)

"""Queries over the calendar and the code hierarchy."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewright.operators.calendar import (
    classify_by_calendar,
    date_span,
    days_in,
    with_workdays,
    workday_calendar,
    workday_index,
)
from lodewright.functions.text import padded
from lodewright.operators.hierarchy import flatten_hierarchy, flatten_levels
from lodewright.session import shared_dir
from lodewright.sources.files import stream_table, table
from lodewright.sources.holidays import HOLIDAY_NAMES, HOLIDAYS, MAKEUP_DAYS
from lodewright.streaming.jobs import start_copy
from lodewright.streaming.settings import StreamSettings

FIRST, LAST = date(2023, 1, 1), date(2024, 12, 31)


def calendar_span(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar from the first order to the last event; years without holiday rows have no kinds of days."""

    def ends(rows: DataFrame, when: str) -> DataFrame:
        day = F.to_date(when)
        return rows.agg(F.min(day).alias("start"), F.max(day).alias("end"))

    orders = ends(table(spark, folder, "orders"), "o_orderdate")
    events = ends(table(spark, folder, "events"), "ts")
    span = orders.unionByName(events).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    calendar = workday_calendar(span)
    return calendar.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def _events_per_day_type(classified: DataFrame) -> DataFrame:
    value = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return classified.groupBy("date_type", "is_workday").agg(
        F.count(F.lit(1)).alias("events"), value.alias("value")
    )


def events_by_workday(spark: SparkSession, folder: str) -> DataFrame:
    """Events and their value per type of day; those outside the calendar's two years have none."""
    calendar = workday_calendar(date_span(spark, FIRST, LAST))
    events = table(spark, folder, "events")
    return _events_per_day_type(
        classify_by_calendar(events, "ts", calendar, days_in(FIRST, LAST))
    )


def events_by_workday_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream of events joined to the calendar and written as files."""
    calendar = workday_calendar(date_span(spark, FIRST, LAST))
    events = stream_table(spark, folder, "events")
    classified = classify_by_calendar(events, "ts", calendar, days_in(FIRST, LAST)).select(
        "event_id", "value", "date_type", "is_workday"
    )
    path = shared_dir(spark, "classified")
    settings = StreamSettings(f"{path}/checkpoint")
    start_copy(classified, f"{path}/rows", settings, "parquet").awaitTermination()
    return _events_per_day_type(
        spark.read.schema(classified.schema).parquet(f"{path}/rows")
    )


def hierarchy_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as leaves below nations and regions, through 14-digit codes.

    The first region is governed directly: its nations have no row, so its customers fall back.
    """
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")

    top = F.concat(F.lit("1"), padded("r_regionkey", 1))
    middle = F.concat(F.lit("1"), padded("n_regionkey", 1), padded("n_nationkey", 2))
    provinces = region.select(
        F.concat(top, F.lit("0" * 12)).alias("id"), F.col("r_name").alias("name")
    )
    cities = nation.where(F.col("n_regionkey") > 0).select(
        F.concat(middle, F.lit("0" * 10)).alias("id"), F.col("n_name").alias("name")
    )
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    leaves = places.select(
        F.concat(
            middle, padded(F.col("c_custkey") + F.lit(1), 10)
        ).alias("id"),
        F.col("c_name").alias("name"),
    )
    return flatten_hierarchy(leaves, 2, 4, 14, provinces, cities)


def event_workdays(spark: SparkSession, folder: str) -> DataFrame:
    """Per event the 20th workday after it and the 3rd before, and the workdays in some days from it."""
    index = workday_index(workday_calendar(date_span(spark, FIRST, LAST)))
    day, later = F.col("day"), F.date_add("day", (F.col("user_id") % 60).cast("int"))
    facts = table(spark, folder, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    found = with_workdays(
        facts,
        index,
        {
            "due": lambda days: F.date_format(days.after(day, 20), "yyyy-MM-dd"),
            "ready": lambda days: F.date_format(days.after(day, -3), "yyyy-MM-dd"),
            "booked": lambda days: F.date_format(days.after(day, 0), "yyyy-MM-dd"),
            "open_days": lambda days: days.between(day, later),
            "beyond": lambda days: days.between(day, F.to_date(F.lit("2026-01-01"))),
        },
    )
    return found.drop("user_id", "day")


def hierarchy_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Customers below four levels of groups, each of which leaves some groups out."""
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    region = table(spark, folder, "region")
    segments = F.array(*(F.lit(name) for name in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")))
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("1"), padded("n_regionkey", 1)).alias("top"),
        padded(F.col("n_nationkey") + F.lit(1), 2).alias("second"),
        padded(F.array_position(segments, F.col("c_mktsegment")), 2).alias("third"),
        F.when(F.col("c_acctbal") < 0, "02").otherwise("01").alias("fourth"),
        *("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "n_regionkey", "n_name"),
    )
    two, three = F.concat("top", "second"), F.concat("top", "second", "third")
    four = F.concat("top", "second", "third", "fourth")

    def group(rows: DataFrame, code: F.Column, name: F.Column) -> DataFrame:
        return rows.select(F.rpad(code, 18, "0").alias("id"), name.alias("name")).distinct()

    groups = (
        group(region.where("r_regionkey > 0"), F.concat(F.lit("1"), padded("r_regionkey", 1)), F.col("r_name"))
        .unionByName(group(places.where("n_regionkey <> 1"), two, F.col("n_name")))
        .unionByName(group(places.where("c_nationkey % 2 = 0"), three, F.col("c_mktsegment")))
        .unionByName(group(places.where("fourth = '02'"), four, F.lit("owes")))
    )
    leaves = places.select(F.concat(four, padded(F.col("c_custkey") + F.lit(1), 10)).alias("id"), F.col("c_name").alias("name"))
    return flatten_levels(leaves, groups, [2, 4, 6, 8], 18)


QUERIES = {
    "calendar_span": calendar_span,
    "events_by_workday": events_by_workday,
    "events_by_workday_streamed": events_by_workday_streamed,
    "hierarchy_flat": hierarchy_flat,
    "event_workdays": event_workdays,
    "hierarchy_levels": hierarchy_levels,
}

_HOLIDAY_ROWS = ", ".join(
    f"('{HOLIDAY_NAMES[name]}', DATE '{first}', DATE '{last}')" for name, first, last in HOLIDAYS
)
_MAKEUP_ROWS = ", ".join(f"(DATE '{day}')" for day in MAKEUP_DAYS)
_DAY_RULES = f"""
    holidays(name, first_day, last_day) AS (VALUES {_HOLIDAY_ROWS}),
    makeup(day) AS (VALUES {_MAKEUP_ROWS})"""
_DATE_TYPE = """
    CASE WHEN year(d.day) NOT IN (2023, 2024) THEN NULL
         WHEN m.day IS NOT NULL AND isodow(d.day) > 5 THEN '法定上班'
         WHEN m.day IS NOT NULL THEN '工作日'
         WHEN h.name IS NOT NULL THEN h.name
         WHEN isodow(d.day) > 5 THEN '周末'
         ELSE '工作日' END AS date_type,
    CASE WHEN year(d.day) IN (2023, 2024)
         THEN CAST(m.day IS NOT NULL OR (h.name IS NULL AND isodow(d.day) < 6) AS INTEGER) END AS is_workday"""
_DAY_JOINS = """
    LEFT JOIN holidays h ON d.day BETWEEN h.first_day AND h.last_day
    LEFT JOIN makeup m ON d.day = m.day"""

_EVENTS_BY_WORKDAY = f"""
WITH {_DAY_RULES},
d AS (SELECT CAST(ts AS DATE) AS day, value FROM events),
typed AS (SELECT d.value, {_DATE_TYPE} FROM d {_DAY_JOINS})
SELECT date_type, is_workday, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value
FROM typed GROUP BY date_type, is_workday"""

ORACLE = {
    "calendar_span": f"""
WITH {_DAY_RULES},
span AS (
    SELECT CAST(least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events)) AS DATE)
               AS first_day,
           CAST(greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events))
               AS DATE) AS last_day
),
d AS (
    SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day
    FROM span
)
SELECT strftime(d.day, '%Y-%m-%d') AS date,
       CAST(year(d.day) AS INTEGER) AS uyear,
       CAST(month(d.day) AS INTEGER) AS umonth,
       CAST(day(d.day) AS INTEGER) AS uday,
       strftime(d.day, '%W') AS week,
       CAST(isodow(d.day) AS INTEGER) AS weekday,
       {_DATE_TYPE}
FROM d {_DAY_JOINS}""",
    "events_by_workday": _EVENTS_BY_WORKDAY,
    "events_by_workday_streamed": _EVENTS_BY_WORKDAY,
    "hierarchy_flat": """
WITH codes AS (
    SELECT '1' || r_regionkey || repeat('0', 12) AS id, r_name AS name FROM region
    UNION ALL
    SELECT '1' || n_regionkey || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || repeat('0', 10),
           n_name
    FROM nation WHERE n_regionkey > 0
    UNION ALL
    SELECT '1' || n_regionkey || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
               || lpad(CAST(c_custkey + 1 AS VARCHAR), CAST(greatest(length(CAST(c_custkey + 1 AS VARCHAR)), 10) AS INTEGER), '0'),
           c_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey
)
SELECT p.id AS province_code, p.name AS province_name,
       CAST(coalesce(c.id, substring(l.id, 1, 4) || repeat('0', 10)) AS BIGINT) AS city_code,
       CASE WHEN c.id IS NULL THEN p.name ELSE c.name END AS city_name,
       l.id, l.name
FROM codes l
LEFT JOIN (SELECT * FROM codes WHERE suffix(id, repeat('0', 12))) p
    ON substring(l.id, 1, 2) = substring(p.id, 1, 2)
LEFT JOIN (
    SELECT * FROM codes WHERE suffix(id, repeat('0', 10)) AND NOT suffix(id, repeat('0', 12))
) c ON substring(l.id, 1, 4) = substring(c.id, 1, 4)
WHERE NOT suffix(l.id, repeat('0', 10))
ORDER BY l.id""",
    "event_workdays": f"""
WITH {_DAY_RULES},
d AS (SELECT CAST(unnest(generate_series(DATE '2023-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS day),
typed AS (SELECT d.day, {_DATE_TYPE} FROM d {_DAY_JOINS}),
counted AS (SELECT day, is_workday, sum(is_workday) OVER (ORDER BY day) AS done FROM typed),
numbered AS (SELECT day AS workday, done AS number FROM counted WHERE is_workday = 1)
SELECT event_id, strftime(a.workday, '%Y-%m-%d') AS due, strftime(b.workday, '%Y-%m-%d') AS ready,
       strftime(z.workday, '%Y-%m-%d') AS booked, CAST(f.done - c.done AS INTEGER) AS open_days,
       CAST(NULL AS INTEGER) AS beyond
FROM events
JOIN counted c ON c.day = CAST(ts AS DATE)
LEFT JOIN numbered a ON a.number = c.done + 20
LEFT JOIN numbered b ON b.number = c.done - c.is_workday + 1 - 3
LEFT JOIN numbered z ON z.number = c.done - c.is_workday + 1
LEFT JOIN counted f ON f.day = CAST(ts AS DATE) + CAST(user_id % 60 AS INTEGER)""",
    "hierarchy_levels": """
WITH places AS (
    SELECT '1' || n_regionkey AS top, lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS second,
           lpad(CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) AS VARCHAR), 2, '0') AS third,
           CASE WHEN c_acctbal < 0 THEN '02' ELSE '01' END AS fourth, *
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), regions AS (SELECT '1' || r_regionkey AS code, r_name AS name FROM region WHERE r_regionkey > 0),
nations AS (SELECT DISTINCT top || second AS code, n_name AS name FROM places WHERE n_regionkey <> 1),
segments AS (SELECT DISTINCT top || second || third AS code, c_mktsegment AS name FROM places WHERE c_nationkey % 2 = 0),
signs AS (SELECT DISTINCT top || second || third || fourth AS code, 'owes' AS name FROM places WHERE fourth = '02')
SELECT top || second || third || fourth || lpad(CAST(c_custkey + 1 AS VARCHAR), CAST(greatest(length(CAST(c_custkey + 1 AS VARCHAR)), 10) AS INTEGER), '0') AS id, c_name AS name,
       rpad(top, 18, '0') AS code_1, a.name AS name_1, a.code IS NOT NULL AS has_1,
       rpad(top || second, 18, '0') AS code_2, coalesce(b.name, a.name) AS name_2, b.code IS NOT NULL AS has_2,
       rpad(top || second || third, 18, '0') AS code_3, coalesce(c.name, b.name, a.name) AS name_3, c.code IS NOT NULL AS has_3,
       rpad(top || second || third || fourth, 18, '0') AS code_4, coalesce(d.name, c.name, b.name, a.name) AS name_4, d.code IS NOT NULL AS has_4
FROM places
LEFT JOIN regions a ON a.code = top
LEFT JOIN nations b ON b.code = top || second
LEFT JOIN segments c ON c.code = top || second || third
LEFT JOIN signs d ON d.code = top || second || third || fourth""",
}

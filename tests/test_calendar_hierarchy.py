from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lodewright.functions.register import register_functions
from lodewright.functions.text import padded, xtrim
from lodewright.operators.calendar import classify_by_calendar, date_span, workday_calendar
from lodewright.operators.hierarchy import flatten_hierarchy


def _calendar(spark):
    return workday_calendar(date_span(spark, date(2023, 1, 1), date(2024, 12, 31)))


def test_calendar_of_two_years(spark):
    counts = {row.date_type: row["count"] for row in _calendar(spark).groupBy("date_type").count().collect()}
    assert counts == {
        "工作日": 485, "周末": 177, "春节": 15, "法定上班": 15, "国庆节": 14, "劳动节": 10,
        "清明节": 4, "端午节": 4, "中秋节": 4, "元旦节": 3,
    }
    assert _calendar(spark).agg(F.sum("is_workday")).first()[0] == 500


def test_calendar_rows(spark):
    rows = {str(row.date): tuple(row)[1:] for row in _calendar(spark).collect()}
    assert rows["2023-01-01"] == (2023, 1, 1, "00", 7, "元旦节", 0)
    assert rows["2023-01-28"] == (2023, 1, 28, "04", 6, "法定上班", 1)
    assert rows["2024-02-19"] == (2024, 2, 19, "08", 1, "工作日", 1)
    assert rows["2024-12-31"] == (2024, 12, 31, "53", 2, "工作日", 1)


def test_week_equals_strftime(spark):
    span = date_span(spark, date(1999, 1, 1), date(2012, 12, 31))
    for row in workday_calendar(span).select("date", "week", "weekday").collect():
        assert (row.week, row.weekday) == (row.date.strftime("%W"), row.date.isoweekday())


def test_holiday_without_shown_name(spark):
    holidays = spark.sql("SELECT DATE '2024-03-05' AS date, 'Some Day' AS name")
    days = workday_calendar(date_span(spark, date(2024, 3, 4), date(2024, 3, 5)), holidays)
    assert [(row.date_type, row.is_workday) for row in days.orderBy("date").collect()] == [
        ("工作日", 1), (None, 0)
    ]


def test_facts_outside_the_calendar_stay(spark):
    facts = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01 23:59:59'),"
        " (2, TIMESTAMP_NTZ '2030-01-01 00:00:00'), (3, NULL) AS f(id, ts)"
    )
    rows = classify_by_calendar(facts, "ts", _calendar(spark), 731).orderBy("id").collect()
    assert [(row.id, row.date_type) for row in rows] == [(1, "元旦节"), (2, None), (3, None)]


def test_years_without_holiday_rows_have_no_kinds_of_days(spark):
    for day in (date(1996, 1, 1), date(1996, 2, 19), date(2025, 1, 1), date(2025, 1, 29)):
        row = workday_calendar(date_span(spark, day, day)).first()
        assert (row.date_type, row.is_workday, row.uyear) == (None, None, day.year)


def test_long_keys_are_not_cut(spark):
    rows = spark.sql("SELECT * FROM VALUES (7L), (123456789L), (12345678901L) AS k(n)")
    assert [row[0] for row in rows.select(padded("n", 8)).collect()] == ["00000007", "123456789", "12345678901"]


def test_hierarchy_of_three_frames_reads_the_leaves_once(spark):
    codes = spark.createDataFrame([("110000", "N"), ("110100", "City"), ("110101", "A")], "id string, name string")
    leaves, cities, provinces = (codes.where(f"name = '{n}'") for n in ("A", "City", "N"))
    flat = flatten_hierarchy(leaves, provinces=provinces, cities=cities)
    assert [tuple(row) for row in flat.collect()] == [tuple(row) for row in flatten_hierarchy(codes).collect()]


def test_hierarchy(spark):
    codes = spark.createDataFrame(
        [
            ("110000", "North"), ("110101", "North A"), ("110102", "North B"),
            ("320000", "East"), ("320100", "East City"), ("320101", "Old Town"),
            ("320201", "No City Row"), ("990101", "No Province"),
        ],
        "id string, name string",
    )
    assert [tuple(row) for row in flatten_hierarchy(codes).collect()] == [
        ("110000", "North", 110100, "North", "110101", "North A"),
        ("110000", "North", 110100, "North", "110102", "North B"),
        ("320000", "East", 320100, "East City", "320101", "Old Town"),
        ("320000", "East", 320200, "East", "320201", "No City Row"),
        (None, None, 990100, None, "990101", "No Province"),
    ]


def test_xtrim(spark):
    texts = [None, "", "   ", " a\t b\n", "　x y\u0085z\u001c", "a​b"]
    register_functions(spark)
    rows = spark.createDataFrame([(text,) for text in texts], "s string")
    wanted = [None, None, "", "ab", "xyz", "a​b"]
    assert [row[0] for row in rows.select(xtrim("s")).collect()] == wanted
    assert [row[0] for row in rows.selectExpr("xtrim(s)").collect()] == wanted
    numbers = spark.sql("SELECT * FROM VALUES (0), (12) AS n(n)").select(xtrim("n", numeric=True))
    assert [row[0] for row in numbers.collect()] == [None, "12"]


def test_workdays_between_and_after_any_day(spark):
    import random
    from datetime import date, timedelta

    from pyspark.sql import functions as F

    from lodewright.operators.calendar import date_span, with_workdays, workday_calendar, workday_index

    # The end of the last known year and the beginning of one whose kinds of days aren't known.
    calendar = workday_calendar(date_span(spark, date(2024, 9, 1), date(2025, 2, 1)))
    known = {r["date"]: r["is_workday"] for r in calendar.collect()}
    days = sorted(known)

    def between(a, b):
        low, high = min(a, b), max(a, b)
        inside = [known.get(low + timedelta(i)) for i in range(1, (high - low).days + 1)]
        ends = known.get(low, "out") != "out" and known.get(high, "out") != "out"
        if not ends or None in inside:
            return None
        return sum(inside) if b >= a else -sum(inside)

    def after(a, n):
        if a not in known:
            return None
        step, day, left = (1 if n >= 0 else -1), a, abs(n)
        if n == 0:
            left, day = 1, a - timedelta(1)
        while left:
            day += timedelta(step)
            if known.get(day) is None:
                return None
            left -= known[day]
        return day

    chance = random.Random(4)
    outside = [days[0] - timedelta(3), days[-1] + timedelta(2), None]
    rows = [(i, chance.choice(days + outside[:2]), chance.choice(days + outside), chance.randint(-30, 30)) for i in range(600)]
    rows += [(1000 + i, day, days[0], 0) for i, day in enumerate(days)]
    facts = spark.createDataFrame(rows, "id int, a date, b date, n int")
    found = with_workdays(
        facts,
        workday_index(calendar),
        {"between": lambda w: w.between(F.col("a"), F.col("b")), "after": lambda w: w.after(F.col("a"), F.col("n"))},
    )
    by = {r.id: (r.between, r.after) for r in found.collect()}
    for i, a, b, n in rows:
        if known.get(a, 0) is None or (b is not None and known.get(b, 0) is None):
            continue  # days of unknown kind themselves: their neighbours are looked at in the other cases
        assert by[i] == (between(a, b) if b else None, after(a, n)), (a, b, n)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_levels_take_the_nearest_group_that_has_a_row(spark):
    from lodewright.operators.hierarchy import flatten_levels

    groups = spark.createDataFrame(
        [("100000", "one"), ("120000", "one-two"), ("121300", "deep"), ("200000", None), ("310000", "low")], "id string, name string"
    )
    leaves = spark.createDataFrame(
        [("121314", "a"), ("120014", "b"), ("111314", "c"), ("211314", "d"), ("311314", "e"), ("411314", "f"), (None, "g"), ("121314", "a")],
        "id string, name string",
    )
    rows = {r.name: r for r in flatten_levels(leaves, groups, [1, 2, 4], 6).collect()}
    assert len(rows) == 7
    shown = {name: [(r[f"name_{n}"], r[f"has_{n}"]) for n in (1, 2, 3)] for name, r in rows.items()}
    assert shown["a"] == [("one", True), ("one-two", True), ("deep", True)]
    assert shown["b"] == [("one", True), ("one-two", True), ("one-two", False)]
    assert shown["c"] == [("one", True), ("one", False), ("one", False)]
    assert shown["d"] == [(None, True), (None, False), (None, False)]
    assert shown["e"] == [(None, False), ("low", True), ("low", False)]
    assert shown["f"] == shown["g"] == [(None, False)] * 3
    assert (rows["a"].code_1, rows["a"].code_2, rows["a"].code_3) == ("100000", "120000", "121300")

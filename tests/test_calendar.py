"""Calendar attributes against Python's own calendar, and the reports on a handful of facts."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.calendar import micros, register_sql_functions
from millrace.operators import calendar as cal

HOLIDAYS = {(1, 1), (7, 4), (9, 5), (11, 11), (12, 25)}


@pytest.fixture(scope="module")
def dim(spark):
    return cal.date_dim(spark, date(2015, 1, 1), date(2025, 12, 31)).cache()


def test_against_python(dim):
    rows = {r.full_date: r for r in dim.collect()}
    day = date(2015, 1, 1)
    assert len(rows) == 4018
    while day <= date(2025, 12, 31):
        r, after = rows[day], day + timedelta(1)
        quarter, fiscal_month = (day.month + 2) // 3, (day.month - 7) % 12 + 1
        holiday = (day.month, day.day) in HOLIDAYS
        assert r.date_key == int(day.strftime("%Y%m%d"))
        assert (r.day_of_week, r.week_of_year) == (day.isoweekday(), day.isocalendar().week)
        assert (r.day_of_week_name, r.day_of_week_short) == (day.strftime("%A"), day.strftime("%a"))
        assert (r.day_of_month, r.day_of_year) == (day.day, day.timetuple().tm_yday)
        assert (r.month_number, r.month_name, r.month_name_short) == (day.month, day.strftime("%B"), day.strftime("%b"))
        assert (r.quarter, r.quarter_name, r.year) == (quarter, f"Q{quarter}", day.year)
        assert (r.year_month, r.year_quarter) == (day.strftime("%Y-%m"), f"{day.year}-Q{quarter}")
        assert r.is_weekend == (day.isoweekday() > 5) and r.is_holiday == holiday
        assert r.is_business_day == (day.isoweekday() < 6 and not holiday)
        assert r.is_month_end == (after.month != day.month)
        assert r.is_quarter_end == (after.month != day.month and day.month % 3 == 0)
        assert r.is_year_end == (after.year != day.year)
        assert r.fiscal_month == fiscal_month and r.fiscal_quarter == (fiscal_month + 2) // 3
        assert r.fiscal_year == day.year + (day.month >= 7)
        day = after


def test_holiday_table_and_audit_columns(spark):
    holidays = spark.createDataFrame([(date(2024, 9, 2),)], "day date")
    dim = cal.date_dim(spark, date(2024, 9, 1), date(2024, 9, 6), holidays, audit=True)
    assert [r.full_date for r in dim.filter("is_holiday").collect()] == [date(2024, 9, 2)]
    assert dim.filter("created_timestamp IS NOT NULL AND updated_timestamp IS NOT NULL").count() == 6


def test_extension_is_idempotent(spark, dim):
    more = cal.extend_calendar(dim, spark, date(2025, 12, 30), date(2026, 1, 2))
    assert sorted(r.full_date for r in more.collect()) == [date(2026, 1, 1), date(2026, 1, 2)]
    assert cal.extend_calendar(dim.unionByName(more), spark, date(2025, 12, 30), date(2026, 1, 2)).count() == 0


def test_joins(spark, dim):
    facts = spark.createDataFrame(
        [(1, datetime(2024, 2, 29, 23, 59)), (2, None), (3, datetime(1990, 1, 1))], "id int, at timestamp_ntz"
    )
    assert [r.id for r in cal.date_join(facts, "at", dim).collect()] == [1]
    assert [r.date_key for r in cal.date_key_join(facts, "at", dim).collect()] == [20240229]
    kept = {r.id: r.created_year for r in cal.with_calendar(facts, "at", dim, "created_").collect()}
    assert kept == {1: 2024, 2: None, 3: None}


def test_reports(spark, dim):
    days = [date(2024, 7, 4), date(2024, 7, 5), date(2024, 7, 5), date(2024, 7, 6), date(2024, 6, 28)]
    facts = spark.createDataFrame([(d,) for d in days], "d date")
    counted = cal.days_with_counts(facts, "d", dim)
    assert [tuple(r) for r in cal.fiscal_report(counted).collect()] == [(2024, 4, 1, 1), (2025, 1, 4, 2)]
    assert [tuple(r) for r in cal.monthly_performance(counted).collect()] == [
        ("2024-06", "June", 1, 1, 0), ("2024-07", "July", 4, 2, 1),
    ]
    assert [tuple(r) for r in cal.business_day_analysis(counted).collect()] == [
        (True, "Friday", 3), (False, "Thursday", 1), (False, "Saturday", 1),
    ]
    assert [tuple(r) for r in cal.quarterly_comparison(counted).collect()] == [("Q2", 2024, 1, 1.0), ("Q3", 2024, 4, 0.5)]
    assert [tuple(r) for r in cal.holiday_impact(counted).collect()][0] == (True, "Thursday", 1, 0.0)
    change = cal.period_over_period(counted).collect()
    assert (change[1].items, change[1].previous_quarter, change[1].quarter_change, change[1].previous_year) == (4, 1, 3.0, None)


def test_facts_are_counted_before_the_join(spark, dim):
    facts = spark.range(1000).selectExpr("date_add(DATE '2024-01-01', CAST(id % 9 AS INT)) AS d")
    plan = cal.days_with_counts(facts, "d", dim)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT get_date_key(DATE '2025-01-28') AS a, get_date_key_from_timestamp(TIMESTAMP_NTZ '2025-01-28 23:59:59') AS b").first()
    assert tuple(row) == (20250128, 20250128)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_micros_do_not_depend_on_the_zone(spark, zone):
    moments = [datetime(2024, 3, 10, 2, 30, 0, 123456), datetime(1969, 12, 31, 23, 59, 59, 1), datetime(1970, 1, 1)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "m timestamp_ntz")
        found = [r.u for r in df.select(micros(F.col("m")).alias("u")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [(m - datetime(1970, 1, 1)) // timedelta(microseconds=1) for m in moments]


def test_span_of_nothing(spark):
    assert cal.span_of(spark.createDataFrame([], "d timestamp_ntz"), "d") is None
    assert cal.span_of(spark.createDataFrame([(None,)], "d timestamp_ntz"), "d") is None

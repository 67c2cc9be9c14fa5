"""Queries over the calendar dimension and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import calendar as functions
from millrace.operators import calendar as cal
from millrace.plans.landing import landed
from millrace.plans.registry import query, table

_SPAN = """SELECT make_date(year(min(o_orderdate)), 1, 1) AS low,
    make_date(year(max(o_orderdate)), 12, 31) AS high FROM orders"""


def _dim_sql(span: str = _SPAN) -> str:
    return f"""
    SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INTEGER AS date_key, d AS full_date,
        isodow(d)::INTEGER AS day_of_week, dayname(d) AS day_of_week_name,
        strftime(d, '%a') AS day_of_week_short, day(d)::INTEGER AS day_of_month,
        dayofyear(d)::INTEGER AS day_of_year, weekofyear(d)::INTEGER AS week_of_year,
        month(d)::INTEGER AS month_number, monthname(d) AS month_name,
        strftime(d, '%b') AS month_name_short, quarter(d)::INTEGER AS quarter,
        'Q' || quarter(d) AS quarter_name, year(d)::INTEGER AS year, strftime(d, '%Y-%m') AS year_month,
        year(d) || '-Q' || quarter(d) AS year_quarter, isodow(d) >= 6 AS is_weekend,
        d = last_day(d) AS is_month_end, d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS is_quarter_end,
        month(d) = 12 AND day(d) = 31 AS is_year_end,
        (year(d) + CASE WHEN month(d) >= 7 THEN 1 ELSE 0 END)::INTEGER AS fiscal_year,
        (((month(d) + 5) % 12) // 3 + 1)::INTEGER AS fiscal_quarter,
        ((month(d) + 5) % 12 + 1)::INTEGER AS fiscal_month,
        strftime(d, '%m-%d') IN ('01-01', '07-04', '09-05', '11-11', '12-25') AS is_holiday,
        isodow(d) < 6 AND strftime(d, '%m-%d') NOT IN ('01-01', '07-04', '09-05', '11-11', '12-25')
            AS is_business_day
    FROM (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY))::DATE AS d FROM ({span}))"""


_WITH_DIM = f"WITH dim AS ({_dim_sql()})"
_ORDER_DAYS = "orders JOIN dim ON o_orderdate::DATE = full_date"
_SHIP_DAYS = "lineitem JOIN dim ON l_shipdate::DATE = full_date"


def _computed_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return cal.date_dim(spark, *cal.span_of(table(spark, folder, "orders"), "o_orderdate"))


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar as a table, filled once for the years in which there are orders."""
    path = landed(
        spark, folder, "calendar",
        lambda p: _computed_calendar(spark, folder).coalesce(1).write.parquet(p),
    )
    return cal.known_calendar(spark.read.parquet(path))


def _order_days(spark: SparkSession, folder: str) -> DataFrame:
    return cal.days_with_counts(
        table(spark, folder, "orders"), "o_orderdate", _calendar(spark, folder)
    )


def _ship_days(spark: SparkSession, folder: str) -> DataFrame:
    return cal.days_with_counts(
        table(spark, folder, "lineitem"), "l_shipdate", _calendar(spark, folder)
    )


@query(f"SELECT * REPLACE (full_date::VARCHAR AS full_date) FROM ({_dim_sql()})")
def date_dim(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar of the years in which there are orders."""
    return _computed_calendar(spark, folder)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INTEGER AS date_key FROM orders")
def date_key(spark: SparkSession, folder: str) -> DataFrame:
    """The integer day key of every order, by the SQL function."""
    functions.register_sql_functions(spark)
    orders = table(spark, folder, "orders")
    return orders.selectExpr("o_orderkey", "get_date_key(CAST(o_orderdate AS DATE)) AS date_key")


@query("SELECT event_id, strftime(ts, '%Y%m%d')::INTEGER AS date_key FROM events")
def date_key_ts(spark: SparkSession, folder: str) -> DataFrame:
    """The integer day key of every event's timestamp."""
    return table(spark, folder, "events").select(
        "event_id", functions.date_key_from_timestamp(F.col("ts")).alias("date_key")
    )


@query(f"""{_WITH_DIM}
SELECT o_orderkey, day_of_week_name, month_name, year, is_business_day
FROM {_ORDER_DAYS} WHERE o_orderdate IS NOT NULL
""")
def date_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with attributes of their day."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = cal.date_join(orders, "o_orderdate", _calendar(spark, folder))
    return joined.select("o_orderkey", "day_of_week_name", "month_name", "year", "is_business_day")


@query(f"""{_WITH_DIM}
SELECT l_orderkey, l_linenumber, l_quantity, fiscal_year, fiscal_quarter, year_quarter
FROM lineitem JOIN dim ON strftime(l_shipdate, '%Y%m%d')::INTEGER = date_key
""")
def date_key_join(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with attributes of their shipping day, joined on the integer key."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    return cal.date_key_join(items, "l_shipdate", _calendar(spark, folder)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "fiscal_year", "fiscal_quarter", "year_quarter"
    )


@query(f"""{_WITH_DIM}
SELECT is_business_day, day_of_week_name, count(*) AS project_count
FROM {_ORDER_DAYS} GROUP BY ALL
""")
def business_day_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return cal.business_day_analysis(_order_days(spark, folder))


@query(f"""{_WITH_DIM}
SELECT year_month, month_name, count(*) AS total_projects,
    count(CASE WHEN is_business_day THEN 1 END) AS business_day_projects,
    count(CASE WHEN is_holiday THEN 1 END) AS holiday_projects
FROM {_SHIP_DAYS} GROUP BY ALL
""")
def monthly_performance(spark: SparkSession, folder: str) -> DataFrame:
    return cal.monthly_performance(_ship_days(spark, folder))


@query(f"""{_WITH_DIM}
SELECT quarter_name, year, count(*) AS project_count,
    count(CASE WHEN is_business_day THEN 1 END) / count(*) AS business_day_ratio
FROM {_SHIP_DAYS} GROUP BY ALL
""")
def quarterly_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return cal.quarterly_comparison(_ship_days(spark, folder))


@query(f"""{_WITH_DIM},
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate) AS n FROM orders)
SELECT fiscal_year, fiscal_quarter, count(*) AS total_items,
    count(CASE WHEN is_business_day THEN 1 END) AS business_day_items
FROM ranked JOIN dim ON o_orderdate::DATE = full_date WHERE n = 1 GROUP BY ALL
""")
def fiscal_report(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: orders deduplicated by key, joined to the calendar, by fiscal quarter."""
    orders = table(spark, folder, "orders")
    # Of the rows of an order the report needs the first date only: an aggregation, without a sort.
    unique = orders.groupBy("o_orderkey").agg(F.min("o_orderdate").alias("o_orderdate"))
    return cal.fiscal_report(cal.days_with_counts(unique, "o_orderdate", _calendar(spark, folder)))


@query(f"""{_WITH_DIM}
SELECT is_holiday, day_of_week_name, count(*) AS item_count,
    count(CASE WHEN is_business_day THEN 1 END) / count(*) AS business_day_ratio
FROM {_SHIP_DAYS} GROUP BY ALL
""")
def holiday_impact(spark: SparkSession, folder: str) -> DataFrame:
    return cal.holiday_impact(_ship_days(spark, folder))


@query(f"""{_WITH_DIM}
SELECT date_key, full_date::VARCHAR AS full_date, day_of_week_name, month_name, quarter_name, year,
    year_month, is_weekend, is_holiday, is_business_day, fiscal_year, fiscal_quarter
FROM dim WHERE full_date BETWEEN '1997-01-01' AND '1998-06-30'
""")
def v_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The view of common calendar fields, queried for a range of days."""
    dim = _calendar(spark, folder)
    dim.select(*cal.COMMON_FIELDS).createOrReplaceTempView("v_calendar")
    return spark.sql("SELECT * FROM v_calendar WHERE full_date BETWEEN '1997-01-01' AND '1998-06-30'")


@query(f"""{_WITH_DIM}
SELECT o_orderkey, o_custkey, year AS created_year, year_month AS created_year_month,
    fiscal_year AS created_fiscal_year, is_business_day AS created_is_business_day
FROM {_ORDER_DAYS} WHERE year = 1997
""")
def v_orders_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """The view of orders with prefixed calendar fields, queried for a year."""
    orders, dim = table(spark, folder, "orders"), _calendar(spark, folder)
    fields = ["year", "year_month", "fiscal_year", "is_business_day"]
    view = cal.with_calendar(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderdate", dim, "created_", fields
    )
    view.drop("o_orderdate").createOrReplaceTempView("v_orders_calendar")
    return spark.sql("SELECT * FROM v_orders_calendar WHERE created_year = 1997")


@query(f"""
WITH dim AS ({_dim_sql()}),
more AS ({_dim_sql('''SELECT least(a.low, b.low) AS low, greatest(a.high, b.high) AS high FROM
    (SELECT make_date(year(min(l_shipdate)), 1, 1) AS low, make_date(year(max(l_shipdate)), 12, 31) AS high
        FROM lineitem) a,
    (SELECT make_date(year(min(ts)), 1, 1) AS low, make_date(year(max(ts)), 12, 31) AS high FROM events) b''')})
SELECT date_key, full_date::VARCHAR AS full_date, is_business_day FROM more
WHERE full_date NOT IN (SELECT full_date FROM dim)
""")
def extend_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Days that the calendar of orders lacks to cover shipments and events too."""
    dim = _calendar(spark, folder)
    shipped = cal.span_of(table(spark, folder, "lineitem"), "l_shipdate")
    seen = cal.span_of(table(spark, folder, "events"), "ts")
    wider = (min(shipped[0], seen[0]), max(shipped[1], seen[1]))
    return cal.extend_calendar(dim, spark, *wider).select("date_key", "full_date", "is_business_day")


@query(f"""{_WITH_DIM}
SELECT count(*) AS total_dates, min(full_date)::VARCHAR AS earliest_date,
    max(full_date)::VARCHAR AS latest_date FROM dim
""")
def dim_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return cal.dim_bounds(_calendar(spark, folder))


@query(f"""{_WITH_DIM}
SELECT is_business_day, day_of_week_name, count(*) AS days FROM dim
WHERE full_date >= (SELECT max(o_orderdate)::DATE - 30 FROM orders) GROUP BY ALL
""")
def dim_check(spark: SparkSession, folder: str) -> DataFrame:
    """Weekdays and business days from 30 days before the last order on."""
    last = table(spark, folder, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    return cal.dim_check(_calendar(spark, folder), last)


@query(f"""{_WITH_DIM},
q AS (SELECT year, quarter, count(*) AS items FROM {_SHIP_DAYS} GROUP BY ALL),
w AS (SELECT *, lag(items) OVER t AS previous_quarter, lag(items, 4) OVER t AS previous_year
    FROM q WINDOW t AS (ORDER BY year, quarter))
SELECT year, quarter, items, previous_quarter,
    (items - previous_quarter) / previous_quarter AS quarter_change, previous_year,
    (items - previous_year) / previous_year AS year_change
FROM w
""")
def quarter_over_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return cal.period_over_period(_ship_days(spark, folder))

"""The calendar dimension and the reports built on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions.calendar import HOLIDAYS, calendar_columns, date_key

# A calendar of up to this many days (over 500 years, a few tens of MB) may be broadcast.
BROADCAST_DAYS = 200_000
COMMON_FIELDS = [
    "date_key", "full_date", "day_of_week_name", "month_name", "quarter_name", "year", "year_month",
    "is_weekend", "is_holiday", "is_business_day", "fiscal_year", "fiscal_quarter",
]


def calendar_of_days(days: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Calendar rows for a DataFrame with one DATE column ``day``.

    Holidays fall on fixed days of the year unless ``holidays`` (one DATE column ``day``) is given.
    """
    if holidays is None:
        flagged = days.withColumn("_holiday", F.date_format("day", "MM-dd").isin(*HOLIDAYS))
    else:
        listed = holidays.select("day").distinct().withColumn("_listed", F.lit(True))
        flagged = days.join(listed, "day", "left").withColumn("_holiday", F.col("_listed").isNotNull())
    wide = flagged.select(*calendar_columns(F.col("day")), F.col("_holiday").alias("is_holiday"))
    return wide.withColumn("is_business_day", ~F.col("is_weekend") & ~F.col("is_holiday"))


def date_dim(
    spark: SparkSession,
    start: date,
    end: date,
    holidays: DataFrame | None = None,
    audit: bool = False,
) -> DataFrame:
    """One row per day from ``start`` to ``end``; ``audit`` adds created and updated times.

    The result carries a broadcast hint when its number of days allows one.
    """
    days = spark.range(0, 1, 1, 1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day")
    )
    dim = calendar_of_days(days, holidays)
    if audit:
        now = F.current_timestamp().cast("timestamp_ntz")
        dim = dim.withColumns({"created_timestamp": now, "updated_timestamp": now})
    return F.broadcast(dim) if (end - start).days < BROADCAST_DAYS else dim


def known_calendar(dim: DataFrame) -> DataFrame:
    """A calendar read from a table, with the broadcast hint if its number of days allows one."""
    return F.broadcast(dim) if dim.count() <= BROADCAST_DAYS else dim


def span_of(df: DataFrame, *columns: str) -> tuple[date, date] | None:
    """First day of the first year and last day of the last year in the date columns; None without dates."""
    ends = df.agg(
        F.least(*[F.min(c) for c in (*columns, columns[0])]).cast("date").alias("low"),
        F.greatest(*[F.max(c) for c in (*columns, columns[0])]).cast("date").alias("high"),
    ).first()
    if ends.low is None:
        return None
    return date(ends.low.year, 1, 1), date(ends.high.year, 12, 31)


def extend_calendar(calendar: DataFrame, spark: SparkSession, start: date, end: date) -> DataFrame:
    """The rows of ``[start, end]`` that ``calendar`` lacks; appending them twice adds nothing."""
    return date_dim(spark, start, end).join(calendar.select("full_date"), "full_date", "left_anti")


def with_calendar(
    facts: DataFrame, date_column: str, calendar: DataFrame, prefix: str = "", fields=None
) -> DataFrame:
    """Facts with prefixed calendar fields; facts without a calendar day keep nulls."""
    fields = fields or COMMON_FIELDS
    dim = calendar.select(
        F.col("full_date").alias("_day"), *[F.col(f).alias(f"{prefix}{f}") for f in fields]
    )
    return facts.join(dim, F.to_date(date_column) == F.col("_day"), "left").drop("_day")


def date_join(facts: DataFrame, date_column: str, calendar: DataFrame) -> DataFrame:
    """Inner join on the day; facts with a null or uncovered date drop out."""
    return facts.join(calendar, F.to_date(date_column) == F.col("full_date"))


def date_key_join(facts: DataFrame, date_column: str, calendar: DataFrame) -> DataFrame:
    """The same join on the integer day key."""
    return facts.join(calendar, date_key(F.col(date_column)) == F.col("date_key"))


def days_with_counts(facts: DataFrame, date_column: str, calendar: DataFrame) -> DataFrame:
    """Calendar days that occur in ``facts`` with ``items``, their number of facts.

    Facts are counted per day before the join, so the join and all later grouping handle days,
    however many facts there are.
    """
    daily = facts.groupBy(F.to_date(date_column).alias("full_date")).agg(
        F.count(F.lit(1)).alias("items")
    )
    return daily.join(calendar, "full_date")


def _items(condition: Column | None = None) -> Column:
    if condition is None:
        return F.sum("items")
    return F.sum(F.when(condition, F.col("items")).otherwise(F.lit(0).cast("bigint")))


def _business_ratio() -> Column:
    return _items(F.col("is_business_day")) / _items()


def business_day_analysis(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("is_business_day", "day_of_week", "day_of_week_name")
        .agg(_items().alias("project_count"))
        .orderBy(F.desc("is_business_day"), "day_of_week")
        .drop("day_of_week")
    )


def monthly_performance(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("year_month", "month_name")
        .agg(
            _items().alias("total_projects"),
            _items(F.col("is_business_day")).alias("business_day_projects"),
            _items(F.col("is_holiday")).alias("holiday_projects"),
        )
        .orderBy("year_month")
    )


def quarterly_comparison(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("quarter", "quarter_name", "year")
        .agg(_items().alias("project_count"), _business_ratio().alias("business_day_ratio"))
        .orderBy("year", "quarter")
        .drop("quarter")
    )


def fiscal_report(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("fiscal_year", "fiscal_quarter")
        .agg(
            _items().alias("total_items"),
            _items(F.col("is_business_day")).alias("business_day_items"),
        )
        .orderBy("fiscal_year", "fiscal_quarter")
    )


def holiday_impact(days: DataFrame) -> DataFrame:
    return (
        days.groupBy("is_holiday", "day_of_week", "day_of_week_name")
        .agg(_items().alias("item_count"), _business_ratio().alias("business_day_ratio"))
        .orderBy(F.desc("is_holiday"), "day_of_week")
        .drop("day_of_week")
    )


def period_over_period(days: DataFrame) -> DataFrame:
    """Items per quarter against the quarter before and the same quarter of the year before.

    The window runs over quarters, a few hundred rows at most.
    """
    quarters = days.groupBy("year", "quarter").agg(_items().alias("items"))
    by_time = Window.orderBy("year", "quarter")
    before, year_before = F.lag("items").over(by_time), F.lag("items", 4).over(by_time)

    def change(base: Column) -> Column:
        return (F.col("items") - base) / base

    return quarters.select(
        "year",
        "quarter",
        "items",
        before.alias("previous_quarter"),
        change(before).alias("quarter_change"),
        year_before.alias("previous_year"),
        change(year_before).alias("year_change"),
    ).orderBy("year", "quarter")


def dim_bounds(calendar: DataFrame) -> DataFrame:
    return calendar.agg(
        F.count(F.lit(1)).alias("total_dates"),
        F.min("full_date").alias("earliest_date"),
        F.max("full_date").alias("latest_date"),
    )


def dim_check(calendar: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Days per (business day, weekday) from ``days`` before ``as_of`` on."""
    recent = calendar.filter(F.col("full_date") >= F.date_sub(F.lit(as_of), days))
    return (
        recent.groupBy("is_business_day", "day_of_week", "day_of_week_name")
        .agg(F.count(F.lit(1)).alias("days"))
        .orderBy(F.desc("is_business_day"), "day_of_week")
        .drop("day_of_week")
    )

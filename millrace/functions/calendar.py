"""Calendar attributes of a date as Column expressions, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed-day holidays, first month of the fiscal year (July to June).
HOLIDAYS = ("01-01", "07-04", "09-05", "11-11", "12-25")
FISCAL_START_MONTH = 7


def date_key(day: Column) -> Column:
    """The integer YYYYMMDD of a date or timestamp."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def date_key_from_timestamp(moment: Column) -> Column:
    return date_key(F.to_date(moment))


def register_sql_functions(spark: SparkSession) -> None:
    """``get_date_key`` and ``get_date_key_from_timestamp`` for use in SQL text."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_date_key(d DATE) RETURNS INT"
        " RETURN year(d) * 10000 + month(d) * 100 + day(d)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_date_key_from_timestamp(t TIMESTAMP_NTZ)"
        " RETURNS INT RETURN year(t) * 10000 + month(t) * 100 + day(t)"
    )


def micros(moment: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp without zone."""
    minutes = (F.unix_date(F.to_date(moment)).cast("bigint") * 24 + F.hour(moment)) * 60
    seconds = (minutes + F.minute(moment)) * 60
    fraction = F.date_part(F.lit("SECOND"), moment) * 1_000_000
    return seconds * 1_000_000 + fraction.cast("bigint")


def calendar_columns(day: Column) -> list[Column]:
    """The calendar attributes of a date that need no holiday table."""
    month, quarter, year = F.month(day), F.quarter(day), F.year(day)
    fiscal_month = (month + (12 - FISCAL_START_MONTH)) % 12 + 1
    fiscal_year = year + F.when(month >= FISCAL_START_MONTH, 1).otherwise(0)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.date_format(day, "EEE").alias("day_of_week_short"),
        F.day(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter).alias("quarter_name"),
        year.alias("year"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        (day == F.last_day(day)).alias("is_month_end"),
        ((day == F.last_day(day)) & (month % 3 == 0)).alias("is_quarter_end"),
        (F.date_format(day, "MM-dd") == "12-31").alias("is_year_end"),
        fiscal_year.alias("fiscal_year"),
        F.ceil(fiscal_month / 3).cast("int").alias("fiscal_quarter"),
        fiscal_month.alias("fiscal_month"),
    ]

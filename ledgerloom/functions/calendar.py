"""Calendar expressions and the date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_key(col: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.day(col)).cast("int")


def key_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def date_of_key(col: Column) -> Column:
    """Inverse of :func:`date_key` for valid keys."""
    return F.make_date(
        F.floor(col / 10000).cast("int"), (F.floor(col / 100) % 100).cast("int"), (col % 100).cast("int")
    )


def week_of_year(d: Column) -> Column:
    """Weeks start on Sunday and week 1 holds 1 January (not the ISO week)."""
    return F.ceil((F.dayofyear(d) + F.dayofweek(F.trunc(d, "year")) - 1) / 7).cast("int")


def week_of_month(d: Column) -> Column:
    """One plus the number of Sundays passed since the month began."""
    return F.ceil((F.day(d) + F.dayofweek(F.trunc(d, "month")) - 1) / 7).cast("int")


def month_end(d: Column, months: int = 0) -> Column:
    return F.last_day(F.add_months(d, months) if months else d)


def date_series(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(0, (end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("Date")
    )


def whole_years_of(df: DataFrame, date_col: str) -> DataFrame:
    """One row per day of every calendar year that the dates of ``df`` touch."""
    span = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    first = F.trunc("lo", "year")
    last = F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    return span.where("lo is not null").select(F.explode(F.sequence(first, last)).alias("Date"))


def with_calendar_columns(days: DataFrame, as_of: date) -> DataFrame:
    """The date-dimension columns for a frame with a ``Date`` column."""
    d = F.col("Date")
    today = F.lit(as_of)
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    weekend = F.dayofweek(d).isin(1, 7)
    return days.select(
        date_key(d).alias("DateKey"),
        d.cast("timestamp_ntz").alias("FullDateTime"),
        d.alias("Date"),
        year.alias("Year"),
        year.cast("string").alias("YearName"),
        quarter.alias("Quarter"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("QuarterName"),
        F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")).alias("YearQuarter"),
        month.alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.left(F.date_format(d, "MMMM"), F.lit(3)).alias("MonthNameShort"),
        F.date_format(d, "yyyy-MM").alias("YearMonth"),
        F.date_format(d, "yyyy MMMM").alias("YearMonthName"),
        F.day(d).alias("Day"),
        (F.weekday(d) + 1).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.left(F.date_format(d, "EEEE"), F.lit(3)).alias("DayNameShort"),
        F.dayofyear(d).alias("DayOfYear"),
        week_of_year(d).alias("WeekOfYear"),
        week_of_month(d).alias("WeekOfMonth"),
        F.when(month >= 4, year).otherwise(year - 1).alias("FiscalYear"),
        F.when(quarter == 1, 4).otherwise(quarter - 1).alias("FiscalQuarter"),
        ((month + 8) % 12 + 1).alias("FiscalMonth"),
        F.lit("00:00:00").alias("Time"),
        F.lit(0).alias("Hour"),
        F.lit("00:00").alias("HourName"),
        F.lit(0).alias("Minute"),
        F.lit("Night").alias("TimeOfDay"),
        weekend.alias("IsWeekend"),
        F.lit(False).alias("IsHoliday"),
        (~weekend).alias("IsWorkingDay"),
        (d == today).alias("IsToday"),
        (d == F.date_sub(today, 1)).alias("IsYesterday"),
        (F.trunc(d, "month") == F.trunc(today, "month")).alias("IsCurrentMonth"),
        (F.trunc(d, "quarter") == F.trunc(today, "quarter")).alias("IsCurrentQuarter"),
        (year == as_of.year).alias("IsCurrentYear"),
    )


def build_dim_date(spark: SparkSession, start: date, end: date, as_of: date) -> DataFrame:
    return with_calendar_columns(date_series(spark, start, end), as_of)


def with_month_label(dim_date: DataFrame) -> DataFrame:
    """Add the report label (Jan-98) and the integer that sorts it."""
    return dim_date.withColumns(
        {
            "MonthLabel": F.date_format("Date", "MMM-yy"),
            "MonthSort": F.col("Year") * 100 + F.col("Month"),
        }
    )


def date_statistics(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(
        F.min("Date").alias("MinDate"),
        F.max("Date").alias("MaxDate"),
        F.count(F.lit(1)).alias("TotalDays"),
        F.count_if("IsWeekend").alias("TotalWeekends"),
        F.count_if("IsWorkingDay").alias("TotalWorkingDays"),
    )


def month_calendar(dim_date: DataFrame, start: date, cutoff: date) -> DataFrame:
    """Month ends within [start, cutoff] and the last day key of each: at most one row a month."""
    return (
        dim_date.where(F.col("Date").between(F.lit(start), F.lit(cutoff)))
        .groupBy(F.last_day("Date").alias("MonthEndDate"))
        .agg(F.max("DateKey").alias("MonthEndDateKey"))
    )

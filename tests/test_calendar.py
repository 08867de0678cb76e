from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerloom.functions import calendar


def test_date_dimension_of_sixteen_years(spark):
    dim = calendar.build_dim_date(spark, date(2015, 1, 1), date(2030, 12, 31), date(2016, 8, 31))
    stats = calendar.date_statistics(dim).first()
    assert (stats.TotalDays, stats.TotalWeekends, stats.TotalWorkingDays) == (5844, 1670, 4174)
    top = dim.agg(F.max("WeekOfYear").alias("y"), F.max("WeekOfMonth").alias("m")).first()
    assert (top.y, top.m) == (54, 6)
    assert len(dim.columns) == 36


def test_weeks_start_on_sunday(spark):
    dim = calendar.build_dim_date(spark, date(2015, 1, 1), date(2017, 12, 31), date(2016, 8, 31))
    for row in dim.select("Date", "WeekOfYear", "WeekOfMonth", "DayOfWeek").collect():
        d = row.Date

        def sundays(first):
            days = (d - first).days
            return 1 + sum((first + timedelta(n)).weekday() == 6 for n in range(1, days + 1))

        assert row.WeekOfYear == sundays(date(d.year, 1, 1))
        assert row.WeekOfMonth == sundays(date(d.year, d.month, 1))
        assert row.DayOfWeek == d.isoweekday()


def test_fiscal_year_starts_in_april(spark):
    dim = calendar.build_dim_date(spark, date(2016, 3, 31), date(2016, 4, 1), date(2016, 4, 1))
    march, april = dim.orderBy("DateKey").collect()
    assert (march.FiscalYear, march.FiscalQuarter, march.FiscalMonth) == (2015, 4, 12)
    assert (april.FiscalYear, april.FiscalQuarter, april.FiscalMonth) == (2016, 1, 1)
    assert april.IsToday and march.IsYesterday and not march.IsCurrentMonth and march.IsCurrentYear


def test_whole_years_of_data(spark):
    dates = spark.createDataFrame([(date(1999, 5, 5),), (None,), (date(2000, 2, 1),)], "d date")
    days = calendar.whole_years_of(dates, "d").agg(F.min("Date"), F.max("Date"), F.count("*")).first()
    assert tuple(days) == (date(1999, 1, 1), date(2000, 12, 31), 365 + 366)
    assert calendar.whole_years_of(dates.where("d is null"), "d").count() == 0


def test_keys_and_labels(spark):
    dim = calendar.with_month_label(calendar.build_dim_date(spark, date(1998, 1, 31), date(1998, 1, 31), date(1998, 1, 1)))
    row = dim.withColumn("back", calendar.date_of_key(F.col("DateKey"))).first()
    assert (row.DateKey, row.back, row.MonthLabel, row.MonthSort) == (19980131, date(1998, 1, 31), "Jan-98", 199801)

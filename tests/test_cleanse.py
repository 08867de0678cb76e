from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import cleanse


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_missing_marker_is_found_after_or_before_trimming(spark):
    words = [" nan ", "nan", "", None, " A "]
    assert column(spark, words, cleanse.clean_nan) == [None, None, "", None, "A"]
    untrimmed = column(spark, words, lambda c: cleanse.clean_nan(c, trim_test=False))
    assert untrimmed == ["nan", None, "", None, "A"]


def test_dates_are_day_month_year_or_null(spark):
    texts = ["13/1/2015", "03/01/2015", "nan", "1/13/2015", "31/2/1998", "29/2/2016", "13/1/15", "", None]
    expected = [date(2015, 1, 13), date(2015, 1, 3), None, None, None, date(2016, 2, 29), None, None, None]
    assert column(spark, texts, cleanse.parse_dmy) == expected


def test_birth_dates_follow_the_policy(spark):
    texts = ["1/1/1800", "31/12/1929", "1/1/1930", "31/12/2005", "1/1/2006", "nan"]
    strict = column(spark, texts, cleanse.parse_dob)
    assert strict == [None, None, date(1930, 1, 1), date(2005, 12, 31), None, None]
    lenient = column(spark, texts, lambda c: cleanse.parse_dob(c, "default_1900"))
    assert lenient[0] == date(1800, 1, 1) and lenient[-1] == date(1900, 1, 1)


def test_money_refuses_exponents_and_defaults_to_zero(spark):
    texts = ["12.345", "-7", " 5 ", ".5", "1e3", "abc", "nan", None, "12."]
    expected = ["12.35", "-7.00", "5.00", "0.50", "0.00", "0.00", "0.00", "0.00", "12.00"]
    assert column(spark, texts, cleanse.parse_money) == [Decimal(x) for x in expected]


def test_gender_words(spark):
    words = ["m", " MALE ", "F", "Female", "x", None]
    expected = ["Male", "Male", "Female", "Female", "Unknown", "Unknown"]
    assert column(spark, words, cleanse.normalize_gender) == expected


def test_location_code_and_default(spark):
    assert column(spark, [" New delhi ", "A_B", "a b"], cleanse.location_code) == ["NEW_DELHI", "A_B", "A_B"]
    assert column(spark, [" nan ", None, " X "], cleanse.location_or_default) == ["Unspecified", "Unspecified", "X"]


def test_age_turns_on_the_birthday(spark):
    as_of = date(2016, 8, 31)
    born = [date(1990, 8, 31), date(1990, 9, 1), date(1992, 2, 29), None]
    assert column(spark, born, lambda c: cleanse.age_years(c, as_of), "date") == [26, 25, 24, None]


def test_age_bands_in_both_modes(spark):
    ages = [17, 18, 25, 26, 55, 56, 57, None]
    documented = column(spark, ages, cleanse.age_group, "int")
    assert documented == ["Unknown", "18-25", "18-25", "26-35", "46-55", "56+", "56+", "Unknown"]
    as_coded = column(spark, ages, lambda c: cleanse.age_group(c, "as_coded"), "int")
    assert as_coded == ["Unknown", "18-25", "18-25", "26-35", "46-55", "Unknown", "56+", "Unknown"]


def test_customer_type_modes(spark):
    as_of = date(2016, 8, 31)
    first = [date(2016, 6, 2), date(2016, 6, 1)]
    assert column(spark, first, lambda c: cleanse.customer_type(c, as_of), "date") == ["Existing"] * 2
    documented = column(spark, first, lambda c: cleanse.customer_type(c, as_of, "documented"), "date")
    assert documented == ["New", "Existing"]


def test_time_of_day_bands(spark):
    times = ["55959", "60000", "115959", "120000", "180000", "215959", "220000", "0", "x"]
    bands = ["Night", "Morning", "Morning", "Afternoon", "Evening", "Evening", "Night", "Night", None]
    assert column(spark, times, cleanse.time_of_day) == bands


def test_number_texts(spark):
    assert column(spark, [1234567.891], cleanse.fmt_pct, "double") == ["1,234,567.89%"]
    assert column(spark, [0.15764], cleanse.display_rate, "double") == ["15.76%"]
    assert column(spark, [13051115], cleanse.fmt_int, "long") == ["13,051,115"]

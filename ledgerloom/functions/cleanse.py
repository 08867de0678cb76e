"""Cleansing expressions over the raw text columns. All are plain Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MISSING_TEXT = "nan"
MISSING_LOCATION = "Unspecified"
MALE_WORDS = ("M", "MALE")
FEMALE_WORDS = ("F", "FEMALE")
DATE_PATTERN = "d/M/yyyy"
PLAIN_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
DOB_FIRST_YEAR, DOB_LAST_YEAR = 1930, 2005
DOB_DEFAULT = date(1900, 1, 1)
NEW_CUSTOMER_DAYS = 90


def clean_nan(col: Column, trim_test: bool = True) -> Column:
    """Trim, and turn the missing marker into NULL.

    With ``trim_test=False`` the marker is looked for before trimming, so a marker with
    blanks around it survives as text.
    """
    trimmed = F.trim(col)
    tested = trimmed if trim_test else col
    return F.when(tested != MISSING_TEXT, trimmed)


def customer_id(col: Column) -> Column:
    """Customer id in the one form that joins use: trimmed, upper case, NULL if missing."""
    return F.upper(clean_nan(col))


def location_or_default(col: Column) -> Column:
    return F.coalesce(clean_nan(col), F.lit(MISSING_LOCATION))


def location_code(col: Column) -> Column:
    return F.upper(F.replace(F.trim(col), F.lit(" "), F.lit("_")))


def normalize_gender(col: Column) -> Column:
    word = F.upper(F.trim(col))
    return (
        F.when(word.isin(*MALE_WORDS), "Male")
        .when(word.isin(*FEMALE_WORDS), "Female")
        .otherwise("Unknown")
    )


def parse_dmy(col: Column) -> Column:
    """d/m/yyyy text to date; NULL where it is no such date."""
    return F.try_to_timestamp(col, F.lit(DATE_PATTERN)).cast("date")


def parse_dob(col: Column, policy: str = "null_out_of_range") -> Column:
    parsed = parse_dmy(col)
    if policy == "default_1900":
        return F.coalesce(parsed, F.lit(DOB_DEFAULT))
    return F.when(F.year(parsed).between(DOB_FIRST_YEAR, DOB_LAST_YEAR), parsed)


def parse_decimal(col: Column) -> Column:
    """Plain decimal text to DECIMAL(18,2), NULL otherwise (exponents are refused)."""
    return F.when(col.rlike(PLAIN_DECIMAL), col.try_cast("decimal(18,2)"))


def parse_money(col: Column) -> Column:
    return F.coalesce(parse_decimal(col), F.lit(0).cast("decimal(18,2)"))


def age_years(dob: Column, as_of: date) -> Column:
    """Whole years lived on ``as_of``."""
    before_birthday = (F.month(dob) > as_of.month) | (
        (F.month(dob) == as_of.month) & (F.day(dob) > as_of.day)
    )
    return (F.lit(as_of.year) - F.year(dob) - before_birthday.cast("int")).cast("int")


def age_group(age: Column, mode: str = "documented") -> Column:
    oldest = age >= 56 if mode == "documented" else age > 56
    return (
        F.when(age.between(18, 25), "18-25")
        .when(age.between(26, 35), "26-35")
        .when(age.between(36, 45), "36-45")
        .when(age.between(46, 55), "46-55")
        .when(oldest, "56+")
        .otherwise("Unknown")
    )


def customer_type(first_txn: Column, as_of: date, mode: str = "as_coded") -> Column:
    if mode == "as_coded":
        return F.lit("Existing")
    recent = F.datediff(F.lit(as_of), first_txn) <= NEW_CUSTOMER_DAYS
    return F.when(recent, "New").otherwise("Existing")


def time_of_day(hhmmss: Column) -> Column:
    """Band of an HHMMSS number: 6-12, 12-18, 18-22, and the night around them."""
    hour = F.floor(hhmmss.try_cast("int") / 10000)
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .when(hour.isNotNull(), "Night")
    )


def fmt_pct(col: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(col, digits), F.lit("%"))


def fmt_int(col: Column) -> Column:
    return F.format_number(col, 0)


def display_rate(col: Column, digits: int = 2) -> Column:
    """A fraction as percent text."""
    return fmt_pct(col * 100, digits)

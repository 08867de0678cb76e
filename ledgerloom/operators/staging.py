"""Raw text to the three staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import clean_nan, customer_id, location_code, parse_dmy


def add_flags(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """Quality flags: true where the cleansed column is NULL."""
    return df.withColumns({flag: F.col(column).isNull() for flag, column in flags.items()})


def stage_transactions(raw: DataFrame) -> DataFrame:
    """Cleansed text, quality flags, and the date read once as ``TransactionDay``.

    Reading d/m/yyyy text is the dearest expression of the load, and the customer
    history and the fact both need it, so it is kept as a typed column here.
    """
    clean = raw.where(F.col("TransactionID").isNotNull()).select(
        F.trim("TransactionID").alias("TransactionID"),
        customer_id(F.col("CustomerID")).alias("CustomerID"),
        clean_nan(F.col("TransactionDate"), trim_test=False).alias("TransactionDate"),
        clean_nan(F.col("TransactionAmount"), trim_test=False).alias("TransactionAmount"),
        clean_nan(F.col("CustAccountBalance"), trim_test=False).alias("AccountBalance"),
        clean_nan(F.col("CustLocation")).alias("CustLocation"),
    )
    dated = clean.withColumn("TransactionDay", parse_dmy(F.col("TransactionDate")))
    return add_flags(
        dated,
        {
            "HasInvalidCustomerID": "CustomerID",
            "HasInvalidDate": "TransactionDate",
            "HasInvalidAmount": "TransactionAmount",
        },
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    distinct = (
        raw.where(F.col("CustomerID").isNotNull())
        .select("CustomerID", "CustLocation", "CustomerDOB", "CustGender")
        .distinct()
    )
    clean = distinct.select(
        customer_id(F.col("CustomerID")).alias("CustomerID"),
        clean_nan(F.col("CustLocation")).alias("Location"),
        clean_nan(F.col("CustomerDOB"), trim_test=False).alias("DOB"),
        clean_nan(F.col("CustGender")).alias("Gender"),
    )
    flagged = add_flags(
        clean,
        {
            "HasInvalidCustomerID": "CustomerID",
            "HasInvalidLocation": "Location",
            "HasInvalidDOB": "DOB",
        },
    )
    return with_location_code(flagged)


def with_location_code(df: DataFrame, location: str = "Location") -> DataFrame:
    """Add the join code of the location where there is one."""
    known = F.col(location).isNotNull() & (F.col(location) != "nan")
    return df.withColumn("LocationCode", F.when(known, location_code(F.col(location))))


def stage_locations(raw: DataFrame) -> DataFrame:
    return (
        raw.select(clean_nan(F.col("CustLocation")).alias("Location"))
        .where(F.col("Location").isNotNull())
        .distinct()
    )


def stage(raw: DataFrame) -> dict[str, DataFrame]:
    """The three independent staging flows."""
    return {
        "Stg_Transaction": stage_transactions(raw),
        "Stg_Customer": stage_customers(raw),
        "Stg_Location": stage_locations(raw),
    }

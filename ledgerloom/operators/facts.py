"""The transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import location_code, location_or_default, parse_money
from ledgerloom.operators.scd2 import scd2_join
from ledgerloom.operators.skew import balanced_join

_SPREAD = ["TransactionID", "Date", "TransactionAmount", "AccountBalance"]


def dated_transactions(stg_txn: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Transactions with a customer and a date that the calendar holds, typed once."""
    typed = stg_txn.where(F.col("CustomerID").isNotNull() & F.col("TransactionDay").isNotNull()).select(
        "TransactionID",
        "CustomerID",
        F.col("TransactionDay").alias("Date"),
        "CustLocation",
        F.upper(location_or_default(F.col("CustLocation"))).alias("LocationMatch"),
        parse_money(F.col("TransactionAmount")).alias("TransactionAmount"),
        parse_money(F.col("AccountBalance")).alias("AccountBalance"),
    )
    # one row per day: broadcast is bounded by the length of the calendar
    days = dim_date.select("Date", "DateKey", F.col("YearMonth"))
    return typed.join(F.broadcast(days), "Date")


def build_fact_transaction(
    stg_txn: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
    scd_join: str = "version_key",
    windows: DataFrame | None = None,
) -> DataFrame:
    """One row per transaction and matching customer version.

    With ``version_key`` the version carries the location of the transaction, so its
    location key serves both and the location dimension is not joined again. ``date_range``
    joins ``windows`` of the versions, if given, in place of their whole ones.
    """
    facts = dated_transactions(stg_txn, dim_date)
    if scd_join == "version_key":
        versions = dim_customer.select(
            "CustomerID", "LocationMatch", "CustomerKey", "LocationKey", "StartDate", "EndDate", "DatedRows"
        )
        # of the raw place only its absence counts from here on
        placed = facts.withColumn("_placed", F.col("CustLocation").isNotNull()).drop("CustLocation")
        joined = scd2_join(placed, versions, "CustomerID", "Date", "version_key", spread_by=_SPREAD)
        located = joined.withColumn("LocationKey", F.when(F.col("_placed"), F.col("LocationKey")))
    else:
        windows = dim_customer if windows is None else windows
        versions = windows.select("CustomerID", "CustomerKey", "StartDate", "EndDate", "DatedRows")
        joined = scd2_join(facts, versions, "CustomerID", "Date", "date_range", spread_by=_SPREAD)
        places = dim_location.select("LocationCode", "LocationKey")
        by_place = dim_customer.groupBy(location_code(F.col("Location")).alias("LocationCode")).agg(
            F.sum("DatedRows").alias("DatedRows")
        )
        coded = joined.withColumn("LocationCode", location_code(F.col("CustLocation")))
        located = balanced_join(coded, places, ["LocationCode"], by_place, "DatedRows", _SPREAD, how="left")
    return located.select(
        "CustomerKey",
        "DateKey",
        "LocationKey",
        "TransactionID",
        "TransactionAmount",
        "AccountBalance",
        F.lit(1).alias("TransactionCount"),
        F.col("YearMonth").alias("year_month"),
    )


def monthly_volume(fact: DataFrame) -> DataFrame:
    """Transactions and amount per year-month."""
    return fact.groupBy(F.col("year_month").alias("YearMonth")).agg(
        F.count(F.lit(1)).alias("TransactionCount"),
        F.sum("TransactionAmount").cast("decimal(28,2)").alias("TotalAmount"),
    )



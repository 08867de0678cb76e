"""Profiles of the seed customers and checks of the raw source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import parse_dmy
from ledgerloom.operators.quantile import exact_percentile
from ledgerloom.operators.reports import distinct_count
from ledgerloom.sources.readers import SEED_AMOUNT, finite_number
from ledgerloom.sources.workspace import cut_lineage

CAP_PERCENTILE = 0.99


def seed_customer_profiles(seed: DataFrame, order_by: list[str]) -> DataFrame:
    """Geometric mean of the positive amounts and first attributes of each customer.

    "First" is the first non-missing value in the order of ``order_by`` columns. All of it
    is one aggregation that combines on the map side.
    """
    amount = F.col("TransactionAmount")
    order = F.struct(*order_by)

    def first(name: str):
        known = F.col(name).isNotNull()
        return F.min_by(F.when(known, F.col(name)), F.when(known, order))

    return (
        seed.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.coalesce(F.exp(F.avg(F.when(amount > 0, F.log(amount)))), F.lit(SEED_AMOUNT)).alias("AvgAmount"),
            first("CustAccountBalance").alias("StartingBalance"),
            first("CustGender").alias("Gender"),
            first("CustLocation").alias("Location"),
            first("CustomerDOB").alias("DOB"),
        )
    )


def cap_at_percentile(profiles: DataFrame, col: str = "AvgAmount", p: float = CAP_PERCENTILE) -> DataFrame:
    """Bring values above the exact percentile down to it."""
    cap = exact_percentile(profiles, col, p)
    return profiles if cap is None else profiles.withColumn(col, F.least(F.col(col), F.lit(cap)))


def build_seed_profiles(seed: DataFrame, order_by: list[str], name: str = "seed_profiles") -> DataFrame:
    """Capped profiles. They are written once, as the percentile reads them several times."""
    return cap_at_percentile(cut_lineage(seed_customer_profiles(seed, order_by), name))


def distinct_locations(seed: DataFrame) -> DataFrame:
    return seed.where(F.col("CustLocation").isNotNull()).select("CustLocation").distinct().orderBy("CustLocation")


def verify_source(raw: DataFrame) -> DataFrame:
    """Rows, customers, locations, date range as text and as dates, and number summaries.

    Amounts and balances that are not numbers count as missing.
    """
    amount, balance = finite_number("TransactionAmount"), finite_number("CustAccountBalance")
    parsed = parse_dmy(F.col("TransactionDate"))
    plain = raw.agg(
        F.min("TransactionDate").alias("MinDate"),
        F.max("TransactionDate").alias("MaxDate"),
        F.min(parsed).alias("MinParsedDate"),
        F.max(parsed).alias("MaxParsedDate"),
        F.count(F.lit(1)).alias("TotalRows"),
        F.avg(amount).alias("AvgAmount"),
        F.max(amount).alias("MaxAmount"),
        F.avg(balance).alias("AvgBalance"),
        F.min(balance).alias("MinBalance"),
    )
    for column, alias in (("CustomerID", "UniqueCustomers"), ("CustLocation", "UniqueLocations")):
        plain = plain.withColumn(alias, distinct_count(raw, column).scalar())
    return plain


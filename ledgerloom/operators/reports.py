"""Distributions and summary reports over single tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.cleanse import DOB_DEFAULT, customer_id, fmt_pct, parse_dmy
from ledgerloom.functions.scoring import loyalty_class

# Raw columns whose gaps are counted, and the bands of account balance.
PROFILED_COLUMNS = {
    "TransactionID_Nulls": "TransactionID",
    "CustomerID_Nulls": "CustomerID",
    "CustomerDOB_Nulls": "CustomerDOB",
    "Gender_Nulls": "CustGender",
    "Location_Nulls": "CustLocation",
    "Balance_Nulls": "CustAccountBalance",
    "Date_Nulls": "TransactionDate",
    "Amount_Nulls": "TransactionAmount",
}


def with_share(groups: DataFrame, total: DataFrame, count: str, digits: int) -> DataFrame:
    """``groups`` with ``Pct``, the percent that ``count`` is of the one value of ``total``.

    The total is a subquery of its own, so that the groups, however many, stay where they are.
    """
    exact = F.col(count).cast("decimal(20,0)") * 100 / total.scalar().cast("decimal(20,0)")
    return groups.withColumn("Pct", F.round(exact, digits).cast(f"decimal(7,{digits})"))


def distribution(
    df: DataFrame, by: str | list[str], count: str = "Records", digits: int = 2, top: int | None = None
) -> DataFrame:
    """Rows per value and their share of all rows; optionally the largest ``top`` groups.

    The share runs over the groups, not over the rows.
    """
    by = [by] if isinstance(by, str) else by
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias(count))
    total = grouped.agg(F.sum(count))
    if top is not None:
        grouped = grouped.orderBy(F.desc(count), *by).limit(top)
    return with_share(grouped, total, count, digits)


def customers_by_place(dim_customer: DataFrame, dim_location: DataFrame, attribute: str = "State") -> DataFrame:
    """Current customers by an attribute of their location, with shares.

    They are counted by location key first, so only the counts meet the location names.
    """
    per_key = dim_customer.where("IsCurrent").groupBy("LocationKey").agg(F.count(F.lit(1)).alias("_n"))
    named = per_key.join(dim_location.select("LocationKey", attribute), "LocationKey", "left")
    counts = named.groupBy(attribute).agg(F.sum("_n").alias("CustomerCount"))
    return with_share(counts, per_key.agg(F.sum("_n")), "CustomerCount", 2)


def with_percent_text(df: DataFrame, digits: int = 2, col: str = "Pct") -> DataFrame:
    return df.withColumn(col, fmt_pct(F.col(col), digits))


def profile_raw(raw: DataFrame) -> DataFrame:
    """Rows, missing values, customers and date range of the raw table.

    Customers are counted in an aggregation of their own: beside text ranges a distinct
    count would sort the whole table.
    """
    gaps = [
        F.count_if(F.col(name).isNull() | (F.col(name) == "nan")).alias(alias)
        for alias, name in PROFILED_COLUMNS.items()
    ]
    parsed = parse_dmy(F.col("TransactionDate"))
    plain = raw.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        *gaps,
        F.min("TransactionDate").alias("MinDate"),
        F.max("TransactionDate").alias("MaxDate"),
        F.min(parsed).alias("MinParsedDate"),
        F.max(parsed).alias("MaxParsedDate"),
    )
    return plain.withColumn("UniqueCustomers", distinct_count(raw, "CustomerID").scalar())


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """How many different values a column has, NULL left out, as one row."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count(F.lit(1)))


def approximate_customers(raw: DataFrame, error: float = 0.01) -> DataFrame:
    """Customer count by sketch, where an estimate will do."""
    return raw.agg(F.approx_count_distinct("CustomerID", error).alias("UniqueCustomers"))


def flag_counts(stg_txn: DataFrame) -> DataFrame:
    flags = ["HasInvalidCustomerID", "HasInvalidDate", "HasInvalidAmount"]
    return stg_txn.groupBy(*flags).agg(F.count(F.lit(1)).alias("RecordCount"))


def customer_summary(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.agg(
        F.count(F.lit(1)).alias("TotalRecords"),
        F.countDistinct("CustomerID").alias("UniqueCustomers"),
        F.count_if("IsCurrent").alias("CurrentRecords"),
        F.count_if(~F.col("IsCurrent")).alias("HistoricalRecords"),
    )


def customer_quality(dim_customer: DataFrame) -> DataFrame:
    """Gaps in the attributes of the current customer rows."""
    missing_dob = F.col("DateOfBirth").isNull() | (F.col("DateOfBirth") == F.lit(DOB_DEFAULT))
    missing_age = F.col("Age").isNull() | (F.col("Age") == 0)
    return dim_customer.where("IsCurrent").agg(
        F.count_if(missing_dob).alias("MissingDOB"),
        F.count_if(missing_age).alias("MissingAge"),
        F.count_if(F.col("Gender") == "Unknown").alias("UnknownGender"),
        F.count_if(F.col("LocationKey").isNull()).alias("MissingLocation"),
        F.count_if(F.col("AgeGroup") == "Unknown").alias("UnknownAgeGroup"),
    )


def recency_distribution(raw: DataFrame, cutoff: date) -> DataFrame:
    """Customers by days between their last readable date and ``cutoff``."""
    last = (
        raw.select(customer_id(F.col("CustomerID")).alias("CustomerID"), parse_dmy(F.col("TransactionDate")).alias("_d"))
        .where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(F.max("_d").alias("LastTxnDate"))
    )
    days = F.datediff(F.lit(cutoff), F.col("LastTxnDate"))
    bucket = (
        F.when(days <= 30, "0-30 days (Active)")
        .when(days <= 60, "31-60 days (Watch)")
        .when(days <= 90, "61-90 days (AtRisk)")
        .otherwise("90+ days (Churned)")
    )
    return last.groupBy(bucket.alias("RecencyBucket")).agg(F.count(F.lit(1)).alias("CustomerCount"))


def loyalty_distribution(snapshot: DataFrame) -> DataFrame:
    return distribution(snapshot.select(loyalty_class(F.col("LoyaltyScore")).alias("Category")), "Category", digits=1)


def churn_loyalty(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("ChurnFlag").agg(
        F.count(F.lit(1)).alias("Records"), F.avg("LoyaltyScore").cast("decimal(9,6)").alias("AvgLoyalty")
    )


def segment_distribution(snapshot: DataFrame, dim_segment: DataFrame) -> DataFrame:
    """Customer-months per segment and their share; rows without a segment are left out.

    The snapshot is counted by key first, so the names join to a handful of rows.
    """
    counts = snapshot.groupBy("SegmentKey").agg(F.count(F.lit(1)).alias("CustomerMonths"))
    named = counts.join(dim_segment.select("SegmentKey", "SegmentName", "DisplayOrder"), "SegmentKey")
    total = named.agg(F.sum("CustomerMonths"))
    return with_share(named, total, "CustomerMonths", 2).select("SegmentName", "DisplayOrder", "CustomerMonths", "Pct")


def latest_risk(snapshot: DataFrame, last_date_key: int) -> DataFrame:
    """Churned and at-risk customers of the month ``last_date_key``, with rates in percent."""
    counted = snapshot.where(F.col("DateKey") == last_date_key).agg(
        F.count_if("ChurnFlag").alias("ChurnedCustomers"),
        F.count_if("AtRiskFlag").alias("AtRiskCustomers"),
        F.count(F.lit(1)).alias("TotalCustomers"),
    )

    def rate(name: str) -> Column:
        parts = F.col(name).cast("decimal(20,0)") * 100
        return F.round(F.try_divide(parts, F.col("TotalCustomers").cast("decimal(20,0)")), 2).cast("decimal(7,2)")

    return counted.withColumns({"ChurnRate": rate("ChurnedCustomers"), "AtRiskRate": rate("AtRiskCustomers")})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("TableRows")).select(F.lit(name).alias("TableName"), "TableRows")
        for name, df in tables.items()
    ]
    report = counts[0]
    for row in counts[1:]:
        report = report.unionByName(row)
    return report


def top_n_other(df: DataFrame, dim: str, measure: str, n: int, other: str = "Other") -> DataFrame:
    """Sum a measure by ``dim``; ranks after ``n`` fold into one row.

    Ties share a dense rank: what counts is the ``n``-th largest distinct sum, which is found
    by a distributed top-n and compared with each group's own.
    """
    totals = df.groupBy(dim).agg(F.sum(measure).alias(measure))
    largest = totals.select(measure).where(F.col(measure).isNotNull()).distinct().orderBy(F.desc(measure)).limit(n)
    # without n distinct sums, groups whose sum is NULL rank next and belong to the first n too
    least, found = largest.agg(F.min(measure)).scalar(), largest.agg(F.count(F.lit(1))).scalar()
    ranked = totals.select(dim, measure, least.alias("_least"), found.alias("_found"))
    first = F.when(F.col(measure).isNull(), F.col("_found") < n).otherwise(F.col(measure) >= F.col("_least"))
    group = F.when(first, F.col(dim)).otherwise(other)
    ranked = ranked.select(group.alias(f"{dim}Group"), measure)
    return ranked.groupBy(f"{dim}Group").agg(F.sum(measure).alias(measure))


def sample_facts(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` transactions by key with customer and date.

    The rows are chosen before the joins, so the dimensions meet ``n`` rows only.
    """
    order = ["TransactionKey"] if "TransactionKey" in fact.columns else ["TransactionID", "DateKey"]
    chosen = fact.orderBy(*order).limit(n)
    return (
        chosen.join(dim_customer.select("CustomerKey", "CustomerID"), "CustomerKey")
        .join(dim_date.select("DateKey", "Date"), "DateKey")
        .orderBy(*order)
    )

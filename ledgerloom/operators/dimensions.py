"""Location and customer dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.functions.cleanse import (
    age_group,
    age_years,
    customer_type,
    location_code,
    location_or_default,
    normalize_gender,
    parse_dob,
)
from ledgerloom.operators.keys import with_surrogate_key
from ledgerloom.operators.skew import balanced_join

# Fixed values of the dimensions.
GENDERS = ("Female", "Male", "Unknown")
COUNTRY, LOCATION_TYPE, UNKNOWN = "India", "City", "Unknown"


def enrich_location(locations: DataFrame, city_lookup: DataFrame) -> DataFrame:
    """Add State and Region by city name; Unknown where the lookup has no such city."""
    cities = city_lookup.groupBy(F.upper(F.trim("CityName")).alias("_city")).agg(
        F.min_by(F.struct("State", "Region"), F.struct("CityName", "State")).alias("_found")
    )
    return (
        locations.withColumn("_city", F.upper(F.trim("LocationName")))
        .join(cities, "_city", "left")
        .select(
            *locations.columns,
            F.coalesce("_found.State", F.lit(UNKNOWN)).alias("State"),
            F.coalesce("_found.Region", F.lit(UNKNOWN)).alias("Region"),
        )
    )


def location_rows(stg_location: DataFrame, city_lookup: DataFrame) -> DataFrame:
    """One row per location code (the smallest spelling names it), without surrogate key."""
    coded = (
        stg_location.where(F.col("Location").isNotNull())
        .groupBy(location_code(F.col("Location")).alias("LocationCode"))
        .agg(F.min("Location").alias("LocationName"))
    )
    return enrich_location(coded, city_lookup).select(
        "LocationCode",
        "LocationName",
        F.col("LocationName").alias("City"),
        "State",
        F.lit(COUNTRY).alias("Country"),
        "Region",
        F.lit(None).cast("decimal(10,7)").alias("Latitude"),
        F.lit(None).cast("decimal(10,7)").alias("Longitude"),
        F.lit(LOCATION_TYPE).alias("LocationType"),
    )


def build_dim_location(stg_location: DataFrame, city_lookup: DataFrame) -> DataFrame:
    keyed = with_surrogate_key(location_rows(stg_location, city_lookup), "LocationKey", ["LocationCode"])
    return keyed.withColumns({"CreatedDate": F.current_timestamp(), "ModifiedDate": F.current_timestamp()})


def location_history(stg_txn: DataFrame) -> DataFrame:
    """First and last day of each customer at each location, and the rows behind it.

    Spellings that differ only in case are one location. Groups in which no date can be
    read stay, with NULL dates; :func:`scd2_versions` leaves them out.
    """
    located = stg_txn.where(F.col("CustomerID").isNotNull()).select(
        "CustomerID",
        location_or_default(F.col("CustLocation")).alias("Location"),
        F.col("TransactionDay").alias("_date"),
    )
    # Dates and counts combine in a hash table on the map side; only the few groups that are
    # left, one for each spelling, meet the text minimum, which needs sorted rows.
    spelled = located.groupBy("CustomerID", "Location").agg(
        F.min("_date").alias("LocStartDate"), F.max("_date").alias("LocEndDate"), F.count("_date").alias("DatedRows")
    )
    return (
        spelled.groupBy("CustomerID", F.upper("Location").alias("LocationMatch"))
        .agg(
            F.min("Location").alias("Location"),
            F.min("LocStartDate").alias("LocStartDate"),
            F.max("LocEndDate").alias("LocEndDate"),
            F.sum("DatedRows").alias("DatedRows"),
        )
        .select("CustomerID", "Location", "LocationMatch", "LocStartDate", "LocEndDate", "DatedRows")
    )


def merged_history(one: DataFrame, other: DataFrame) -> DataFrame:
    """The location history of two sets of transactions from the histories of each."""
    return (
        one.unionByName(other)
        .groupBy("CustomerID", "LocationMatch")
        .agg(
            F.min("Location").alias("Location"),
            F.min("LocStartDate").alias("LocStartDate"),
            F.max("LocEndDate").alias("LocEndDate"),
            F.sum("DatedRows").alias("DatedRows"),
        )
        .select(*one.columns)
    )


def customer_demographics(stg_customer: DataFrame, dob_policy: str = "null_out_of_range") -> DataFrame:
    """Birth date and gender of each customer: the largest of what the rows say.

    Genders compare as numbers in the order of their names: a text maximum would sort all rows.
    """
    label = normalize_gender(F.col("Gender"))
    place = F.array_position(F.array(*map(F.lit, GENDERS)), label).cast("int")
    largest = (
        stg_customer.where(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(F.max(parse_dob(F.col("DOB"), dob_policy)).alias("DateOfBirth"), F.max(place).alias("_gender"))
    )
    return largest.select("CustomerID", "DateOfBirth", F.element_at(F.array(*map(F.lit, GENDERS)), F.col("_gender")).alias("Gender"))


def scd2_versions(history: DataFrame) -> DataFrame:
    """Customer versions: the location last seen is current and has no end date.

    The window of a customer holds one row per location, however many transactions
    stand behind it. Further columns of ``history`` pass through.
    """
    of_customer = Window.partitionBy("CustomerID")
    latest_first = of_customer.orderBy(F.desc("LocEndDate"), F.asc("Location"))
    return (
        history.where(F.col("LocStartDate").isNotNull())
        .withColumn("IsCurrent", F.row_number().over(latest_first) == 1)
        .withColumn("FirstTransactionDateEver", F.min("LocStartDate").over(of_customer))
        .withColumn("EndDate", F.when(~F.col("IsCurrent"), F.col("LocEndDate")))
        .withColumnRenamed("LocStartDate", "StartDate")
        .drop("LocEndDate")
    )


def customer_rows(
    history: DataFrame,
    stg_customer: DataFrame,
    dim_location: DataFrame,
    settings: Settings,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Customer versions with demographics and location key.

    ``counted`` has the locations of ``history`` for counting hot ones: the written table,
    where ``history`` is a plan over it.
    """
    people = customer_demographics(stg_customer, settings.dob_policy)
    places = dim_location.select("LocationKey", F.col("LocationCode").alias("_code"))
    versions = scd2_versions(history).withColumn("_code", location_code(F.col("Location")))
    described = versions.join(people, "CustomerID")
    # a city may be home to a large share of the customers
    per_place = (history if counted is None else counted).groupBy(location_code(F.col("Location")).alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    located = balanced_join(
        described, places, ["_code"], per_place, "_n", spread_by=["CustomerID", "LocationMatch"], how="left"
    )
    aged = located.withColumn("Age", age_years(F.col("DateOfBirth"), settings.as_of))
    return aged.select(
        *(["CustomerKey"] if "CustomerKey" in history.columns else []),
        "CustomerID",
        "DateOfBirth",
        "Age",
        age_group(F.col("Age"), settings.age_mode).alias("AgeGroup"),
        "Gender",
        "Location",
        "LocationKey",
        customer_type(F.col("StartDate"), settings.as_of, settings.customer_type_mode).alias("CustomerType"),
        F.col("StartDate").alias("FirstTransactionDate"),
        "StartDate",
        "EndDate",
        "IsCurrent",
        "FirstTransactionDateEver",
        "LocationMatch",
        "DatedRows",
    )


def build_dim_customer(
    history: DataFrame, stg_customer: DataFrame, dim_location: DataFrame, settings: Settings
) -> DataFrame:
    """Full reload of the customer dimension. Give a written ``history``: keys read it twice."""
    dated = history.where(F.col("LocStartDate").isNotNull())
    keyed = with_surrogate_key(dated, "CustomerKey", ["CustomerID", "LocationMatch"])
    rows = customer_rows(keyed, stg_customer, dim_location, settings, counted=dated)
    return rows.withColumns({"CreatedDate": F.current_timestamp(), "ModifiedDate": F.current_timestamp()})

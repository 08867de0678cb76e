"""Data-quality checks. Each returns the offending rows or a one-row summary."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import date_of_key
from ledgerloom.functions.cleanse import clean_nan, customer_id, parse_dmy


def skipped_histories(history: DataFrame) -> DataFrame:
    """Customer-location groups without any readable date."""
    return history.agg(F.count_if(F.col("LocStartDate").isNull()).alias("SkippedGroups"))


#: Columns that the tables declare as never NULL.
REQUIRED = {
    "Dim_Segment": ("SegmentKey", "SegmentCode", "SegmentName", "SegmentType", "DisplayOrder", "IsActive", "StartDate"),
    "Dim_Location": ("LocationKey", "LocationCode", "LocationName", "City", "State", "Country", "Region", "LocationType"),
    "Dim_Customer": ("CustomerKey", "CustomerID", "Gender", "AgeGroup", "Location", "CustomerType", "FirstTransactionDate", "StartDate", "IsCurrent"),
    "Fact_Transaction": ("TransactionKey", "CustomerKey", "DateKey", "TransactionID", "TransactionAmount", "AccountBalance", "TransactionCount"),
    "Fact_CustomerSnapshot": (
        "SnapshotKey", "CustomerKey", "DateKey", "SegmentKey", "TransactionCount", "TotalTransactionAmount",
        "AvgTransactionAmount", "MinTransactionAmount", "MaxTransactionAmount", "DaysSinceLastTransaction", "RecencyScore",
        "FrequencyScore", "LoyaltyScore", "SatisfactionScore", "ComplaintFlag", "ChurnFlag", "AtRiskFlag", "TrendCategory",
        "PreviousMonthTransactionCount", "FinalAccountBalance",
    ),
}


def required_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """``TableName, ColumnName, NullRows`` of every column that is declared as never NULL; one scan a table."""
    found = []
    for name, columns in REQUIRED.items():
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = F.array(*[F.struct(F.lit(c).alias("ColumnName"), F.col(c).alias("NullRows")) for c in columns])
        found.append(counts.select(F.lit(name).alias("TableName"), F.explode(rows).alias("r")).select("TableName", "r.*"))
    return reduce(DataFrame.unionByName, found)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"Null{c}") for c in columns])


def date_range(df: DataFrame, key: str = "DateKey") -> DataFrame:
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).select(
        date_of_key(F.col("lo")).alias("MinDate"), date_of_key(F.col("hi")).alias("MaxDate")
    )


def customers_without_one_current(dim_customer: DataFrame) -> DataFrame:
    counts = dim_customer.groupBy("CustomerID").agg(F.count_if("IsCurrent").alias("CurrentRows"))
    return counts.where(F.col("CurrentRows") != 1)


def duplicated_transactions(fact: DataFrame) -> DataFrame:
    """Transactions that reached more than one customer version."""
    counts = fact.groupBy("TransactionID").agg(F.count(F.lit(1)).alias("FactRows"))
    return counts.where(F.col("FactRows") > 1)


def orphans(child: DataFrame, parents: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """For each relation (name to key and parent) the rows of ``child`` with a key that its parent lacks.

    The child is scanned once: each row gives its keys by relation, they are counted, and
    only the counts meet the parents. NULL keys have no parent to lack.
    """
    named = F.explode(
        F.array(*[F.struct(F.lit(n).alias("Relation"), F.col(k).cast("long").alias("key")) for n, (k, _) in parents.items()])
    )
    keys = child.select(named.alias("r")).select("r.*").groupBy("Relation", "key").agg(F.count(F.lit(1)).alias("_rows"))
    known = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(n).alias("Relation"), F.col(k).cast("long").alias("key")) for n, (k, df) in parents.items()],
    ).withColumn("_known", F.lit(True))
    # a parent key that is not unique must not count a child twice
    lost = keys.join(known.dropDuplicates(["Relation", "key"]), ["Relation", "key"], "left")
    missing = F.col("_known").isNull() & F.col("key").isNotNull()
    return lost.groupBy("Relation").agg(F.sum(F.when(missing, F.col("_rows")).otherwise(0)).alias("OrphanRows"))


def foreign_key_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan rows of every relation of the star."""
    snapshot, fact = tables["Fact_CustomerSnapshot"], tables["Fact_Transaction"]
    customer, location = tables["Dim_Customer"], tables["Dim_Location"]
    day, segment = tables["Dim_Date"], tables["Dim_Segment"]
    relations = [
        (
            snapshot,
            {
                "snapshot-customer": ("CustomerKey", customer),
                "snapshot-date": ("DateKey", day),
                "snapshot-segment": ("SegmentKey", segment),
            },
        ),
        (
            fact,
            {
                "fact-customer": ("CustomerKey", customer),
                "fact-date": ("DateKey", day),
                "fact-location": ("LocationKey", location),
            },
        ),
        (customer, {"customer-location": ("LocationKey", location)}),
    ]
    found = reduce(DataFrame.unionByName, [orphans(child, parents) for child, parents in relations])
    names = [(name,) for _, parents in relations for name in parents]
    # an empty child has no rows to report on, and no orphans
    wanted = snapshot.sparkSession.createDataFrame(names, "Relation string")
    return wanted.join(found, "Relation", "left").select("Relation", F.coalesce("OrphanRows", F.lit(0)).alias("OrphanRows"))


def score_domains(snapshot: DataFrame) -> DataFrame:
    """Scores outside their ranges."""

    def outside(name: str, low: float, high: float):
        return F.count_if(~F.coalesce(F.col(name).between(low, high), F.lit(False))).alias(f"Bad{name}")

    return snapshot.agg(
        outside("RecencyScore", 1, 5), outside("FrequencyScore", 0, 5), outside("SatisfactionScore", 1, 5)
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Values of a key that should be unique but are not."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("KeyRows")).where(F.col("KeyRows") > 1)


def reconciliation(raw: DataFrame, stg_txn: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows on the way from raw to fact, each table counted once."""
    usable = F.col("CustomerID").isNotNull() & F.col("TransactionDate").isNotNull()

    def one(df: DataFrame, stage: str, count) -> DataFrame:
        return df.agg(count.alias("Records")).select(F.lit(stage).alias("Stage"), "Records")

    return (
        one(raw, "raw", F.count(F.lit(1)))
        .unionByName(one(stg_txn, "staging", F.count(F.lit(1))))
        .unionByName(one(stg_txn, "staging with id and date", F.count_if(usable)))
        .unionByName(one(fact, "fact", F.count(F.lit(1))))
    )


#: Why a raw row is no fact, in the order in which the load would drop it.
REASONS = ("no transaction id", "no customer", "no date", "unreadable date", "date outside the calendar")


def drop_reason(dim_date: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A step that adds ``Reason`` to raw rows: why the load leaves the row out, NULL where it loads it."""

    def with_reason(raw: DataFrame) -> DataFrame:
        text = clean_nan(F.col("TransactionDate"), trim_test=False)
        typed = raw.withColumns({"_customer": customer_id(F.col("CustomerID")), "_text": text, "_day": parse_dmy(text)})
        # one row per day: broadcast is bounded by the length of the calendar
        days = F.broadcast(dim_date.select(F.col("Date").alias("_day"), F.lit(True).alias("_known")))
        tests = (
            F.col("TransactionID").isNull(),
            F.col("_customer").isNull(),
            F.col("_text").isNull(),
            F.col("_day").isNull(),
            F.col("_known").isNull(),
        )
        reason = F.lit(None).cast("string")
        for test, name in reversed(list(zip(tests, REASONS, strict=True))):
            reason = F.when(test, name).otherwise(reason)
        return typed.join(days, "_day", "left").withColumn("Reason", reason).select(*raw.columns, "Reason")

    return with_reason


def reconciliation_by_reason(raw: DataFrame, fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Raw rows by what became of them: a reason for each that is no fact, the facts, and what is left over.

    The rows add up to the raw table. ``unexplained`` is what should have become a fact and
    is not one (less than none: facts that no raw row explains); it is 0 after a sound load
    in which a transaction meets one version. Raw and fact are scanned once each.
    """
    reasons = drop_reason(dim_date)(raw).groupBy(F.coalesce("Reason", F.lit("_loaded")).alias("Reason")).agg(
        F.count(F.lit(1)).alias("Records")
    )
    facts = fact.agg(F.count(F.lit(1))).scalar()
    wanted = F.explode(F.array(*[F.lit(r) for r in (*REASONS, "fact", "unexplained")])).alias("Reason")
    total = reasons.agg(F.map_from_entries(F.collect_list(F.struct("Reason", "Records"))).alias("_of"))  # seven entries
    one = total.select(wanted, "_of", facts.alias("_facts"))
    count = (
        F.when(F.col("Reason") == "fact", F.col("_facts"))
        .when(F.col("Reason") == "unexplained", F.coalesce(F.col("_of")["_loaded"], F.lit(0)) - F.col("_facts"))
        .otherwise(F.coalesce(F.try_element_at("_of", "Reason"), F.lit(0)))
    )
    return one.select("Reason", count.alias("Records"))

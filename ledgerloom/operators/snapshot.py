"""Monthly activity, the customer-month spine and the scored snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.functions import scoring
from ledgerloom.functions.calendar import date_of_key, key_of, month_calendar, month_end

SPINE_TAIL_MONTHS = 12
_MONEY = "decimal(18,2)"


def monthly_activity(fact: DataFrame, cutoff: date) -> DataFrame:
    """Transactions of each customer key in each month up to ``cutoff``.

    The fact holds only calendar dates, so the date comes from its key; comparing whole
    keys lets the scan skip later rows.
    """
    dated = fact.where(F.col("DateKey") <= key_of(cutoff)).select(
        "CustomerKey",
        date_of_key(F.col("DateKey")).alias("_date"),
        "TransactionAmount",
        "AccountBalance",
    )
    return (
        dated.groupBy("CustomerKey", F.last_day("_date").alias("MonthEndDate"))
        .agg(
            F.count(F.lit(1)).alias("TransactionCount"),
            F.sum("TransactionAmount").cast(_MONEY).alias("TotalTransactionAmount"),
            F.avg("TransactionAmount").cast(_MONEY).alias("AvgTransactionAmount"),
            F.min("TransactionAmount").alias("MinTransactionAmount"),
            F.max("TransactionAmount").alias("MaxTransactionAmount"),
            F.max("_date").alias("LastTxDateInMonth"),
            F.max("AccountBalance").alias("MonthEndBalance"),
        )
        .withColumns({"TxYear": F.year("MonthEndDate"), "TxMonth": F.month("MonthEndDate")})
    )


def activity_of_customer(activity: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Monthly activity of the whole customer, filed under the current version's key.

    Works on the monthly rows of the versions, not on transactions.
    """
    current = dim_customer.where("IsCurrent").select("CustomerID", F.col("CustomerKey").alias("_current"))
    owner = dim_customer.select("CustomerKey", "CustomerID").join(current, "CustomerID")
    filed = activity.join(owner.select("CustomerKey", "_current"), "CustomerKey")
    return (
        filed.groupBy(F.col("_current").alias("CustomerKey"), "MonthEndDate")
        .agg(
            F.sum("TransactionCount").alias("TransactionCount"),
            F.sum("TotalTransactionAmount").cast(_MONEY).alias("TotalTransactionAmount"),
            F.min("MinTransactionAmount").alias("MinTransactionAmount"),
            F.max("MaxTransactionAmount").alias("MaxTransactionAmount"),
            F.max("LastTxDateInMonth").alias("LastTxDateInMonth"),
            F.max("MonthEndBalance").alias("MonthEndBalance"),
            F.max("TxYear").alias("TxYear"),
            F.max("TxMonth").alias("TxMonth"),
        )
        .withColumn(
            "AvgTransactionAmount",
            (F.col("TotalTransactionAmount") / F.col("TransactionCount").cast("decimal(18,0)")).cast(_MONEY),
        )
        .select(*activity.columns)
    )


def customer_profile(dim_customer: DataFrame, activity: DataFrame, cutoff: date) -> DataFrame:
    """First and last transaction date of each current customer with activity."""
    last = activity.groupBy("CustomerKey").agg(F.max("LastTxDateInMonth").alias("LastEverTxDate"))
    current = dim_customer.where("IsCurrent").select("CustomerKey", "FirstTransactionDate")
    return current.join(last, "CustomerKey").withColumn(
        "DaysSinceLastTx", F.datediff(F.lit(cutoff), F.col("LastEverTxDate"))
    )


def _first_date(settings: Settings) -> Column:
    name = "FirstTransactionDate" if settings.grain == "version" else "FirstTransactionDateEver"
    return F.col(name).alias("_first")


def _months_with_activity(
    activity: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, settings: Settings
) -> DataFrame:
    """All spine months of the current customers beside their activity, if any.

    An activity row stands for its own month. The last one of a customer also stands for
    the silent months after it, up to twelve months later, so the spine grows out of the
    activity rows in place: no cross product with the calendar, no union, no distinct.
    ``InSpine`` marks the months that the spine keeps; the rest serve as previous months.
    """
    if settings.grain == "customer_id":
        activity = activity_of_customer(activity, dim_customer)
    current = dim_customer.where("IsCurrent").select("CustomerKey", "CustomerID", _first_date(settings))
    of_customer = Window.partitionBy("CustomerKey")
    known = activity.join(current, "CustomerKey").withColumn("_last", F.max("LastTxDateInMonth").over(of_customer))
    own = F.col("MonthEndDate")
    tail_end = F.least(F.add_months("_last", SPINE_TAIL_MONTHS), F.lit(settings.cutoff))
    tail = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(SPINE_TAIL_MONTHS)),
            lambda k: F.last_day(F.add_months(F.trunc("MonthEndDate", "month"), k)),
        ),
        lambda m: (m == own) | (m <= tail_end),
    )
    is_last = F.col("LastTxDateInMonth") == F.col("_last")
    spread = known.withColumn("_month", F.explode(F.when(is_last, tail).otherwise(F.array(own))))
    has_activity = F.col("_month") == own
    measured = [c for c in activity.columns if c not in ("CustomerKey", "MonthEndDate")]
    rows = spread.select(
        "CustomerKey",
        "CustomerID",
        F.col("_month").alias("MonthEndDate"),
        "_first",
        has_activity.alias("HasActivity"),
        *[F.when(has_activity, F.col(c)).alias(c) for c in measured],
    )
    # at most one row a month of the covered range
    months = F.broadcast(month_calendar(dim_date, settings.start, settings.cutoff))
    kept = F.coalesce(
        F.col("MonthEndDateKey").isNotNull()
        & (F.col("MonthEndDate") >= F.col("_first"))
        & (F.col("MonthEndDate") <= F.lit(settings.cutoff)),
        F.lit(False),
    )
    return rows.join(months, "MonthEndDate", "left").withColumn("InSpine", kept).drop("_first")


def customer_spine(
    activity: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, settings: Settings
) -> DataFrame:
    """Customer-months of the snapshot: months with activity, and the year after the last one."""
    months = _months_with_activity(activity, dim_customer, dim_date, settings)
    return months.where("InSpine").select("CustomerKey", "CustomerID", "MonthEndDate", "MonthEndDateKey")


def merge_spine(
    activity: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, settings: Settings
) -> DataFrame:
    """Spine months with their activity, the previous calendar month's count and running values.

    ``lag`` finds the previous row; it counts only if it is the calendar month before and
    had activity. Everything is partitioned by customer, so the windows need no exchange
    of their own.
    """
    months = _months_with_activity(activity, dim_customer, dim_date, settings)
    by_month = Window.partitionBy("CustomerKey").orderBy("MonthEndDate")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_spine = F.col("InSpine")
    spine_balance = F.when(in_spine, F.col("MonthEndBalance"))
    if settings.balance_carry == "running_max":
        carried = F.max(spine_balance).over(so_far)
    else:
        carried = F.last(spine_balance, ignorenulls=True).over(so_far)
    had_activity = F.lag("HasActivity").over(by_month) & (
        F.lag("MonthEndDate").over(by_month) == month_end(F.col("MonthEndDate"), -1)
    )
    previous = F.coalesce(F.when(had_activity, F.lag("TransactionCount").over(by_month)), F.lit(0))
    zero = F.lit(0).cast(_MONEY)
    return (
        months.withColumns(
            {
                "PreviousMonthTransactionCount": previous,
                "IsFirstMonth": ~F.coalesce(had_activity, F.lit(False)),
                "RunningLastTxDate": F.max(F.when(in_spine, F.col("LastTxDateInMonth"))).over(so_far),
                "FinalAccountBalance": F.coalesce("MonthEndBalance", carried),
            }
        )
        .where(in_spine)
        .select(
            "CustomerKey",
            "CustomerID",
            "MonthEndDate",
            "MonthEndDateKey",
            F.coalesce("TransactionCount", F.lit(0)).alias("TransactionCount"),
            F.coalesce("TotalTransactionAmount", zero).alias("TotalTransactionAmount"),
            F.coalesce("AvgTransactionAmount", zero).alias("AvgTransactionAmount"),
            F.coalesce("MinTransactionAmount", zero).alias("MinTransactionAmount"),
            F.coalesce("MaxTransactionAmount", zero).alias("MaxTransactionAmount"),
            "PreviousMonthTransactionCount",
            "IsFirstMonth",
            "RunningLastTxDate",
            "FinalAccountBalance",
        )
    )


def score_snapshot(merged: DataFrame, seed: int) -> DataFrame:
    """Recency and frequency scores, flags, growth, trend and the seeded scores."""
    days, recency, frequency = F.col("DaysSinceLastTransaction"), F.col("RecencyScore"), F.col("FrequencyScore")
    now, before = F.col("TransactionCount"), F.col("PreviousMonthTransactionCount")
    identity = (F.col("CustomerID"), F.col("MonthEndDateKey").cast("string"), F.lit(str(seed)))
    return (
        merged.withColumn("DaysSinceLastTransaction", F.datediff("MonthEndDate", "RunningLastTxDate"))
        .withColumns(
            {"RecencyScore": scoring.recency_score(days), "FrequencyScore": scoring.frequency_score(now)}
        )
        .withColumns(
            {
                "LoyaltyScore": scoring.loyalty_score(recency, frequency),
                "ChurnFlag": scoring.churn_flag(days),
                "AtRiskFlag": scoring.at_risk_flag(days),
                "GrowthRate": scoring.growth_rate(now, before),
                "TrendCategory": scoring.trend_category(days, now, before),
                "SatisfactionScore": scoring.satisfaction_score(
                    recency, frequency, scoring.seeded_number(1, *identity)
                ),
                "ComplaintFlag": scoring.complaint_flag(now, before, scoring.seeded_number(9, *identity)),
            }
        )
    )


def build_snapshot(
    activity: DataFrame,
    dim_customer: DataFrame,
    dim_date: DataFrame,
    rules: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Monthly activity to scored and segmented customer-months."""
    from ledgerloom.operators.rules import assign_segment_as_of
    from ledgerloom.operators.segments import assign_segment

    merged = merge_spine(activity, dim_customer, dim_date, settings)
    if settings.rule_validity == "as_of":
        months = month_calendar(dim_date, settings.start, settings.cutoff)
        return assign_segment_as_of(score_snapshot(merged, settings.seed), rules, months, settings.segment_mode)
    return assign_segment(score_snapshot(merged, settings.seed), rules, settings.segment_mode)

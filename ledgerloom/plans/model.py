"""The semantic model: the snapshot, its four dimensions and the months it holds."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.functions import scoring
from ledgerloom.functions.calendar import key_of, with_month_label
from ledgerloom.operators.segments import bounded_rules
from ledgerloom.plans.warehouse import Warehouse

# Report attributes and the table each comes from.
DATE_ATTRIBUTES = (
    "Year",
    "YearName",
    "Quarter",
    "QuarterName",
    "YearQuarter",
    "Month",
    "MonthName",
    "YearMonth",
    "MonthLabel",
    "MonthSort",
    "FiscalYear",
    "FiscalQuarter",
    "Date",
)
SEGMENT_ATTRIBUTES = ("SegmentName", "SegmentCode", "DisplayOrder", "Color")
CUSTOMER_ATTRIBUTES = ("CustomerID", "Gender", "Age", "AgeGroup", "CustomerType", "Location")
LOCATION_ATTRIBUTES = ("LocationCode", "LocationName", "City", "State", "Country", "Region")


def snapshot_attributes() -> dict[str, Column]:
    """Attributes that the snapshot rows themselves hold or imply."""
    return {
        "RecencyBucket": scoring.recency_bucket(F.col("DaysSinceLastTransaction")),
        "LoyaltyBand": scoring.loyalty_band(F.col("LoyaltyScore")),
        "GrowthCategory": scoring.growth_category(F.col("ChurnFlag"), F.col("GrowthRate")),
        "TrendCategory": F.col("TrendCategory"),
        "RecencyScore": F.col("RecencyScore"),
        "FrequencyScore": F.col("FrequencyScore"),
        "ChurnFlag": F.col("ChurnFlag"),
        "AtRiskFlag": F.col("AtRiskFlag"),
        "ComplaintFlag": F.col("ComplaintFlag"),
        "TotalTransactionAmount": F.col("TotalTransactionAmount"),
        "FinalAccountBalance": F.col("FinalAccountBalance"),
    }


@dataclass(frozen=True)
class Anchors:
    """Month keys the measures refer to; None where the snapshot has no such month."""

    last: int | None
    previous: int | None
    quarter: int | None
    year: int | None


@dataclass
class Model:
    snapshot: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_location: DataFrame
    dim_segment: DataFrame
    settings: Settings = field(default_factory=Settings)

    @property
    def spark(self) -> SparkSession:
        return self.snapshot.sparkSession

    @cached_property
    def months(self) -> list[dict]:
        """Date attributes of the months in the snapshot, in order: one row a month.

        Read once per model. The month keys are the partition values of the snapshot.
        """
        keys = self.snapshot.select("DateKey").distinct()
        dates = self.dim_date.select("DateKey", *DATE_ATTRIBUTES)
        return [row.asDict() for row in keys.join(dates, "DateKey").orderBy("DateKey").collect()]

    @cached_property
    def segment_keys(self) -> dict[str, int]:
        return {row.SegmentCode: row.SegmentKey for row in bounded_rules(self.dim_segment)}

    def anchors(self, within: list[int] | None = None) -> Anchors:
        """The last month, the one before it in the data, and the ends of the month three
        and twelve months earlier. ``within`` limits which month can be the last."""
        keys = [m["DateKey"] for m in self.months]
        eligible = [k for k in keys if within is None or k in within]
        if not eligible:
            return Anchors(None, None, None, None)
        last = max(eligible)
        earlier = [k for k in keys if k < last]
        return Anchors(last, max(earlier, default=None), _months_before(last, 3), _months_before(last, 12))


def _months_before(key: int, months: int) -> int:
    """Key of the last day of the month ``months`` before the month of ``key``."""
    first_after = key // 10000 * 12 + key // 100 % 100 - months  # counts months, January is 1
    following = date(first_after // 12, first_after % 12 + 1, 1)
    return key_of(date.fromordinal(following.toordinal() - 1))


def model_of(warehouse: Warehouse) -> Model:
    return Model(
        snapshot=warehouse.table("Fact_CustomerSnapshot"),
        dim_date=with_month_label(warehouse.table("Dim_Date")),
        dim_customer=warehouse.table("Dim_Customer"),
        dim_location=warehouse.table("Dim_Location"),
        dim_segment=warehouse.table("Dim_Segment"),
        settings=warehouse.settings,
    )


def load_model(
    spark: SparkSession, directory: str, settings: Settings | None = None, current_only: bool = False
) -> Model:
    """The model over a warehouse that is already written.

    ``current_only`` imports current customer versions and active segments only.
    """
    model = model_of(Warehouse(spark, directory, settings or Settings()))
    if current_only:
        model.dim_customer = model.dim_customer.where("IsCurrent")
        model.dim_segment = model.dim_segment.where("IsActive")
    return model


def snapshot_wide(model: Model) -> DataFrame:
    """Snapshot rows beside all attributes of their dimensions, for ad-hoc reports.

    The measures do not go through this: they join only what a question names.
    """
    customer = model.dim_customer.select("CustomerKey", *CUSTOMER_ATTRIBUTES, "LocationKey")
    location = model.dim_location.select("LocationKey", *LOCATION_ATTRIBUTES)
    segment = model.dim_segment.select("SegmentKey", *SEGMENT_ATTRIBUTES)
    dates = model.dim_date.select("DateKey", *DATE_ATTRIBUTES)
    computed = {n: c for n, c in snapshot_attributes().items() if n not in model.snapshot.columns}
    return (
        model.snapshot.withColumns(computed)
        .join(dates, "DateKey", "left")
        .join(segment, "SegmentKey", "left")
        .join(customer, "CustomerKey", "left")
        .join(location, "LocationKey", "left")
    )


# Report names that are not just the column name with blanks, and the
# columns reports do not show.
REPORT_NAMES = {
    "TotalTransactionAmount": "Total Transaction Amt",
    "AvgTransactionAmount": "Avg Transaction Amt",
    "MinTransactionAmount": "Min Transaction Amt",
    "MaxTransactionAmount": "Max Transaction Amt",
    "Month": "Month Number",
    "MonthNameShort": "Month Short",
    "DayNameShort": "Day Short",
}
UNCHANGED_NAMES = (
    "MonthLabel",
    "MonthSort",
    "DisplayOrder",
    "RecencyBucket",
    "LoyaltyBand",
    "GrowthCategory",
    "FullDateTime",
    "SnapshotKey",
)
HIDDEN_COLUMNS = (
    "CustomerKey",
    "DateKey",
    "SegmentKey",
    "LocationKey",
    "RecencyScore",
    "FrequencyScore",
    "LoyaltyScore",
    "IsCurrentMonth",
    "IsCurrentQuarter",
    "IsCurrentYear",
    "Latitude",
    "Longitude",
    "RecencyMin",
    "RecencyMax",
    "FrequencyMin",
    "FrequencyMax",
    "StartDate",
    "EndDate",
    "IsCurrent",
    "CreatedDate",
    "ModifiedDate",
    "ETLLoadDate",
    "ETLBatchID",
)


def report_name(column: str) -> str:
    if column in UNCHANGED_NAMES:
        return column
    return REPORT_NAMES.get(column, re.sub(r"(?<=[a-z])(?=[A-Z])", " ", column))


def report_view(df: DataFrame) -> DataFrame:
    """Rename columns as reports show them, and leave out technical ones."""
    shown = df.drop(*HIDDEN_COLUMNS)
    return shown.withColumnsRenamed({name: report_name(name) for name in shown.columns})

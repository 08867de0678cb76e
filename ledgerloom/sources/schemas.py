"""Declared schemas. Nothing in the warehouse is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw layout and the segment rules.
RAW_COLUMNS = (
    "TransactionID",
    "CustomerID",
    "CustomerDOB",
    "CustGender",
    "CustLocation",
    "CustAccountBalance",
    "TransactionDate",
    "TransactionTime",
    "TransactionAmount",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("SegmentKey", T.IntegerType(), False),
        T.StructField("SegmentCode", T.StringType(), False),
        T.StructField("SegmentName", T.StringType(), False),
        T.StructField("SegmentType", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("RecencyMin", T.IntegerType()),
        T.StructField("RecencyMax", T.IntegerType()),
        T.StructField("FrequencyMin", T.IntegerType()),
        T.StructField("FrequencyMax", T.IntegerType()),
        T.StructField("DisplayOrder", T.IntegerType()),
        T.StructField("Color", T.StringType()),
        T.StructField("IsActive", T.BooleanType()),
        T.StructField("StartDate", T.DateType()),
        T.StructField("EndDate", T.DateType()),
    ]
)
SEGMENT_ROWS = [
    (1, "RF_Champions", "Champions", "RF", "Recent and very frequent", 0, 59, 15, 9999, 1, "#28A745", True, None, None),
    (2, "RF_Loyal", "Loyal Customers", "RF", "Recent and frequent", 0, 59, 8, 14, 2, "#17A2B8", True, None, None),
    (3, "RF_Potential", "Potential Loyalists", "RF", "Recent, fairly frequent", 0, 59, 5, 7, 3, "#6C757D", True, None, None),
    (4, "RF_New", "New Customers", "RF", "Recent, few transactions", 0, 30, 0, 4, 4, "#007BFF", True, None, None),
    (5, "RF_AtRisk", "At Risk", "RF", "Silent for two to three months", 60, 90, 5, 9999, 5, "#FFC107", True, None, None),
    (6, "RF_Hibernating", "Hibernating", "RF", "Silent, few transactions", 31, 90, 0, 4, 6, "#FF6B6B", True, None, None),
    (7, "RF_Churned", "Churned", "RF", "Silent for over 90 days", 91, 9999, 0, 9999, 7, "#DC3545", True, None, None),
]
UNCLASSIFIED_SEGMENT = -1

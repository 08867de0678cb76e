"""Writes, load stamps and small reports about what was written."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import UNCLASSIFIED_SEGMENT


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Replace a table and return it as read back, with a short lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_dim(df: DataFrame, name: str, directory: str) -> DataFrame:
    return write_stage(df, os.path.join(directory, name))


def _laid_out(df: DataFrame, partition_by: str, cluster_by: str | None, slices: int) -> DataFrame:
    """Rows grouped for a partitioned write.

    The rebalance hint brings the rows of a partition value together and lets adaptive
    execution cut large groups into several files and join small ones, so neither a hot
    month nor a thin one shapes the layout. ``cluster_by`` also keeps the rows of one of
    its values in the same one of ``slices`` groups, and so in few files: a later
    aggregation by it then combines most rows before its shuffle.
    """
    if cluster_by is None:
        return df.hint("rebalance", F.col(partition_by))
    slice_of = F.pmod(F.xxhash64(cluster_by), F.lit(slices)).cast("int")
    grouped = df.withColumn("_slice", slice_of).hint("rebalance", F.col(partition_by), F.col("_slice"))
    return grouped.drop("_slice")


def keyed_layout(
    df: DataFrame, key: str, partition_by: str, cluster_by: str | None = None, slices: int = 1, after: int = -1
) -> DataFrame:
    """Rows laid out for the write, and then numbered from ``after`` + 1 on, with gaps.

    The number is given in the task that writes the row, after the last exchange, in the
    manner of an identity column. A task that is run again thus numbers and writes its own
    rows anew, and no row that another task has read already changes its number.
    """
    laid_out = _laid_out(df, partition_by, cluster_by, slices)
    number = F.monotonically_increasing_id() + F.lit(after + 1)
    return laid_out.select(number.alias(key), *laid_out.columns)


def write_fact(
    df: DataFrame,
    name: str,
    directory: str,
    key: str,
    partition_by: str,
    cluster_by: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """Replace a partitioned fact; ``key`` is its new number."""
    path = os.path.join(directory, name)
    rows = keyed_layout(df, key, partition_by, cluster_by, slices)
    rows.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_fact(
    df: DataFrame,
    name: str,
    directory: str,
    key: str,
    partition_by: str,
    cluster_by: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """Add rows to a partitioned fact, numbered above the present ones."""
    path = os.path.join(directory, name)
    present = df.sparkSession.read.parquet(path)
    last = present.agg(F.coalesce(F.max(key), F.lit(-1))).first()[0]
    rows = keyed_layout(df, key, partition_by, cluster_by, slices, after=last)
    rows.select(*present.columns).write.mode("append").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def load_stamped(df: DataFrame, batch_id: int | None = None) -> DataFrame:
    return df.withColumns(
        {"ETLLoadDate": F.current_timestamp(), "ETLBatchID": F.lit(batch_id).cast("int")}
    )


def snapshot_rows(staged: DataFrame, batch_id: int = 1) -> DataFrame:
    """Scored rows in the layout of the snapshot fact; unmatched segment -1, no balance 0."""
    zero = F.lit(0).cast("decimal(18,2)")
    return load_stamped(
        staged.select(
            "CustomerKey",
            F.col("MonthEndDateKey").alias("DateKey"),
            F.coalesce("SegmentKey", F.lit(UNCLASSIFIED_SEGMENT)).alias("SegmentKey"),
            "TransactionCount",
            "TotalTransactionAmount",
            "AvgTransactionAmount",
            "MinTransactionAmount",
            "MaxTransactionAmount",
            "DaysSinceLastTransaction",
            "RecencyScore",
            "FrequencyScore",
            "LoyaltyScore",
            "SatisfactionScore",
            "ComplaintFlag",
            "ChurnFlag",
            "AtRiskFlag",
            "TrendCategory",
            "PreviousMonthTransactionCount",
            "GrowthRate",
            F.coalesce("FinalAccountBalance", zero).alias("FinalAccountBalance"),
        ),
        batch_id,
    )


def write_snapshot(staged: DataFrame, directory: str, batch_id: int = 1, slices: int = 1) -> DataFrame:
    """Truncate and reload the snapshot, one directory per month."""
    rows = snapshot_rows(staged, batch_id)
    return write_fact(rows, "Fact_CustomerSnapshot", directory, "SnapshotKey", "DateKey", "CustomerKey", slices)


def observed(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows while they pass: read ``observation.get`` after the action on the frame."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_metrics(spark: SparkSession, stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named stage, one row per stage."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in stages.items()
    ]
    report = counts[0]
    for row in counts[1:]:
        report = report.unionByName(row)
    return report


def describe_schema(df: DataFrame, table: str) -> DataFrame:
    """Column listing of a table, with its column count."""
    rows = [
        (table, i + 1, f.name, f.dataType.simpleString(), f.nullable, len(df.schema.fields))
        for i, f in enumerate(df.schema.fields)
    ]
    layout = "TableName string, Ordinal int, ColumnName string, DataType string, IsNullable boolean, ColumnCount int"
    return df.sparkSession.createDataFrame(rows, layout)

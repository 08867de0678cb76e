"""Scans of the raw layer and of the warehouse tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.schemas import RAW_COLUMNS, SEGMENT_ROWS, SEGMENT_SCHEMA
from ledgerloom.sources.workspace import cut_lineage

# What stands in for numbers that cannot be read from the seed file.
SEED_AMOUNT, SEED_BALANCE = 500.0, 10000.0


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed transactions from CSV: header blanks stripped, the two numbers read leniently.

    Columns keep the file's own order and are read as text; nothing is inferred.
    """
    text = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
    text = text.toDF(*[name.strip() for name in text.columns])
    return text.withColumns(
        {
            "TransactionAmount": _number_or("TransactionAmount", SEED_AMOUNT),
            "CustAccountBalance": _number_or("CustAccountBalance", SEED_BALANCE),
        }
    )


#: A comma that no open quote encloses.
_SEPARATOR = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_csv_with_rejects(
    spark: SparkSession, path: str, columns: tuple[str, ...] = RAW_COLUMNS, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Records of CSV files that have the right number of fields, and those that have not.

    The first frame has ``columns`` as text. The second is what a quarantine keeps: ``Rule``
    (too few or too many fields, or an open quote), ``Fields`` and the whole ``RawText``. Every record of the
    files is in one of them. Empty lines are no records. The files are parsed once, into the
    shared folder: a reader that prunes columns would not see wrong field counts.
    """
    raw = "_raw_text"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, raw)])
    read = spark.read.schema(schema).csv(path, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=raw)
    parsed = cut_lineage(read, f"csv-{uuid.uuid4().hex}")
    fields = F.size(F.split(raw, _SEPARATOR, -1))
    rule = F.when(fields < len(columns), "too few fields").when(fields > len(columns), "too many fields").otherwise("unreadable record")
    kept = parsed.where(F.col(raw).isNull()).select(*columns)
    rejected = parsed.where(F.col(raw).isNotNull())
    return kept, rejected.select(rule.alias("Rule"), fields.alias("Fields"), F.col(raw).alias("RawText"))


def quarantined(
    spark: SparkSession, path: str, accepted: str, quarantine: str, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Read CSV files once, write sound records and rejected ones apart, and return both as written.

    Rejected records are added to those of earlier files, with the file and the time of the load.
    """
    kept, rejected = read_csv_with_rejects(spark, path, header=header)
    kept.write.mode("overwrite").parquet(accepted)
    stamped = rejected.withColumns({"SourcePath": F.lit(path), "LoadDate": F.current_timestamp()})
    stamped.write.mode("append").parquet(quarantine)
    return spark.read.parquet(accepted), spark.read.parquet(quarantine)


def _number_or(name: str, default: float):
    return F.coalesce(finite_number(name), F.lit(default))


def finite_number(name: str):
    """A text column as a number; NULL for what is none, for NaN and for infinite values."""
    number = F.trim(name).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)


def read_raw(spark: SparkSession, source: str | dict) -> DataFrame:
    """The nine raw text columns from a Parquet path, or from JDBC options given as a dict.

    For a large JDBC table give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that executors read it in parallel.
    """
    if isinstance(source, dict):
        table = spark.read.format("jdbc").options(**source).load()
    else:
        table = spark.read.parquet(source)
    return table.select([F.col(name).cast("string").alias(name) for name in RAW_COLUMNS])


def spread(df: DataFrame, pieces: int | None) -> DataFrame:
    """Deal the rows of a source out to ``pieces`` tasks; None leaves it as it is.

    Files with one row group each are read by one task, however many cores wait. Ask for it
    where a source is known to come in few such files.
    """
    return df if pieces is None else df.repartition(pieces)


#: Rows of a partition of an exchange before adaptive execution joins small ones.
EXCHANGE_ROWS = 500_000
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def widen_exchanges(spark: SparkSession, rows: int) -> int:
    """Let exchanges begin with a partition for each ``EXCHANGE_ROWS`` of ``rows``; returns their number.

    With a fixed number, partitions grow with the input until sorts no longer fit in memory
    and spill. Adaptive execution joins small partitions again. A larger number that the
    session has already stays.
    """
    wide = max(exchange_width(spark), -(-rows // EXCHANGE_ROWS))
    if wide > exchange_width(spark):
        spark.conf.set(_FIRST_PARTITIONS, str(wide))
    return wide


#: Tasks of a large stage for each core of the cluster, at least.
TASKS_A_CORE = 4
_FEWEST = ("spark.sql.adaptive.coalescePartitions.minPartitionNum", "spark.sql.files.minPartitionNum")


def even_tasks(spark: SparkSession) -> int:
    """Let exchanges and scans be cut into some tasks for each core; returns their number.

    By default both are cut into about as many tasks as there are cores, and then one more than
    that keeps the others waiting for as long again. Small inputs stay in few tasks, as parts
    of an exchange have 1 MB at least and those of a scan 4 MB. A number that the session has
    already stays.
    """
    tasks = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    for setting in _FEWEST:
        if spark.conf.get(setting, None) is None:
            spark.conf.set(setting, str(tasks))
    return tasks


def exchange_width(spark: SparkSession) -> int:
    """Partitions that exchanges of the session begin with."""
    return int(spark.conf.get(_FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def segment_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEGMENT_ROWS, SEGMENT_SCHEMA)


def sample_rows(df: DataFrame, n: int, order_by: list | None = None) -> DataFrame:
    """The first ``n`` rows, in an order if one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

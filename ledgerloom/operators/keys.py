"""Surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 1024


def with_kept_keys(rows: DataFrame, before: DataFrame, key: str, business_key: list[str]) -> DataFrame:
    """Rows that were there before keep their key; new ones get the numbers after the last.

    ``rows`` is read three times: give a written table. Business keys are unique and not NULL.
    """
    last = before.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    known = rows.join(before.select(*business_key, key), business_key)
    fresh = with_surrogate_key(rows.join(before, business_key, "left_anti"), key, business_key)
    columns = [key, *rows.columns]
    shifted = fresh.withColumn(key, F.col(key) + F.lit(last))
    return known.select(*columns).unionByName(shifted.select(*columns))


def with_surrogate_key(df: DataFrame, key: str, business_key: list[str]) -> DataFrame:
    """Number the rows 1..n by their business key, which must be unique.

    Rows are spread over a fixed number of hash buckets and numbered within each; the
    running total of the bucket sizes (at most ``KEY_BUCKETS`` rows) gives each bucket its
    first number. The result depends on the values alone, so a recomputed task gives the
    same keys, and no task ever sees more than one bucket. ``df`` is read twice: pass a
    written table rather than a long plan.
    """
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*business_key), F.lit(KEY_BUCKETS)).cast("int"))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(*business_key)
    numbered = bucketed.withColumn("_number", F.row_number().over(within))
    keyed = numbered.join(F.broadcast(offsets), "_bucket")
    return keyed.select((F.col("_offset") + F.col("_number")).alias(key), *df.columns)

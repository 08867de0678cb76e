"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1.0 / 1000


def hot_keys(counts: DataFrame, keys: list[str], rows: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys holding at least ``share`` of all rows, with the number of slices to cut each into.

    ``counts`` has one row per key (or finer) and its row count; give a written table. At
    most ``1 / share`` keys can pass the test, whatever the data, so they are read to the
    driver and come back as a local table that is safe to broadcast.
    """
    per_key = counts.groupBy(*keys).agg(F.sum(rows).alias("_rows"))
    total = counts.agg(F.sum(rows)).first()[0] or 0
    enough = max(total * share, 1.0)
    hot = per_key.where(F.col("_rows") >= F.lit(enough)).select(
        *keys, F.ceil(F.col("_rows") / F.lit(enough)).cast("int").alias("_slices")
    )
    return counts.sparkSession.createDataFrame(hot.collect(), hot.schema)


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    hot: DataFrame,
    spread_by: list[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys``, cutting hot keys of ``big`` into slices.

    The rows of ``small`` for a hot key are repeated once per slice (``hot`` bounds the
    repeats); all other keys have one slice. Without hot keys an inner join stays plain. The slice of a row of ``big`` is a hash of
    ``spread_by``, so a recomputed task sends it to the same place. Rows of ``big`` with
    a NULL key cannot match and are spread by the same hash. ``condition`` is an extra
    test on the joined rows, for inner joins.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join does inner and left joins")
    if condition is not None and how != "inner":
        raise ValueError("an extra condition needs an inner join")
    if how == "inner" and hot.isEmpty():
        joined = big.join(small, keys, how)
        return joined if condition is None else joined.where(condition)
    hot = F.broadcast(hot)
    missing_key = F.lit(False)
    for key in keys:
        missing_key = missing_key | F.col(key).isNull()
    spread = F.xxhash64(*spread_by)
    slices = F.when(missing_key, F.lit(int(1 / HOT_SHARE))).otherwise(F.coalesce("_slices", F.lit(1)))
    left = big.join(hot, keys, "left").withColumn("_slice", F.pmod(spread, slices).cast("int")).drop("_slices")
    right = (
        small.join(hot, keys, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )
    joined = left.join(right, [*keys, "_slice"], how)
    if condition is not None:
        joined = joined.where(condition)
    return joined.drop("_slice")


def balanced_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    counts: DataFrame,
    rows: str,
    spread_by: list[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """A join with hot keys cut, whatever way Spark will take for it.

    The plan does not depend on sizes or thresholds at the time it is made: slices change
    nothing where Spark comes to broadcast ``small``. ``counts`` and ``rows`` are as in
    :func:`hot_keys`; give a written table.
    """
    return skew_join(big, small, keys, hot_keys(counts, keys, rows), spread_by, how, condition)

"""Where two tables differ, and why raw rows did not become facts, row by row."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def _row_hash(columns: list[str]) -> Column:
    # a NULL leaves the hash as it is: say where they are, so that they do not trade places
    return F.xxhash64(*columns, F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns]))


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``Bucket, Records, HashSum, HashXor`` of the rows by hash of their key, whatever their order.

    At most ``buckets`` rows: kept beside a table, they tell later whether and where it changed.
    """
    columns = sorted(df.columns)
    hashed = df.select(_bucket(keys, buckets).alias("Bucket"), _row_hash(columns).alias("_h"))
    return hashed.groupBy("Bucket").agg(
        F.count(F.lit(1)).alias("Records"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("HashSum"),
        F.bit_xor("_h").alias("HashXor"),
    )


def differing_buckets(left: DataFrame, right: DataFrame) -> list[int]:
    """Buckets whose digests are not equal, from two results of :func:`bucket_digests`."""
    both = left.alias("l").join(right.alias("r"), "Bucket", "full_outer")
    same = F.lit(True)
    for c in ("Records", "HashSum", "HashXor"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return sorted(r[0] for r in both.where(~same).select("Bucket").collect())


def table_difference(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ: ``keys, LeftRows, RightRows, Change`` (added, removed or changed).

    The tables have the same columns; both are digested by bucket in one scan each, and only
    rows of buckets that differ are compared by key. Equal tables end after the digests. A
    key may have several rows, which are compared as a whole; a repeated row counts.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("the tables have other columns")
    columns = sorted(left.columns)
    found = differing_buckets(bucket_digests(left, keys, buckets), bucket_digests(right, keys, buckets))
    in_found = _bucket(keys, buckets).isin(*found) if found else F.lit(False)

    def of_key(df: DataFrame, side: str) -> DataFrame:
        rows = df.where(in_found).select(*keys, _row_hash(columns).alias("_h"))
        return rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{side}Rows"), F.sum(F.col("_h").cast("decimal(38,0)")).alias(f"_{side}")
        )

    one, other = of_key(left, "Left").alias("l"), of_key(right, "Right").alias("r")
    same_key = reduce(and_, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    change = (
        F.when(F.col("LeftRows").isNull(), "added")
        .when(F.col("RightRows").isNull(), "removed")
        .when(~F.col("_Left").eqNullSafe(F.col("_Right")), "changed")
    )
    rows = one.join(other, same_key, "full_outer").select(
        *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
        F.coalesce("LeftRows", F.lit(0)).alias("LeftRows"),
        F.coalesce("RightRows", F.lit(0)).alias("RightRows"),
        change.alias("Change"),
    )
    return rows.where(F.col("Change").isNotNull())

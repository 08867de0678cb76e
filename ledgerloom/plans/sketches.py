"""Distinct customers over any span of months, from stored sketches without the customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.model import Model

#: A theta sketch keeps 2 ** 12 hashes: 32 kB, and 1.6 % of relative error at one standard deviation.
LOG_NOMINAL = 12


def relative_bound(log_nominal: int = LOG_NOMINAL, deviations: float = 3.0) -> float:
    """The relative error that an estimate of a union keeps within, at so many standard deviations."""
    return deviations / float(2**log_nominal - 1) ** 0.5


def customer_sketches(model: Model, by: list[str] | None = None, log_nominal: int = LOG_NOMINAL) -> DataFrame:
    """One sketch of customers a month and set of attributes: ``DateKey, by..., Customers, Sketch``.

    Write it: later questions read months times attribute sets of rows, each of bounded size.
    Customers are partly sketched where they lie, so no customer is moved.
    """
    by = list(by or [])
    sketch = F.theta_sketch_agg("CustomerKey", F.lit(log_nominal)).alias("Sketch")
    rows = model.snapshot.select("DateKey", "CustomerKey", *[c for c in by if c in model.snapshot.columns])
    missing = [c for c in by if c not in rows.columns]
    if missing:
        places = model.dim_location.select("LocationKey", *[c for c in missing if c in model.dim_location.columns])
        people = model.dim_customer.join(places, "LocationKey", "left").select("CustomerKey", *missing)
        rows = rows.join(people, "CustomerKey", "left")
    return rows.groupBy("DateKey", *by).agg(F.count(F.lit(1)).alias("Customers"), sketch)


def distinct_over(sketches: DataFrame, first: int | None = None, last: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Estimated distinct customers of all months from ``first`` to ``last`` together, by attribute."""
    rows = sketches
    if first is not None:
        rows = rows.where(F.col("DateKey") >= first)
    if last is not None:
        rows = rows.where(F.col("DateKey") <= last)
    union = F.theta_sketch_estimate(F.theta_union_agg("Sketch")).alias("DistinctCustomers")
    return rows.groupBy(*(by or [])).agg(union)


def month_overlap(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Estimated customers that a month shares with the next one of the table: ``DateKey, NextKey, by..., SharedCustomers``.

    One join of sketches; neither month's customers are read.
    """
    by = list(by or [])
    months = sketches.select("DateKey").distinct()
    other = months.withColumnRenamed("DateKey", "NextKey")
    # a row a month on both sides
    following = months.join(F.broadcast(other), F.col("NextKey") > F.col("DateKey")).groupBy("DateKey").agg(F.min("NextKey").alias("NextKey"))
    now = sketches.select("DateKey", *by, F.col("Sketch").alias("_now")).join(F.broadcast(following), "DateKey")
    then = sketches.select(F.col("DateKey").alias("NextKey"), *by, F.col("Sketch").alias("_then"))
    both = now.join(then, ["NextKey", *by])
    shared = F.theta_sketch_estimate(F.theta_intersection("_now", "_then"))
    return both.select("DateKey", "NextKey", *by, shared.alias("SharedCustomers"))

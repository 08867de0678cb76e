"""Customers by level of their balance or of what they spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.quantile import equi_depth_levels
from ledgerloom.operators.reports import distribution
from ledgerloom.plans.model import Model

#: Upper borders of the named balance levels; the last has none.
BALANCE_LEVELS = (("Low", 50_000), ("Medium", 250_000), ("High", None))


def named_level(value: Column, levels: tuple = BALANCE_LEVELS) -> Column:
    name = F.lit(levels[-1][0])
    for label, border in reversed(levels[:-1]):
        name = F.when(value < border, label).otherwise(name)
    return name


def _last_month(model: Model) -> DataFrame:
    return model.snapshot.where(F.col("DateKey") == F.lit(model.anchors().last))


def customers_by_balance_level(model: Model) -> DataFrame:
    """Customers of the last month by named level of their balance, with percent."""
    return distribution(_last_month(model).select(named_level(F.col("FinalAccountBalance")).alias("BalanceLevel")), "BalanceLevel", count="Customers")


def _depth_levels(model: Model, column: str, levels: int) -> DataFrame:
    now = _last_month(model).select(F.col(column))
    return (
        equi_depth_levels(now, column, levels)
        .groupBy("Level")
        .agg(
            F.min(column).alias("LowestValue"),
            F.max(column).alias("HighestValue"),
            F.count(F.lit(1)).alias("Customers"),
            F.sum(column).cast("decimal(28,2)").alias("Total"),
        )
    )


def balance_levels(model: Model, levels: int = 10) -> DataFrame:
    """Customers of the last month in ``levels`` levels of equal depth by balance.

    Equal balances share a level. Columns: ``Level, LowestValue, HighestValue, Customers, Total``.
    """
    return _depth_levels(model, "FinalAccountBalance", levels)


def amount_levels(model: Model, levels: int = 10) -> DataFrame:
    """:func:`balance_levels` by what customers spent in the last month; the silent share the lowest level."""
    return _depth_levels(model, "TotalTransactionAmount", levels)

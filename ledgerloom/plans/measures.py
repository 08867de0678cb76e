"""Report measures.

Every measure is arithmetic over a few additive sums of snapshot rows at a few months.
One call therefore does one aggregation, however many measures it is asked for: the
snapshot is cut to the months that are needed (partition pruning), summed by month and by
the keys behind the wanted attributes, joined to the small dimensions as sums, and only
then divided.

A snapshot has one row per customer and month, so the distinct customers of a month are
its rows; the quality report checks that grain.

Empty results follow report rules: no rows is NULL, not zero; a NULL beside a number in a
difference counts as zero; groups in which all asked measures are NULL are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import scoring
from ledgerloom.plans.model import (
    CUSTOMER_ATTRIBUTES,
    DATE_ATTRIBUTES,
    LOCATION_ATTRIBUTES,
    SEGMENT_ATTRIBUTES,
    Model,
    snapshot_attributes,
)

LAST, PREVIOUS, QUARTER, YEAR, CONTEXT, ALL_SEGMENTS = "A", "P", "Q", "Y", "C", "S"
_IGNORE_DATE_FILTERS = (QUARTER, YEAR)

Where = dict[str, object]


@dataclass(frozen=True)
class Between:
    """A filter value: from ``low`` to ``high``, both included, None for an open end."""

    low: object = None
    high: object = None


#: A test inside a measure takes the place of a filter or group on the columns it tests.
REPLACED: dict[str, frozenset[str]] = {
    "active": frozenset({"ChurnFlag", "AtRiskFlag"}),
    "new": frozenset({"TrendCategory"}),
    "churned": frozenset({"ChurnFlag"}),
    "at_risk": frozenset({"AtRiskFlag"}),
    "complaints": frozenset({"ComplaintFlag"}),
    "growing": frozenset({"GrowthCategory"}),
    "declining": frozenset({"GrowthCategory"}),
    **dict.fromkeys(
        ("champions", "loyal", "potential", "hibernating", "churned_segment"), frozenset({"SegmentCode"})
    ),
}


# ---------------------------------------------------------------- additive sums


def _sums(model: Model) -> dict[str, Column]:
    def rows(test: Column) -> Column:
        return F.count_if(F.coalesce(test, F.lit(False)))

    def money(name: str) -> Column:
        return F.sum(name).cast("decimal(28,2)")

    def segment(code: str) -> Column:
        return rows(F.col("SegmentKey") == model.segment_keys.get(code))

    growth = scoring.growth_category(F.col("ChurnFlag"), F.col("GrowthRate"))
    satisfaction = F.col("SatisfactionScore")
    return {
        "rows": F.count(F.lit(1)),
        "active": rows(~F.col("ChurnFlag") & ~F.col("AtRiskFlag")),
        "new": rows(F.col("TrendCategory") == "New"),
        "churned": rows(F.col("ChurnFlag")),
        "at_risk": rows(F.col("AtRiskFlag")),
        "complaints": rows(F.col("ComplaintFlag")),
        "growing": rows(growth == "Growing"),
        "declining": rows(growth == "Declining"),
        "promoters": rows(satisfaction >= 4),
        "detractors": rows(satisfaction <= 2),
        "loyalty": money("LoyaltyScore"),
        "satisfaction": money("SatisfactionScore"),
        "days": F.sum("DaysSinceLastTransaction"),
        "days_known": F.count("DaysSinceLastTransaction"),
        "amount": money("TotalTransactionAmount"),
        "average_amount": money("AvgTransactionAmount"),
        "transactions": F.sum("TransactionCount"),
        "growth": money("GrowthRate"),
        "growth_known": F.count("GrowthRate"),
        "champions": segment("RF_Champions"),
        "loyal": segment("RF_Loyal"),
        "potential": segment("RF_Potential"),
        "hibernating": segment("RF_Hibernating"),
        "churned_segment": segment("RF_Churned"),
    }


# ---------------------------------------------------------------- measures over sums

At = Callable[..., Column]


def _count(x: Column) -> Column:
    return F.nullif(x, F.lit(0))


def _ratio(x: Column, y: Column) -> Column:
    return F.try_divide(x.cast("double"), y.cast("double"))


def _less(x: Column, y: Column) -> Column:
    zero = F.lit(0)
    return F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x, zero) - F.coalesce(y, zero))


def _growth(at: At, point: str) -> Column:
    now, before = _count(at("rows")), _count(at("rows", point))
    return _ratio(_less(now, before), before)


def _row_rate(at: At, point: str) -> Column:
    return _ratio(_count(at("churned", point)), at("rows", point))


def _loyalty(at: At, point: str) -> Column:
    return _ratio(at("loyalty", point), at("rows", point))


MEASURES: dict[str, Callable[[At], Column]] = {
    "total_customers": lambda at: _count(at("rows")),
    "active_customers": lambda at: _count(at("active")),
    "active_customer_rate": lambda at: _ratio(_count(at("active")), at("rows")),
    "new_customers": lambda at: _count(at("new")),
    "customer_growth_mom": lambda at: _growth(at, PREVIOUS),
    "customer_growth_qoq": lambda at: _growth(at, QUARTER),
    "customer_growth_yoy": lambda at: _growth(at, YEAR),
    "churned_customers": lambda at: _count(at("churned")),
    "churn_rate": lambda at: _ratio(_count(at("churned")), at("rows")),
    "retention_rate": lambda at: F.lit(1.0) - F.coalesce(_ratio(_count(at("churned")), at("rows")), F.lit(0.0)),
    "at_risk_customers": lambda at: _count(at("at_risk")),
    "at_risk_rate": lambda at: _ratio(_count(at("at_risk")), at("rows")),
    "churn_rate_mom_change": lambda at: _less(_row_rate(at, LAST), _row_rate(at, PREVIOUS)),
    "churn_rate_trend": lambda at: _row_rate(at, CONTEXT),
    "churn_rate_qoq_change": lambda at: _less(_row_rate(at, LAST), _row_rate(at, QUARTER)),
    "churn_rate_yoy_change": lambda at: _less(_row_rate(at, LAST), _row_rate(at, YEAR)),
    "avg_loyalty_score": lambda at: _loyalty(at, LAST),
    "avg_satisfaction_score": lambda at: _ratio(at("satisfaction"), at("rows")),
    "avg_recency_days": lambda at: _ratio(at("days"), at("days_known")),
    "loyalty_score_trend": lambda at: _loyalty(at, CONTEXT),
    "loyalty_mom_change": lambda at: _less(_loyalty(at, LAST), _loyalty(at, PREVIOUS)),
    "loyalty_qoq_change": lambda at: _less(_loyalty(at, LAST), _loyalty(at, QUARTER)),
    "loyalty_yoy_change": lambda at: _less(_loyalty(at, LAST), _loyalty(at, YEAR)),
    "total_transaction_amount": lambda at: at("amount", CONTEXT),
    "total_transaction_amount_latest": lambda at: at("amount"),
    "avg_transaction_amount": lambda at: _ratio(at("average_amount"), at("rows")),
    "total_transactions": lambda at: at("transactions"),
    "avg_transactions_per_customer": lambda at: _ratio(at("transactions"), at("rows")),
    "transaction_volume_trend": lambda at: at("transactions", CONTEXT),
    "customers_with_complaints": lambda at: _count(at("complaints")),
    "complaint_rate": lambda at: _ratio(_count(at("complaints")), at("rows")),
    "avg_growth_rate": lambda at: _ratio(at("growth"), at("growth_known")) / F.lit(100.0),
    "growing_customers": lambda at: _count(at("growing")),
    "declining_customers": lambda at: _count(at("declining")),
    "customer_count_by_segment": lambda at: _count(at("rows")),
    "segment_share": lambda at: _ratio(_count(at("rows")), at("rows", ALL_SEGMENTS)),
    "champions_count": lambda at: _count(at("champions")),
    "churned_segment_count": lambda at: _count(at("churned_segment")),
    "promoters": lambda at: _count(at("promoters")),
    "detractors": lambda at: _count(at("detractors")),
    "nps_score": lambda at: _ratio(_less(_count(at("promoters")), _count(at("detractors"))), at("rows")),
    "nps_trend": lambda at: _ratio(
        _less(_count(at("promoters", CONTEXT)), _count(at("detractors", CONTEXT))), at("rows", CONTEXT)
    ),
    # from the report layer
    "potential_loyalists": lambda at: _count(at("potential")),
    "hibernating_customers": lambda at: _count(at("hibernating")),
    "hibernating_rate": lambda at: _ratio(_count(at("hibernating")), at("rows")),
    "total_complaints": lambda at: _count(at("complaints")),
    "complaints_per_1k": lambda at: _ratio(_count(at("complaints")) * 1000, at("rows")),
}


class _Terms:
    """Hands out the column of a sum at a month, and notes that it was asked for."""

    def __init__(self) -> None:
        self.asked: set[tuple[str, str]] = set()

    def __call__(self, name: str, point: str = LAST) -> Column:
        self.asked.add((name, point))
        return F.col(f"{name}_{point}")


# ---------------------------------------------------------------- one aggregation


@dataclass
class _Filter:
    """A ``where`` split by what it touches."""

    months: list[int]
    segment: Where
    other: Where


def _test(value: object, column: Column) -> Column:
    if isinstance(value, Between):
        ends = [] if value.low is None else [column >= F.lit(value.low)]
        ends += [] if value.high is None else [column <= F.lit(value.high)]
        return reduce(and_, ends, column.isNotNull())
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    return column.isin(*values)


def _fits(value: object, found: object) -> bool:
    """The same test for the few months that the driver knows."""
    if isinstance(value, Between):
        return found is not None and (value.low is None or found >= value.low) and (value.high is None or found <= value.high)
    return found in (value if isinstance(value, (list, tuple, set)) else [value])


def _split(model: Model, where: Where | None) -> _Filter:
    where = where or {}
    dates = {k: v for k, v in where.items() if k in DATE_ATTRIBUTES}
    segment = {k: v for k, v in where.items() if k in SEGMENT_ATTRIBUTES}
    other = {k: v for k, v in where.items() if k not in dates and k not in segment}

    def fits(month: dict) -> bool:
        return all(_fits(value, month[name]) for name, value in dates.items())

    return _Filter([m["DateKey"] for m in model.months if fits(m)], segment, other)


def _check_attributes(names: set[str]) -> None:
    known = {*snapshot_attributes(), *DATE_ATTRIBUTES, *SEGMENT_ATTRIBUTES}
    unknown = names - known - set(CUSTOMER_ATTRIBUTES) - set(LOCATION_ATTRIBUTES)
    if unknown:
        raise ValueError(f"unknown attributes: {sorted(unknown)}")


def monthly_sums(
    model: Model, sums: list[str], attributes: set[str], months: list[int], where: Where | None = None
) -> DataFrame:
    """The additive sums per month and attribute values, for the given months.

    Only dimensions that ``attributes`` or ``where`` name are joined. The customer
    dimension is joined to the rows, as its attributes differ by customer; segment,
    location and date are joined after the rows are summed by their keys. Filters on the
    rows themselves and on customers are applied before the sums and make no groups.
    """
    where = where or {}
    wanted = attributes | set(where)
    _check_attributes(wanted)
    rows = model.snapshot.where(F.col("DateKey").isin(*months) if months else F.lit(False))
    own = snapshot_attributes()
    for name in [n for n in where if n in own]:
        rows = rows.where(_test(where[name], own[name]))
    keys = {"DateKey": F.col("DateKey")}
    keys.update({name: own[name] for name in attributes if name in own})
    if wanted & set(SEGMENT_ATTRIBUTES):
        keys["SegmentKey"] = F.col("SegmentKey")
    of_customer = wanted & set(CUSTOMER_ATTRIBUTES)
    of_location = wanted & set(LOCATION_ATTRIBUTES)
    if of_customer or of_location:
        picked = sorted(of_customer) + (["LocationKey"] if of_location else [])
        rows = rows.join(model.dim_customer.select("CustomerKey", *picked), "CustomerKey", "left")
        for name in [n for n in where if n in CUSTOMER_ATTRIBUTES]:
            rows = rows.where(_test(where[name], F.col(name)))
        keys.update({name: F.col(name) for name in picked if name not in CUSTOMER_ATTRIBUTES or name in attributes})
    available = _sums(model)
    summed = rows.groupBy(*[column.alias(name) for name, column in keys.items()]).agg(
        *[available[name].alias(name) for name in sums]
    )
    if of_location:
        places = model.dim_location.select("LocationKey", *sorted(of_location))
        summed = summed.join(places, "LocationKey", "left").drop("LocationKey")
    if wanted & set(SEGMENT_ATTRIBUTES):
        names = model.dim_segment.select("SegmentKey", *sorted(wanted & set(SEGMENT_ATTRIBUTES)))
        summed = summed.join(names, "SegmentKey", "left").drop("SegmentKey")
    of_date = wanted & set(DATE_ATTRIBUTES)
    if of_date:
        summed = summed.join(model.dim_date.select("DateKey", *sorted(of_date)), "DateKey", "left")
    for name in [n for n in where if n not in own and n not in CUSTOMER_ATTRIBUTES]:
        summed = summed.where(_test(where[name], F.col(name)))
    return summed


def _held(where: Where, sums: list[str]) -> Where:
    """Filters that some of the asked sums replace: they go into the other sums one by one."""
    replaced = frozenset().union(*(REPLACED.get(name, frozenset()) for name in sums))
    return {name: value for name, value in where.items() if name in replaced}


def _passes(where: Where, name: str) -> Column:
    """The filters of ``where`` that hold for the sum ``name``."""
    tests = [
        F.coalesce(_test(value, F.col(column)), F.lit(False))
        for column, value in where.items()
        if column not in REPLACED.get(name, frozenset())
    ]
    return reduce(and_, tests, F.lit(True))


def _over_replaced_groups(wide: DataFrame, by: list[str], columns: dict[str, str]) -> DataFrame:
    """Sums (column to sum name) whose groups differ in replaced columns only become one.

    The window sees one row per group of the report.
    """
    for column, name in columns.items():
        rest = [b for b in by if b not in REPLACED.get(name, frozenset())]
        if len(rest) < len(by):
            wide = wide.withColumn(column, F.sum(column).over(Window.partitionBy(*rest)))
    return wide


def measures(
    model: Model,
    names: list[str] | str,
    by: list[str] | None = None,
    where: Where | None = None,
    anchor: str = "last",
) -> DataFrame:
    """Measures by name, grouped by report attributes, under report filters.

    ``anchor="last"``: "now" is the last month of the whole snapshot, and a date filter
    that leaves this month out leaves the measures of that month empty. ``"selected"``:
    "now" is the last month inside the date filter. Terms a quarter or a year back look
    past date filters in both cases. A filter is a value, a list of values, or
    :class:`Between`. Where a measure tests a column itself, its test takes the place of
    filters and groups on that column: churned customers by churn flag are the same number
    in both groups.
    """
    names = [names] if isinstance(names, str) else list(names)
    by = list(by or [])
    chosen = _split(model, where)
    anchors = model.anchors(chosen.months if anchor == "selected" else None)
    if anchor not in ("last", "selected"):
        raise ValueError(f"unknown anchor {anchor!r}")

    terms = _Terms()
    columns = {name: MEASURES[name](terms) for name in names}
    points = {
        LAST: [anchors.last],
        PREVIOUS: [anchors.previous],
        QUARTER: [anchors.quarter],
        YEAR: [anchors.year],
        CONTEXT: [m["DateKey"] for m in model.months],
        ALL_SEGMENTS: [anchors.last],
    }
    used = {point for _, point in terms.asked}
    if used & set(_IGNORE_DATE_FILTERS) and set(by) & set(DATE_ATTRIBUTES):
        raise ValueError("a measure that looks a quarter or a year back cannot be grouped by date; use trend()")
    in_points = {
        point: [
            key
            for key in points[point]
            if key is not None and (point in _IGNORE_DATE_FILTERS or key in chosen.months)
        ]
        for point in used
    }
    months = sorted({key for keys in in_points.values() for key in keys})

    sums = sorted({name for name, _ in terms.asked})
    held = _held(chosen.other, sums)
    attributes = set(by) | set(chosen.segment) | set(held)
    base = monthly_sums(model, sums, attributes, months, {k: v for k, v in chosen.other.items() if k not in held})

    def at_point(name: str, point: str) -> Column:
        test = F.col("DateKey").isin(*in_points[point]) if in_points[point] else F.lit(False)
        test = test & _passes(held if point == ALL_SEGMENTS else {**held, **chosen.segment}, name)
        return F.sum(F.when(test, F.col(name))).alias(f"{name}_{point}")

    wide = base.groupBy(*by).agg(*[at_point(name, point) for name, point in sorted(terms.asked)])
    wide = _over_replaced_groups(wide, by, {f"{n}_{p}": n for n, p in terms.asked})
    if any(point == ALL_SEGMENTS for _, point in terms.asked):
        rest = [name for name in by if name not in SEGMENT_ATTRIBUTES]
        over_segments = Window.partitionBy(*rest)  # a few rows per group: one per segment
        for name in sorted({n for n, point in terms.asked if point == ALL_SEGMENTS}):
            column = f"{name}_{ALL_SEGMENTS}"
            wide = wide.withColumn(column, F.sum(column).over(over_segments))
    result = wide.select(*by, *[column.alias(name) for name, column in columns.items()])
    if not by:
        return result
    # retention is 1 for a group without rows, so it cannot tell whether there are any
    telling = [F.col(name) for name in names if name != "retention_rate"]
    if not telling:
        has_rows = wide.where(F.col("rows_A") > 0)
        return has_rows.select(*by, *[column.alias(name) for name, column in columns.items()])
    return result.where(reduce(or_, [column.isNotNull() for column in telling]))


def trend(model: Model, names: list[str] | str, by: list[str] | None = None, where: Where | None = None) -> DataFrame:
    """Measures month by month: each month of the filter is its own "now".

    Takes measures of one month only; month-over-month ones compare two.
    """
    names = [names] if isinstance(names, str) else list(names)
    by = list(by or [])
    chosen = _split(model, where)
    terms = _Terms()
    columns = {name: MEASURES[name](terms) for name in names}
    if {point for _, point in terms.asked} - {LAST, CONTEXT}:
        raise ValueError("trend() takes measures of a single month")
    sums = sorted({name for name, _ in terms.asked})
    attributes = set(by) | {"YearMonth"}
    where = {**chosen.segment, **chosen.other}
    held = _held(where, sums)
    base = monthly_sums(
        model, sums, attributes | set(held), chosen.months, {k: v for k, v in where.items() if k not in held}
    )
    groups = ["DateKey", "YearMonth", *by]
    per_month = base.groupBy(*groups).agg(
        *[F.sum(F.when(_passes(held, name), F.col(name))).alias(f"{name}_{point}") for name, point in sorted(terms.asked)]
    )
    per_month = _over_replaced_groups(per_month, groups, {f"{n}_{p}": n for n, p in terms.asked})
    return per_month.select("DateKey", "YearMonth", *by, *[c.alias(n) for n, c in columns.items()])


def last_months(model: Model) -> DataFrame:
    """The month keys that anchor the measures, one row."""
    a = model.anchors()
    labels = {m["DateKey"]: m["YearMonth"] for m in model.months}
    row = (a.last, labels.get(a.last), a.previous)  # the model knows its months already
    return model.spark.createDataFrame([row], "LastDataDateKey int, LastDataMonth string, PrevDataDateKey int")


def anchor(model: Model, where: Where | None = None) -> int | None:
    """The last month key inside the filter's dates."""
    return model.anchors(_split(model, where).months).last


def hierarchy_rollup(model: Model) -> DataFrame:
    """Subtotals along Year > QuarterName > MonthName > MonthLabel > Date.

    The snapshot is summed by month first; the rollup multiplies those few rows only.
    """
    levels = ["Year", "QuarterName", "MonthName", "MonthLabel", "Date"]
    sums = ["rows", "churned", "transactions", "amount"]
    base = monthly_sums(model, sums, set(levels), [m["DateKey"] for m in model.months])
    return base.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("GroupingLevel"),
        F.sum("rows").alias("CustomerMonths"),
        F.sum("churned").alias("ChurnedMonths"),
        F.sum("transactions").alias("Transactions"),
        F.sum("amount").cast("decimal(28,2)").alias("Amount"),
    )

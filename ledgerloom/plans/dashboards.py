"""Result sets behind the dashboards: one frame per visual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.reports import top_n_other
from ledgerloom.plans.measures import Where, measures, trend
from ledgerloom.plans.model import DATE_ATTRIBUTES, SEGMENT_ATTRIBUTES, Model
from ledgerloom.plans.transitions import loyalty_funnel, transitions

# Business targets of the headline figures, and whether more is better.
KPI_TARGETS = {
    "total_customers": (900000.0, True),
    "active_customers": (720000.0, True),
    "avg_loyalty_score": (4.0, True),
    "churn_rate": (0.10, False),
    "avg_transaction_amount": (5100.0, True),
    "nps_score": (0.40, True),
}
ACTIVE_SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists"]


def unpivoted(row: DataFrame, names: list[str]) -> DataFrame:
    """One row per measure from a one-row frame of measures."""
    return row.unpivot([], [F.col(n).cast("double").alias(n) for n in names], "Measure", "Value")


def kpi_status(values: DataFrame, targets: dict[str, tuple[float, bool]] = KPI_TARGETS) -> DataFrame:
    """Target and status beside each value. The handful of targets becomes an expression."""

    def pick(position: int) -> Column:
        chosen = F.lit(None)
        for name, target in targets.items():
            chosen = F.when(F.col("Measure") == name, F.lit(target[position])).otherwise(chosen)
        return chosen

    target, more_is_better = pick(0).cast("double"), pick(1).cast("boolean")
    met = F.when(more_is_better, F.col("Value") >= target).otherwise(F.col("Value") <= target)
    status = F.when(met, "On target").when(~met, "Off target")
    return values.select("Measure", "Value", target.alias("Target"), status.alias("Status"))


def _known(df: DataFrame, measure: str) -> DataFrame:
    return df.select("State", measure).where(F.col(measure).isNotNull())


def _largest_states(df: DataFrame, measure: str, states: int = 3) -> DataFrame:
    return top_n_other(_known(df, measure), "State", measure, states)


def _with_active_segments(where: Where) -> Where:
    """The slicers, with their choice of segments cut to the active ones."""
    chosen = where.get("SegmentName", ACTIVE_SEGMENTS)
    chosen = chosen if isinstance(chosen, (list, tuple, set)) else [chosen]
    return {**where, "SegmentName": [s for s in ACTIVE_SEGMENTS if s in chosen]}


def _between_segments(where: Where) -> Where:
    """The slicers but those of segments, as moves go from one segment to another."""
    return {k: v for k, v in where.items() if k not in SEGMENT_ATTRIBUTES}


_HEADLINE = list(KPI_TARGETS)
_SHARED_TRENDS = [
    "total_customers",
    "active_customers",
    "churn_rate_trend",
    "loyalty_score_trend",
    "transaction_volume_trend",
    "nps_trend",
]
_SEGMENT_BREAKDOWN = [
    "customer_count_by_segment",
    "growing_customers",
    "declining_customers",
    "customers_with_complaints",
    "total_transaction_amount",
]

EXECUTIVE = {
    "kpis": lambda m, w: kpi_status(unpivoted(measures(m, _HEADLINE, where=w), _HEADLINE)),
    "sparklines": lambda m, w: trend(m, _HEADLINE, where=w),
    "monthly_trends": lambda m, w: trend(m, _SHARED_TRENDS, where=w),
    "segment_breakdown": lambda m, w: measures(m, _SEGMENT_BREAKDOWN, by=["SegmentName", "DisplayOrder"], where=w),
    "segment_trend": lambda m, w: trend(m, "total_customers", by=["SegmentName"], where=w),
}

_LIFECYCLE = ["new_customers", "potential_loyalists", "hibernating_customers", "hibernating_rate"]
_MOVES = ["NewCustomerRetentionRate", "LoyalConversionRate"]

MARKETING = {
    "kpis": lambda m, w: unpivoted(measures(m, _LIFECYCLE, where=w), _LIFECYCLE).unionByName(
        unpivoted(transitions(m, where=_between_segments(w)), _MOVES)
    ),
    "new_by_state": lambda m, w: _largest_states(measures(m, "new_customers", by=["State"], where=w), "new_customers"),
    "conversion_trend": lambda m, w: transitions(m, per_month=True, where=_between_segments(w)).select(
        "DateKey", "PotentialLoyalists", "LoyalConversions", "LoyalConversionRate"
    ),
    "hibernating_trend": lambda m, w: trend(m, ["hibernating_customers", "hibernating_rate"], where=w),
    "conversions_by_state": lambda m, w: _largest_states(
        transitions(m, by=["State"], where=_between_segments(w)).where("LoyalConversions > 0"), "LoyalConversions"
    ),
    "funnel": lambda m, w: loyalty_funnel(m, _between_segments(w)),
    "hibernating_by_state": lambda m, w: _known(
        measures(m, "hibernating_customers", by=["State"], where=w), "hibernating_customers"
    ),
}

_RETENTION = [
    "total_customers",
    "churn_rate",
    "nps_score",
    "hibernating_customers",
    "total_complaints",
    "complaints_per_1k",
]

CRM = {
    "kpis": lambda m, w: unpivoted(measures(m, _RETENTION, where=w), _RETENTION),
    "satisfaction_churn_trend": lambda m, w: trend(m, ["nps_score", "churn_rate_trend"], where=w),
    "complaints_trend": lambda m, w: trend(m, "total_complaints", where=w),
    "complaints_by_segment": lambda m, w: measures(m, "total_complaints", by=["SegmentName"], where=w),
    "risk_trend": lambda m, w: trend(m, ["at_risk_customers", "churned_customers"], where=w),
    "churned_by_state": lambda m, w: measures(m, "churned_customers", by=["State"], where=w),
    "active_segments_trend": lambda m, w: trend(
        m, "total_customers", by=["SegmentName"], where=_with_active_segments(w)
    ),
}

_SEGMENT_DETAIL = ["churn_rate", "avg_loyalty_score", "nps_score", "avg_growth_rate", "total_customers"]

ANALYST = {"segments": lambda m, w: measures(m, _SEGMENT_DETAIL, by=["SegmentName"], where=w)}

#: Visuals that run over the months; all others show the last month.
TRENDS = {
    "executive": {"sparklines", "monthly_trends", "segment_trend"},
    "marketing": {"conversion_trend", "hibernating_trend"},
    "crm": {"satisfaction_churn_trend", "complaints_trend", "risk_trend", "active_segments_trend"},
    "analyst": set(),
}

PAGES = {"executive": EXECUTIVE, "marketing": MARKETING, "crm": CRM, "analyst": ANALYST}


def visual(model: Model, page: str, name: str, where: Where | None = None) -> DataFrame:
    """One result set under the page's slicers.

    ``where`` may hold dates and any other report attribute. Cards and breakdowns of the
    last month look past date slicers, as the figures of the page are those of that month;
    trends are cut to the chosen months.
    """
    slicers = dict(where or {})
    if name not in TRENDS[page]:
        slicers = {k: v for k, v in slicers.items() if k not in DATE_ATTRIBUTES}
    return PAGES[page][name](model, slicers)


def dashboard(model: Model, page: str, where: Where | None = None) -> dict[str, DataFrame]:
    """All result sets of a page."""
    return {name: visual(model, page, name, where) for name in PAGES[page]}

"""Rule-driven segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.schemas import UNCLASSIFIED_SEGMENT

AT_RISK, NEW = "RF_AtRisk", "RF_New"
#: Rules become an expression, so their number is bounded; more raise an error.
MOST_RULES = 200


def bounded_rules(rules: DataFrame) -> list:
    """The rules in key order, on the driver."""
    found = rules.orderBy("SegmentKey").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} segment rules")
    return found


def _band(rule, days: Column, count: Column) -> Column:
    return days.between(rule.RecencyMin, rule.RecencyMax) & count.between(rule.FrequencyMin, rule.FrequencyMax)


def _first_rule(tests: list[tuple[Column, int]]) -> Column:
    key = F.lit(None).cast("int")
    for test, number in reversed(tests):
        key = F.when(test, number).otherwise(key)
    return key


def assign_segment(scored: DataFrame, rules: DataFrame, mode: str = "as_coded") -> DataFrame:
    """Add SegmentKey, and SegmentStep for the rule step that set it.

    The rules are a handful of rows of a rule table: they are read once and become a CASE
    expression, so the rows are neither joined nor moved. Where several rules fit, the
    lowest key wins; no fit gives -1.

    as_coded: (1) At Risk by days and the *previous* month's count, (2) New for a first
    month, (3) the bands of all rules but At Risk. range: the bands of all rules.
    """
    active = bounded_rules(rules.where("IsActive"))
    days, count = F.col("DaysSinceLastTransaction"), F.col("TransactionCount")
    no_match = F.lit(UNCLASSIFIED_SEGMENT)
    if mode == "range":
        by_band = _first_rule([(_band(r, days, count), r.SegmentKey) for r in active])
        return scored.withColumns(
            {"SegmentKey": F.coalesce(by_band, no_match), "SegmentStep": F.when(by_band.isNotNull(), "Range")}
        )
    if mode != "as_coded":
        raise ValueError(f"unknown mode {mode!r}")
    at_risk = _first_rule(
        [
            (
                days.between(r.RecencyMin, r.RecencyMax)
                & (F.col("PreviousMonthTransactionCount") >= r.FrequencyMin),
                r.SegmentKey,
            )
            for r in active
            if r.SegmentCode == AT_RISK
        ]
    )
    new = _first_rule([(F.col("IsFirstMonth"), r.SegmentKey) for r in active if r.SegmentCode == NEW])
    rest = _first_rule([(_band(r, days, count), r.SegmentKey) for r in active if r.SegmentCode != AT_RISK])
    step = (
        F.when(at_risk.isNotNull(), "AtRisk").when(new.isNotNull(), "New").when(rest.isNotNull(), "Range")
    )
    return scored.withColumns({"SegmentKey": F.coalesce(at_risk, new, rest, no_match), "SegmentStep": step})


def segment_step_counts(segmented: DataFrame) -> DataFrame:
    """Rows that each rule step assigned."""
    return segmented.groupBy(F.coalesce("SegmentStep", F.lit("None")).alias("SegmentStep")).agg(
        F.count(F.lit(1)).alias("Records")
    )


def segment_rule_coverage(points: DataFrame, rules: DataFrame) -> DataFrame:
    """Points (days, count) that do not fit exactly one rule; none for a sound rule table.

    Points are reduced to distinct pairs first; the test itself needs no join.
    """
    active = bounded_rules(rules.where("IsActive"))
    days, count = F.col("DaysSinceLastTransaction"), F.col("TransactionCount")
    fits = F.lit(0)
    for rule in active:
        fits = fits + F.coalesce(_band(rule, days, count).cast("int"), F.lit(0))
    distinct = points.select("DaysSinceLastTransaction", "TransactionCount").distinct()
    return distinct.withColumn("MatchingRules", fits).where(F.col("MatchingRules") != 1)

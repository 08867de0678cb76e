"""Recency / frequency scores and the business columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score bands, flag limits and the ranges of the seeded scores.
RECENCY_BANDS = ((30, 5), (60, 4), (90, 3), (180, 2))
FREQUENCY_BANDS = ((15, 5), (10, 4), (5, 3), (2, 2), (1, 1))
RECENCY_WEIGHT, FREQUENCY_WEIGHT = "0.3", "0.7"
CHURN_AFTER_DAYS = 90
AT_RISK_DAYS = (60, 90)
GROWTH_MAX, GROWTH_MIN = "999.99", "-99.99"
COMPLAINT_GROWTH_BELOW = -30
COMPLAINT_PERCENT = 70


def _first_match(tests: list[tuple[Column, int]], otherwise: int) -> Column:
    score = F.lit(otherwise)
    for test, points in reversed(tests):
        score = F.when(test, points).otherwise(score)
    return score


def recency_score(days: Column) -> Column:
    return _first_match([(days <= limit, points) for limit, points in RECENCY_BANDS], otherwise=1)


def frequency_score(count: Column) -> Column:
    return _first_match([(count >= least, points) for least, points in FREQUENCY_BANDS], otherwise=0)


def loyalty_score(recency: Column, frequency: Column) -> Column:
    weighted = recency.cast("decimal(3,0)") * F.lit(RECENCY_WEIGHT).cast("decimal(2,1)") + frequency.cast(
        "decimal(3,0)"
    ) * F.lit(FREQUENCY_WEIGHT).cast("decimal(2,1)")
    return weighted.cast("decimal(5,2)")


def churn_flag(days: Column) -> Column:
    return F.coalesce(days > CHURN_AFTER_DAYS, F.lit(False))


def at_risk_flag(days: Column) -> Column:
    return F.coalesce(days.between(*AT_RISK_DAYS), F.lit(False))


def growth_beyond(now: Column, before: Column, percent: int, above: bool) -> Column:
    """Exact test of the growth percentage against a whole number, without dividing."""
    change, limit = (now - before) * 100, before * percent
    return change > limit if above else change < limit


def growth_rate(now: Column, before: Column) -> Column:
    """Growth in percent, half-up to two digits, held within its column; NULL from zero."""
    change = now - before
    # hundredths of a percent in whole numbers, so that no rounding step comes before this one
    hundredths = F.call_function("div", F.abs(change) * 20000 + before, F.nullif(before * 2, F.lit(0)))
    signed = F.when(change < 0, -hundredths).otherwise(hundredths)
    rate = signed.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    held = F.greatest(F.least(rate, F.lit(GROWTH_MAX).cast("decimal(5,2)")), F.lit(GROWTH_MIN).cast("decimal(5,2)"))
    return F.when(before > 0, held.cast("decimal(5,2)"))


def trend_category(days: Column, now: Column, before: Column) -> Column:
    return (
        F.when(days > CHURN_AFTER_DAYS, "Churned")
        .when(before == 0, "New")
        .when(growth_beyond(now, before, 20, above=True), "Strong Growth")
        .when(growth_beyond(now, before, 5, above=True), "Moderate Growth")
        .when(~growth_beyond(now, before, -5, above=False), "Stable")
        .when(~growth_beyond(now, before, -20, above=False), "Moderate Decline")
        .otherwise("Sharp Decline")
    )


def seeded_number(start: int, *parts: Column | str) -> Column:
    """A repeatable 32-bit number per row: eight hex digits of the MD5 of ``parts``."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def satisfaction_score(recency: Column, frequency: Column, number: Column) -> Column:
    hundredths = (
        F.when((recency >= 4) & (frequency >= 4), 400 + number % 101)
        .when((recency <= 2) & (frequency <= 2), 100 + number % 151)
        .otherwise(250 + number % 151)
    )
    return (hundredths.cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(3,2)")


def complaint_flag(now: Column, before: Column, number: Column) -> Column:
    fell = growth_beyond(now, before, COMPLAINT_GROWTH_BELOW, above=False)
    return (before > 0) & fell & (number % 100 < COMPLAINT_PERCENT)


def recency_bucket(days: Column) -> Column:
    known = F.coalesce(days, F.lit(0))
    return (
        F.when(known <= 30, "0-30 days")
        .when(known <= 60, "31-60 days")
        .when(known <= 90, "61-90 days")
        .when(known <= 180, "91-180 days")
        .otherwise("180+ days")
    )


def loyalty_band(score: Column) -> Column:
    return F.when(score >= 4, "High (4-5)").when(score >= 2.5, "Medium (2.5-4)").otherwise("Low (<2.5)")


def growth_category(churned: Column, growth: Column) -> Column:
    return F.when(churned, "Churned").when(growth > 20, "Growing").when(growth < -20, "Declining").otherwise("Stable")


def loyalty_class(score: Column) -> Column:
    return F.when(score >= 4.5, "Very High").when(score >= 3.5, "High").when(score >= 2.5, "Medium").otherwise("Low")

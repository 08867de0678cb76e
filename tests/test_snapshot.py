from __future__ import annotations

import random
from calendar import monthrange
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.functions.calendar import build_dim_date
from ledgerloom.operators import segments, snapshot
from ledgerloom.sources.readers import segment_rules
from tests.conftest import values

SETTINGS = Settings(start=date(2015, 1, 1), cutoff=date(2016, 8, 31))


def month_end(d: date) -> date:
    return date(d.year, d.month, monthrange(d.year, d.month)[1])


def add_months(d: date, n: int) -> date:
    m = d.year * 12 + d.month - 1 + n
    return date(m // 12, m % 12 + 1, min(d.day, monthrange(m // 12, m % 12 + 1)[1]))


@pytest.fixture(scope="module")
def days(spark):
    return build_dim_date(spark, date(2014, 1, 1), date(2017, 12, 31), date(2016, 8, 31)).cache()


def inputs(spark, transactions, settings):
    """Fact and customers from (key, day, amount, balance) tuples; each key is current."""
    fact = spark.createDataFrame(
        [(k, d.year * 10000 + d.month * 100 + d.day, Decimal(a), Decimal(b)) for k, d, a, b in transactions],
        "CustomerKey long, DateKey int, TransactionAmount decimal(18,2), AccountBalance decimal(18,2)",
    )
    first: dict[int, date] = {}
    for k, d, *_ in transactions:
        first[k] = min(d, first.get(k, d))
    customers = spark.createDataFrame(
        [(k, f"C{k}", True, d, d) for k, d in first.items()],
        "CustomerKey long, CustomerID string, IsCurrent boolean, FirstTransactionDate date, FirstTransactionDateEver date",
    )
    return snapshot.monthly_activity(fact, settings.cutoff), customers


def brute_force(transactions, settings):
    """The snapshot rows month by month, straight from the definitions."""
    rows = []
    for key in {t[0] for t in transactions}:
        mine = [t for t in transactions if t[0] == key and t[1] <= settings.cutoff]
        if not mine:
            continue
        counts: dict[date, int] = {}
        last_in: dict[date, date] = {}
        balance: dict[date, Decimal] = {}
        for _, d, _, b in mine:
            m = month_end(d)
            counts[m] = counts.get(m, 0) + 1
            last_in[m] = max(d, last_in.get(m, d))
            balance[m] = max(Decimal(b), balance.get(m, Decimal(b)))
        first = min(t[1] for t in transactions if t[0] == key)
        last = max(last_in.values())
        running = carried = None
        m = month_end(settings.start)
        while m <= settings.cutoff:
            tail = last <= m <= add_months(last, 12)
            if m >= first and (tail or m in counts):
                before = month_end(add_months(date(m.year, m.month, 1), -1))
                if m in counts:
                    running = max(last_in[m], running or last_in[m])
                    carried = max(balance[m], carried or balance[m])
                rows.append(
                    (
                        key,
                        m,
                        counts.get(m, 0),
                        counts.get(before, 0),
                        before not in counts,
                        running,
                        balance.get(m, carried),
                    )
                )
            m = month_end(add_months(date(m.year, m.month, 1), 1))
    return sorted(rows, key=str)


COLUMNS = [
    "CustomerKey",
    "MonthEndDate",
    "TransactionCount",
    "PreviousMonthTransactionCount",
    "IsFirstMonth",
    "RunningLastTxDate",
    "FinalAccountBalance",
]


@pytest.mark.parametrize(
    "settings",
    [
        SETTINGS,
        replace(SETTINGS, cutoff=date(2016, 6, 15)),
        replace(SETTINGS, start=date(2015, 5, 10), cutoff=date(2016, 2, 29)),
    ],
)
def test_random_customers_equal_brute_force(spark, days, settings):
    draw = random.Random(3)
    transactions = []
    for key in range(1, 61):
        low = draw.randrange(0, 500)
        for _ in range(draw.randrange(1, 25)):
            day = date(2014, 11, 1) + timedelta(low + draw.randrange(0, 1 + draw.choice([5, 90, 400])))
            transactions.append((key, day, "5.00", f"{draw.randrange(0, 900)}.50"))
    activity, customers = inputs(spark, transactions, settings)
    merged = snapshot.merge_spine(activity, customers, days, settings)
    got = sorted((tuple(r) for r in merged.select(*COLUMNS).collect()), key=str)
    assert got == brute_force(transactions, settings)
    spine = snapshot.customer_spine(activity, customers, days, settings)
    assert values(spine, "CustomerKey", "MonthEndDate") == values(merged, "CustomerKey", "MonthEndDate")


def test_gap_is_absent_and_the_month_after_it_is_new(spark, days):
    transactions = [(1, date(2015, 1, 10), "5", "9"), (1, date(2015, 4, 2), "5", "3"), (1, date(2015, 4, 3), "6", "4")]
    activity, customers = inputs(spark, transactions, SETTINGS)
    rows = snapshot.score_snapshot(snapshot.merge_spine(activity, customers, days, SETTINGS), 42).orderBy("MonthEndDate").collect()
    months = [r.MonthEndDate for r in rows]
    assert date(2015, 2, 28) not in months and date(2015, 3, 31) not in months
    # twelve months after 3 April 2015 end on 3 April 2016, so March 2016 is the last month
    assert months[-1] == date(2016, 3, 31)
    april = rows[1]
    assert (april.TrendCategory, april.GrowthRate, april.IsFirstMonth) == ("New", None, True)
    assert april.FinalAccountBalance == Decimal("4.00")
    assert rows[2].FinalAccountBalance == Decimal("9.00")  # the running maximum
    last_value = snapshot.merge_spine(activity, customers, days, replace(SETTINGS, balance_carry="last_value"))
    assert last_value.where("MonthEndDate = '2015-05-31'").first().FinalAccountBalance == Decimal("4.00")


def test_average_is_rounded_half_up_to_cents(spark):
    activity, _ = inputs(spark, [(1, date(2015, 1, 1), a, "0") for a in ("0.01", "0.02")], SETTINGS)
    assert activity.first().AvgTransactionAmount == Decimal("0.02")


def test_cutoff_drops_later_rows(spark):
    activity, _ = inputs(spark, [(1, date(2016, 8, 31), "1", "0"), (1, date(2016, 9, 1), "1", "0")], SETTINGS)
    assert [r.TransactionCount for r in activity.collect()] == [1]


def test_whole_history_goes_under_the_current_version(spark, days):
    activity, _ = inputs(
        spark, [(1, date(2015, 1, 5), "1", "1"), (2, date(2015, 1, 6), "4", "2"), (2, date(2015, 2, 6), "4", "2")], SETTINGS
    )
    customers = spark.createDataFrame(
        [(1, "C", False, date(2015, 1, 5), date(2015, 1, 5)), (2, "C", True, date(2015, 1, 6), date(2015, 1, 5))],
        "CustomerKey long, CustomerID string, IsCurrent boolean, FirstTransactionDate date, FirstTransactionDateEver date",
    )
    whole = snapshot.merge_spine(activity, customers, days, replace(SETTINGS, grain="customer_id")).orderBy("MonthEndDate")
    january = whole.first()
    assert (january.CustomerKey, january.TransactionCount, january.AvgTransactionAmount) == (2, 2, Decimal("2.50"))
    version = snapshot.merge_spine(activity, customers, days, SETTINGS).orderBy("MonthEndDate").first()
    assert version.TransactionCount == 1


def points(spark, rows):
    return spark.createDataFrame(
        rows, "DaysSinceLastTransaction int, TransactionCount long, PreviousMonthTransactionCount long, IsFirstMonth boolean"
    )


def test_segment_steps_come_in_order(spark):
    rules = segment_rules(spark)
    rows = points(
        spark,
        [
            (61, 0, 5, False),
            (61, 0, 5, True),
            (61, 0, 4, False),
            (95, 0, 0, True),
            (10, 20, 0, True),
            (10, 20, 18, False),
            (None, 3, 1, False),
        ],
    )
    got = segments.assign_segment(rows, rules).select("SegmentKey", "SegmentStep").collect()
    assert [tuple(r) for r in got] == [
        (5, "AtRisk"),
        (5, "AtRisk"),
        (6, "Range"),
        (4, "New"),
        (4, "New"),
        (1, "Range"),
        (-1, None),
    ]
    by_band = segments.assign_segment(rows, rules, "range").select("SegmentKey").collect()
    assert [r.SegmentKey for r in by_band] == [6, 6, 6, 7, 1, 1, -1]


def test_rules_cover_every_point_once(spark):
    grid = spark.range(401 * 61).select(
        (F.col("id") % 401).cast("int").alias("DaysSinceLastTransaction"), F.floor(F.col("id") / 401).alias("TransactionCount")
    )
    rules = segment_rules(spark)
    assert segments.segment_rule_coverage(grid, rules).count() == 0
    broken = rules.withColumn("FrequencyMax", F.when(F.col("SegmentKey") == 4, 5).otherwise(F.col("FrequencyMax")))
    twice = segments.segment_rule_coverage(grid, broken)
    assert twice.count() == 31 and twice.agg(F.max("MatchingRules")).first()[0] == 2


def test_inactive_rules_are_ignored(spark):
    rules = segment_rules(spark).withColumn("IsActive", F.col("SegmentKey") != 1)
    row = segments.assign_segment(points(spark, [(10, 20, 18, False)]), rules).first()
    assert row.SegmentKey == -1

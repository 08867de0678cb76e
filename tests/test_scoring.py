from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import scoring


def rows(spark, data, schema, **columns):
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, " + schema)
    return [tuple(r)[1:] for r in frame.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()]


def test_recency_bands(spark):
    days = [(0,), (30,), (31,), (60,), (61,), (90,), (91,), (180,), (181,), (None,)]
    d = F.col("d")
    got = rows(spark, days, "d int", s=scoring.recency_score(d), c=scoring.churn_flag(d), r=scoring.at_risk_flag(d))
    assert [g[0] for g in got] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [g[1] for g in got] == [False] * 6 + [True] * 3 + [False]
    assert [g[2] for g in got] == [False] * 3 + [True] * 3 + [False] * 4


def test_frequency_bands(spark):
    counts = [(n,) for n in (0, 1, 2, 4, 5, 9, 10, 14, 15, 99)]
    assert [g[0] for g in rows(spark, counts, "n long", s=scoring.frequency_score(F.col("n")))] == [0, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_loyalty_score_is_decimal(spark):
    got = rows(spark, [(5, 5), (1, 0), (4, 3)], "r int, f int", s=scoring.loyalty_score(F.col("r"), F.col("f")))
    assert [g[0] for g in got] == [Decimal("5.00"), Decimal("0.30"), Decimal("3.30")]


def test_growth_is_clamped_and_rounded(spark):
    pairs = [(0, 4), (110, 10), (200, 10), (5, 8), (1, 3), (2, 3), (7, 0), (8, 8), (1, 1000000)]
    got = rows(spark, pairs, "n long, p long", g=scoring.growth_rate(F.col("n"), F.col("p")))
    expected = ["-99.99", "999.99", "999.99", "-37.50", "-66.67", "-33.33", None, "0.00", "-99.99"]
    assert [g[0] for g in got] == [None if e is None else Decimal(e) for e in expected]


def test_trend_edges(spark):
    # days, now, before
    cases = [(91, 0, 0), (10, 3, 0), (5, 121, 100), (5, 120, 100), (5, 106, 100), (5, 105, 100), (5, 95, 100)]
    cases += [(5, 94, 100), (5, 80, 100), (5, 79, 100), (None, 1, 0)]
    expected = ["Churned", "New", "Strong Growth", "Moderate Growth", "Moderate Growth", "Stable", "Stable"]
    expected += ["Moderate Decline", "Moderate Decline", "Sharp Decline", "New"]
    c = F.col
    got = rows(spark, cases, "d int, n long, p long", t=scoring.trend_category(c("d"), c("n"), c("p")))
    assert [g[0] for g in got] == expected


def test_complaints_need_a_fall_of_more_than_thirty_percent(spark):
    c = F.col
    flag = scoring.complaint_flag(c("n"), c("p"), c("h"))
    got = rows(spark, [(70, 100, 0), (69, 100, 0), (69, 100, 69), (69, 100, 70), (0, 0, 0)], "n long, p long, h long", f=flag)
    assert [g[0] for g in got] == [False, True, True, False, False]


def test_seeded_scores_stay_in_their_ranges_and_repeat(spark):
    people = spark.range(3000).select(F.concat(F.lit("C"), "id").alias("c"))
    number = scoring.seeded_number(1, F.col("c"), F.lit("20160831"))
    scored = people.select(
        scoring.satisfaction_score(F.lit(5), F.lit(4), number).alias("high"),
        scoring.satisfaction_score(F.lit(2), F.lit(2), number).alias("low"),
        scoring.satisfaction_score(F.lit(3), F.lit(5), number).alias("middle"),
    )
    ends = scored.agg(*[f(n) for n in ("high", "low", "middle") for f in (F.min, F.max)]).first()
    assert tuple(str(x) for x in ends) == ("4.00", "5.00", "1.00", "2.50", "2.50", "4.00")
    assert scored.exceptAll(scored).count() == 0


def test_report_bands(spark):
    c = F.col
    got = rows(spark, [(None,), (30,), (31,), (181,)], "d int", b=scoring.recency_bucket(c("d")))
    assert [g[0] for g in got] == ["0-30 days", "0-30 days", "31-60 days", "180+ days"]
    cases = [(True, 50.0), (False, 20.01), (False, -20.01), (False, 20.0), (False, None)]
    got = rows(spark, cases, "x boolean, g double", b=scoring.growth_category(c("x"), c("g")))
    assert [g[0] for g in got] == ["Churned", "Growing", "Declining", "Stable", "Stable"]

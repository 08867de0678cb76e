from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import rules as R
from ledgerloom.operators.segments import assign_segment
from ledgerloom.sources.readers import segment_rules
from ledgerloom.sources.schemas import SEGMENT_ROWS, SEGMENT_SCHEMA
from tests.conftest import values

RULES = "SegmentCode string, RecencyMin int, RecencyMax int, FrequencyMin int, FrequencyMax int"


def holding(rules, x, y):
    return sorted(n for n, a, b, c, d in rules if (a is None or x >= a) and (b is None or x <= b) and (c is None or y >= c) and (d is None or y <= d))


def test_the_usual_rules_leave_no_point_out_but_beyond_their_borders(spark):
    assert values(R.rule_faults(segment_rules(spark))) == [(0, 9999, 10000, None, 0, ""), (10000, None, 0, None, 0, "")]


def test_every_fault_is_found_as_rectangles(spark):
    draw = random.Random(3)
    for _ in range(4):
        rules = []
        for i in range(7):
            a, c = draw.randint(0, 12), draw.randint(0, 12)
            rules.append((f"r{i}", draw.choice([a, a, None]), draw.choice([a + draw.randint(0, 6), None]), c, draw.choice([c + draw.randint(0, 6)] * 3 + [None])))
        found = values(R.rule_faults(spark.createDataFrame(rules, RULES)))
        for x in range(30):
            for y in range(30):
                inside = [f for f in found if f[0] <= x and (f[1] is None or x <= f[1]) and f[2] <= y and (f[3] is None or y <= f[3])]
                own = holding(rules, x, y)
                assert len(inside) == (len(own) != 1)
                assert all(f[5] == ",".join(own) and f[4] == len(own) for f in inside)


def test_money_borders_and_no_rules(spark):
    schema = "SegmentCode string, RecencyMin decimal(18,2), RecencyMax decimal(18,2), FrequencyMin int, FrequencyMax int"
    rows = spark.sql("select 'a' c, 0.00d lo, 99.99d hi, 0 f, cast(null as int) t union all select 'b', 100.01, null, 0, null").toDF(*[p.split()[0] for p in schema.split(", ")])
    typed = rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("RecencyMin", "RecencyMax")})
    found = R.rule_faults(typed, steps=("0.01", "1"), kind="decimal").collect()
    assert [(str(f.XFrom), str(f.XTo), int(f.YFrom), f.YTo, f.Rules) for f in found] == [("100.0000", "100.0000", 0, None, 0)]
    assert values(R.rule_faults(typed.limit(0))) == [(0, None, 0, None, 0, "")]


def test_points_in_faulty_rectangles(spark):
    faults = R.rule_faults(spark.createDataFrame([("a", 0, 9, 0, None), ("b", 9, None, 0, 4)], RULES))
    points = spark.createDataFrame([(9, 3)] * 5 + [(20, 5), (0, 0)], "DaysSinceLastTransaction int, TransactionCount int")
    assert values(R.faulty_points(points, faults)) == [(10, None, 5, None, 0, "", 1), (9, 9, 0, 4, 2, "a,b", 5)]


def scored(spark, rows):
    return spark.createDataFrame(rows, "MonthEndDate date, DaysSinceLastTransaction int, TransactionCount int, PreviousMonthTransactionCount int, IsFirstMonth boolean")


@pytest.mark.parametrize("mode", ["as_coded", "range"])
def test_rules_of_one_time_are_the_rules_of_all_times(spark, mode):
    draw = random.Random(5)
    months = [date(2015, m, 28) for m in range(1, 13)]
    rows = scored(spark, [(draw.choice(months), draw.randint(0, 120), draw.randint(0, 20), draw.randint(0, 9), draw.random() < 0.2) for _ in range(500)])
    calendar = rows.select("MonthEndDate")
    always = segment_rules(spark)
    assert values(R.assign_segment_as_of(rows, always, calendar, mode)) == values(assign_segment(rows, always, mode))


def test_each_month_has_its_rules(spark):
    first = [(*r[:12], date(2015, 3, 1), date(2015, 5, 10) if r[1] == "RF_New" else None) for r in SEGMENT_ROWS]
    later = (9, "RF_New", "New", "RF", "", 0, 30, 0, 4, 4, "", True, date(2015, 7, 1), None)
    dormant = (8, "RF_New", "New", "RF", "", 0, 30, 0, 4, 4, "", False, date(2015, 1, 1), None)
    rules = spark.createDataFrame([*first, later, dormant], SEGMENT_SCHEMA)
    sets = R.rule_set_versions(rules).orderBy("FromDate").collect()
    assert [(s.FromDate, s.ToDate, len(s.Rules)) for s in sets] == [
        (date(2015, 3, 1), date(2015, 5, 10), 7), (date(2015, 5, 11), date(2015, 6, 30), 6), (date(2015, 7, 1), date(9999, 12, 31), 7)
    ]
    ends = [date(2015, 2, 28), date(2015, 4, 30), date(2015, 5, 31), date(2015, 7, 31)]
    rows = scored(spark, [(d, 5, 2, 0, False) for d in ends])
    got = {r.MonthEndDate: (r.SegmentKey, r.SegmentStep) for r in R.assign_segment_as_of(rows, rules, rows).collect()}
    assert [got[d] for d in ends] == [(-1, None), (4, "Range"), (-1, None), (9, "Range")]
    with pytest.raises(ValueError, match="mode"):
        R.assign_segment_as_of(rows, rules, rows, "nearest")

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import difference as D
from ledgerloom.operators import quality, quantile
from ledgerloom.plans import transitions
from ledgerloom.sources import readers
from tests.conftest import values


def data(kind: str) -> list[float]:
    draw = random.Random(kind)
    return {
        "spread": [draw.lognormvariate(3, 4) * draw.choice([1, -1]) for _ in range(5000)],
        "few": [float(draw.choice([0, 0, 0, 1, 2, 7])) for _ in range(3000)],
        "ends": [1.7e308, -1.7e308, 0.0, -0.0, 5e-324, *[draw.random() * 1e-300 for _ in range(500)]],
        "one": [3.5],
        "two": [1.0, 2.0],
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "few", "ends", "one", "two"])
@pytest.mark.parametrize("small", [False, True])
def test_many_quantiles_at_once(spark, monkeypatch, kind, small):
    if small:  # many passes: few cells, no early end, a rough summary
        monkeypatch.setattr(quantile, "ALL_CELLS", 60)
        monkeypatch.setattr(quantile, "LAST_VALUES", 2)
        monkeypatch.setattr(quantile, "SUMMARY_ACCURACY", 20)
    numbers = data(kind)
    shares = [0.0, 0.001, 0.1, 0.25, 0.5, 0.5, 0.77, 0.999, 1.0]
    df = spark.createDataFrame([(x,) for x in [*numbers, None]], "v double").repartition(3)
    ordered = sorted(numbers)
    want = []
    for s in shares:
        place = s * (len(ordered) - 1)
        low, high = ordered[math.floor(place)], ordered[min(math.floor(place) + 1, len(ordered) - 1)]
        want.append(low if low == high else low + (high - low) * (place - math.floor(place)))
    assert quantile.exact_quantiles(df, "v", shares) == want
    borders = [ordered[math.ceil(i * len(ordered) / 7) - 1] for i in range(1, 7)]
    assert quantile.level_borders(df, "v", 7) == borders
    if not small:
        got = quantile.equi_depth_levels(df, "v", 7).collect()
        assert all(r.Level is None if r.v is None else r.Level == 1 + sum(b < r.v for b in borders) for r in got)


def test_deciles_take_three_passes(spark, monkeypatch):
    draw = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x),) for x in draw.normal(1000, 300, 200_000).round(2)], "v double")
    passes = []
    counted = quantile._counted_slots
    monkeypatch.setattr(quantile, "_counted_slots", lambda *a: passes.append(1) or counted(*a))
    got = quantile.exact_quantiles(df, "v", [i / 10 for i in range(1, 10)])
    assert np.allclose(got, np.quantile([r.v for r in df.collect()], [i / 10 for i in range(1, 10)]), rtol=0, atol=1e-9)
    assert len(passes) == 1  # the summary, one count, and the last values


def test_no_values_and_values_without_a_place(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert quantile.exact_quantiles(none, "v", [0.5]) is None and quantile.level_borders(none, "v", 4) == []
    assert [r.Level for r in quantile.equi_depth_levels(none, "v", 4).collect()] == [None]
    assert quantile.exact_quantiles(none, "v", []) == []
    assert [r.Level for r in quantile.equi_depth_levels(spark.range(3), "id", 1).collect()] == [1, 1, 1]
    with pytest.raises(ValueError, match="finite"):
        quantile.exact_quantiles(spark.createDataFrame([(math.nan,)], "v double"), "v", [0.5])


def test_planted_changes_are_found(spark):
    rows = [(i % 50, i, f"v{i}" if i % 7 else None, None) for i in range(400)]
    schema = "k int, n int, a string, b string"
    left = spark.createDataFrame(rows, schema)
    other = [list(r) for r in rows if r[0] != 3]
    other[10][2], other[10][3] = None, other[10][2]  # a value moves to another column
    other.append(list(other[20]))  # a row twice
    other.append([None, 1, "x", "y"])
    right = spark.createDataFrame([tuple(r) for r in other], schema).select("b", "a", "n", "k").repartition(4)
    got = values(D.table_difference(left, right, ["k"], 16), "k", "LeftRows", "RightRows", "Change")
    assert got == sorted(
        [(3, 8, 0, "removed"), (other[10][0], 8, 8, "changed"), (other[20][0], 8, 9, "changed"), (None, 0, 1, "added")],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert D.table_difference(left, left.repartition(3), ["k"]).count() == 0
    digests = [D.bucket_digests(df, ["k"], 16) for df in (left, right)]
    assert 1 <= len(D.differing_buckets(*digests)) <= 4 and digests[0].count() <= 16
    with pytest.raises(ValueError, match="columns"):
        D.table_difference(left, right.drop("a"), ["k"])


def test_planted_faults_are_reported(spark):
    customers = spark.createDataFrame([("A", True), ("A", True), ("B", False), ("C", True)], "CustomerID string, IsCurrent boolean")
    assert values(quality.customers_without_one_current(customers)) == [("A", 2), ("B", 0)]
    scores = spark.createDataFrame([(0, 0, 1.0), (6, 6, 5.5), (3, -1, None), (5, 5, 5.0)], "RecencyScore int, FrequencyScore int, SatisfactionScore double")
    assert values(quality.score_domains(scores)) == [(2, 2, 2)]
    keys = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "CustomerKey int, DateKey int")
    assert values(quality.duplicate_keys(keys, ["CustomerKey", "DateKey"])) == [(1, 1, 2), (None, 1, 2)]
    tables = {n: spark.createDataFrame([], ", ".join(f"{c} int" for c in cs)) for n, cs in quality.REQUIRED.items()}
    lost = spark.createDataFrame([(1,), (None,), (None,)], "TransactionAmount int")
    others = [F.lit(1).alias(c) for c in quality.REQUIRED["Fact_Transaction"] if c != "TransactionAmount"]
    tables["Fact_Transaction"] = lost.select("TransactionAmount", *others)
    found = quality.required_columns(tables).where("NullRows > 0")
    assert values(found) == [("Fact_Transaction", "TransactionAmount", 2)]


def test_reasons_add_up(spark):
    raw = spark.createDataFrame(
        [("t1", "C1", "1/1/2015"), (None, "C1", "1/1/2015"), ("t2", " nan ", "1/1/2015"), ("t3", None, "x"), ("t4", "C", "nan"), ("t5", "C", None), ("t6", "C", " nan"), ("t7", "C", "31/2/2015"), ("t8", "C", "1/1/1999"), ("t9", "C", "2/1/2015")],
        "TransactionID string, CustomerID string, TransactionDate string",
    )
    days = spark.sql("select date '2015-01-01' as Date union select date '2015-01-02'")
    got = dict(values(quality.reconciliation_by_reason(raw, spark.range(1), days)))
    assert got == {
        "no transaction id": 1, "no customer": 2, "no date": 2, "unreadable date": 2, "date outside the calendar": 1, "fact": 1, "unexplained": 1
    }
    assert sum(got.values()) == raw.count()
    assert sum(dict(values(quality.reconciliation_by_reason(raw.limit(0), spark.range(0), days))).values()) == 0


def test_rejected_records_are_kept(spark, tmp_path):
    names = ",".join(readers.RAW_COLUMNS)
    good = 't1,C1,1/1/1980,F,"Pune, India",1.5,1/1/2015,1,2'
    bad = ["t2,C1", 't3,C1,1/1/1980,F,"a, b",1.5,1/1/2015,1,2,3', ",,,,,,,"]
    (tmp_path / "a.csv").write_text("\n".join([names, good, *bad, "", good.replace("t1", "t4")]) + "\n")
    kept, rejected = readers.quarantined(spark, str(tmp_path / "a.csv"), str(tmp_path / "kept"), str(tmp_path / "rejected"))
    assert values(kept, "TransactionID", "CustLocation") == [("t1", "Pune, India"), ("t4", "Pune, India")]
    assert values(rejected, "Rule", "Fields", "RawText") == sorted([("too few fields", 2, bad[0]), ("too many fields", 10, bad[1]), ("too few fields", 8, bad[2])], key=str)
    again, both = readers.quarantined(spark, str(tmp_path / "a.csv"), str(tmp_path / "kept"), str(tmp_path / "rejected"))
    assert again.count() == 2 and both.count() == 6


def test_paths_of_customers(spark):
    class Model:
        segment_keys = {"RF_New": 4, "RF_Potential": 3, "RF_Loyal": 2}
        snapshot = spark.createDataFrame(
            [(c, 20150031 + m * 100 if m <= 12 else 20160031 + (m - 12) * 100, s) for c, path in enumerate(
                ["4", "43", "4.3..2", "4....3", "4..44..3.2", "32", "", "42", "4.3....4.3.2", "432432", "5.6"], 1
            ) for m, s in enumerate(path or "7", 1) if s != "." for s in [int(s)]],
            "CustomerKey int, DateKey int, SegmentKey int",
        )

    got = {r.CustomerKey: (r.Stage, r.Months, r.MonthsInStages) for r in transitions.customer_paths(Model).collect()}
    assert got == {
        1: (1, 0, []), 2: (2, 1, [1]), 3: (3, 5, [2, 3]), 4: (1, 0, []), 5: (3, 9, [7, 2]), 6: (0, None, []), 7: (0, None, []),
        8: (1, 0, []), 9: (3, 4, [2, 2]), 10: (3, 2, [1, 1]), 11: (0, None, []),
    }

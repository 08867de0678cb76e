"""Batches that commit as a whole, can be given again, and can go on after a stop."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.operators.scd2 import window_difference
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources.schemas import RAW_SCHEMA
from ledgerloom.sources.versions import ConcurrentLoad, Manifest, TableStore, fingerprint
from tests.conftest import values

SETTINGS = Settings(calendar_end=date(2017, 12, 31))
CITIES = "CityName string, State string, Region string"


def raw_rows(spark, places: list[tuple[str, str, int]], first: int = 0):
    rows = [
        (f"t{first + i}", who, "3/4/1980", "F", where, "50.00", f"{1 + day % 28}/{1 + day // 28}/2015", "1", f"{10 + i}.50")
        for i, (who, where, day) in enumerate(places)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def facts(lake: Warehouse) -> list[tuple]:
    owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID", "LocationMatch")
    return values(lake.table("Fact_Transaction").join(owners, "CustomerKey"), "TransactionID", "CustomerID", "LocationMatch", "DateKey", "TransactionAmount")


def snapshot(lake: Warehouse) -> list[tuple]:
    owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID")
    return values(lake.table("Fact_CustomerSnapshot").join(owners, "CustomerKey"), "CustomerID", "DateKey", "TransactionCount", "LoyaltyScore", "SegmentKey")


def opened(spark, folder, raw=None, scd_join="version_key"):
    cities = spark.createDataFrame([("Pune", "Maharashtra", "West")], CITIES)
    settings = Settings(calendar_end=date(2017, 12, 31), scd_join=scd_join)
    return Warehouse(spark, str(folder), settings, raw, cities if raw is not None else None, land_raw=True)


FIRST = [(f"C{i % 4}", "Pune" if i % 3 else "Delhi", i * 5) for i in range(24)]
SECOND = [("C0", "Goa", 7), ("C9", "Pune", 200), ("C1", "Delhi", 300), ("C1", "Pune", 2)]


def test_a_batch_is_seen_whole_or_not_at_all_and_goes_on_where_it_stopped(spark, tmp_path):
    first, second = raw_rows(spark, FIRST), raw_rows(spark, SECOND, 100)
    opened(spark, tmp_path / "w", first).load()
    reader = opened(spark, tmp_path / "w")
    before = facts(reader)
    all_steps: list[str] = []

    class Stop(Exception):
        pass

    def stopping_after(count):
        left = [count]

        def after_step(name):
            all_steps.append(name)
            left[0] -= 1
            if not left[0]:
                raise Stop(name)

        return after_step

    stopped, folders = 0, {}
    while True:
        stopped += 1
        lake = opened(spark, tmp_path / "w")
        try:
            lake.apply_batch(second, batch_id=3, after_step=stopping_after(stopped))
            break
        except Stop as at:
            # nobody sees anything of it, and what was finished is not written again
            assert opened(spark, tmp_path / "w").store.latest().batches == {}
            assert facts(opened(spark, tmp_path / "w")) == before
            now = {p: p.stat().st_mtime_ns for p in (tmp_path / "w" / str(at)).rglob("StoredIn=*batch3*/_SUCCESS")}
            assert now and folders.keys().isdisjoint(now)
            folders.update(now)
    assert stopped == len(folders) + 1 and all(p.stat().st_mtime_ns == t for p, t in folders.items())
    assert len(set(all_steps)) == stopped - 1 and {"Stg_Transaction", "Dim_Customer", "Fact_CustomerSnapshot"} <= set(all_steps)

    whole = opened(spark, tmp_path / "whole", first.unionByName(second))
    whole.load()
    assert facts(lake) == facts(whole) and snapshot(lake) == snapshot(whole)
    assert lake.table("RawTransactions").count() == 28
    assert {r[0] for r in lake.table("Fact_Transaction").where("ETLBatchID = 3").select("TransactionID").collect()} == {f"t{i}" for i in range(100, 104)}

    # given again: nothing; given with other rows: an error; without an id: a batch of its own
    again = opened(spark, tmp_path / "w")
    again.apply_batch(second.repartition(3), batch_id=3)
    assert again.store.latest().version == 2 and facts(again) == facts(whole)
    with pytest.raises(ValueError, match="other rows"):
        again.apply_batch(second.limit(2), batch_id=3)
    again.apply_batch(raw_rows(spark, [("C2", "Goa", 100)], 500))
    assert again.store.latest().batches.keys() == {"3", "4"} and len(facts(again)) == len(facts(whole)) + 1

    # one who opened the first version still reads it, until its folders are removed
    assert facts(reader) == before
    assert reader.store.remove_unnamed() > 0
    assert facts(opened(spark, tmp_path / "w")) == facts(again)
    assert reader.store.remove_unnamed() == 0


def test_older_facts_meet_windows_that_a_batch_has_moved(spark, tmp_path):
    first, second = raw_rows(spark, [("B", "x", 1), ("B", "x", 5), ("B", "y", 10)]), raw_rows(spark, [("B", "x", 20)], 50)
    lake = opened(spark, tmp_path / "w", first, "date_range")
    lake.load()
    lake.apply_batch(second, batch_id=1)
    whole = opened(spark, tmp_path / "whole", first.unionByName(second), "date_range")
    whole.load()
    assert facts(lake) == facts(whole) and len(facts(whole)) == 5
    draw = random.Random(8)
    for number in range(2, 4):
        more = [(draw.choice("BCD"), draw.choice(["x", "y", "z", "nan"]), draw.randint(0, 120)) for _ in range(25)]
        batch = raw_rows(spark, more, 100 * number)
        first = first.unionByName(second if number == 2 else last)
        last = batch
        lake.apply_batch(batch, batch_id=number)
    whole = opened(spark, tmp_path / "all", first.unionByName(last), "date_range")
    whole.load()
    assert facts(lake) == facts(whole) and snapshot(lake) == snapshot(whole)


def test_window_difference_day_by_day(spark):
    draw = random.Random(2)
    origin = date(2015, 1, 1)

    def window():
        a = draw.randint(0, 12)
        return (origin + timedelta(a), None if draw.random() < 0.25 else origin + timedelta(a + draw.randint(0, 8)))

    old = {i: window() for i in range(300) if draw.random() < 0.85}
    new = {i: old[i] if i in old and draw.random() < 0.2 else window() for i in range(300) if draw.random() < 0.85}
    schema = "k int, StartDate date, EndDate date"
    frames = [spark.createDataFrame([(k, *w) for k, w in side.items()], schema) for side in (old, new)]
    got = {}
    for r in window_difference(*frames, "k").collect():
        days = {origin + timedelta(i) for i in range(40) if r.StartDate <= origin + timedelta(i) <= r.EndDate}
        assert r.StartDate <= r.EndDate and not days & got.setdefault((r.k, r.Gained), set())
        got[r.k, r.Gained] |= days
    held = lambda side, k: {origin + timedelta(i) for i in range(40) if k in side and side[k][0] <= origin + timedelta(i) <= (side[k][1] or date.max)}
    for k in range(300):
        assert got.get((k, True), set()) == held(new, k) - held(old, k)
        assert got.get((k, False), set()) == held(old, k) - held(new, k)


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.latest() == Manifest()
    one, other = store.begin("a"), store.begin("b")
    one.write("T", lambda: spark.range(3).selectExpr("id", "id % 2 as p"), "p")
    other.write("T", lambda: spark.range(9).selectExpr("id", "id % 2 as p"), "p")
    one.commit()
    with pytest.raises(ConcurrentLoad):
        other.commit()
    none = store.begin("none")
    none.write("T", lambda: spark.range(0).selectExpr("id", "id % 2 as p"), "p", append=True)
    none.commit()
    more = store.begin("more")
    assert more.write("T", lambda: spark.range(5, 7).selectExpr("id", "id % 2 as p"), "p", append=True).columns == ["id", "p"]
    assert values(more.added("T"), "id") == [(5,), (6,)] and more.before("T").count() == 3
    more.commit(("1", "f"))
    rows = store.read("T", store.latest().tables["T"])
    assert values(rows) == [(0, 0), (1, 1), (2, 0), (5, 1), (6, 0)]
    assert "PartitionFilters: [isnotnull(p" in rows.where("p = 1")._jdf.queryExecution().toString()
    assert store.manifest(1).tables["T"].folders == store.latest().tables["T"].folders[:1]
    assert store.remove_unnamed() == 3  # the folder of the load that came too late, and two manifests
    assert Manifest.of(store.latest().text()) == store.latest()
    empty = TableStore(spark, str(tmp_path / "empty")).begin("x")
    assert empty.write("E", lambda: spark.range(0).selectExpr("id", "id as p"), "p").count() == 0


def test_equal_batches_have_equal_fingerprints(spark):
    rows = raw_rows(spark, FIRST)
    assert fingerprint(rows) == fingerprint(rows.repartition(5).orderBy(F.desc("TransactionID")))
    assert fingerprint(rows) != fingerprint(rows.limit(23)) != fingerprint(rows.unionByName(rows))


def test_columns_of_many_values_are_written_without_a_dictionary(spark, tmp_path):
    from pyarrow.parquet import ParquetFile

    opened(spark, tmp_path, raw_rows(spark, [("C1", "Pune", i % 300) for i in range(2000)])).load()
    for table, balance in (("RawTransactions", "CustAccountBalance"), ("Stg_Transaction", "AccountBalance"), ("Fact_Transaction", "AccountBalance")):
        coded = {}
        for file in (tmp_path / table).rglob("part-*.parquet"):
            groups = ParquetFile(file).metadata
            for column in (groups.row_group(g).column(c) for g in range(groups.num_row_groups) for c in range(groups.num_columns)):
                coded.setdefault(column.path_in_schema, set()).add("RLE_DICTIONARY" in column.encodings or "PLAIN_DICTIONARY" in column.encodings)
        # all balances are equal here, so that a dictionary would not be given up
        assert coded["TransactionID"] == coded["TransactionAmount"] == coded[balance] == {False}
        assert True in set().union(*coded.values())

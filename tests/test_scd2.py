from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.config import Settings
from ledgerloom.functions.calendar import build_dim_date
from ledgerloom.operators import dimensions, facts, quality, scd2, staging
from ledgerloom.sources.schemas import RAW_SCHEMA
from tests.conftest import values

SETTINGS = Settings(start=date(2015, 1, 1), cutoff=date(2016, 8, 31))


def raw(spark, rows):
    """(transaction, customer, place, day text, amount text)"""
    full = [(t, c, "1/2/1980", "M", place, "100.00", day, "101010", amount) for t, c, place, day, amount in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


MOVER = [
    ("t1", "C1", "A", "1/1/2015", "10"),
    ("t2", "C1", " A ", "5/2/2015", "abc"),
    ("t3", "C1", "B", "1/3/2015", "30"),
    ("t4", "C1", "B", "31/2/2015", "40"),
    ("t5", "C1", "a", "1/5/2015", "50"),
    ("t6", "nan", "B", "1/5/2015", "60"),
    ("t7", "C2", "nan", "2/5/2015", "70"),
    (None, "C2", "B", "2/5/2015", "80"),
    ("t9", "C3", "B", "nan", "90"),
]


@pytest.fixture(scope="module", params=["10485760", "-1"], ids=["broadcast", "shuffle"])
def star(spark, request):
    """The star with both kinds of join: small sides broadcast, and hot keys cut."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield _star(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _star(spark):
    base = raw(spark, MOVER)
    stg = staging.stage(base)
    cities = spark.createDataFrame([("a", "STATE A", "North")], "CityName string, State string, Region string")
    places = dimensions.build_dim_location(stg["Stg_Location"], cities).cache()
    history = dimensions.location_history(stg["Stg_Transaction"]).cache()
    customers = dimensions.build_dim_customer(history, stg["Stg_Customer"], places, SETTINGS).cache()
    days = build_dim_date(spark, date(2015, 1, 1), date(2016, 12, 31), date(2016, 8, 31))
    return stg, places, history, customers, days


def test_locations_share_a_code_and_get_their_state(star):
    _, places, *_ = star
    assert values(places, "LocationCode", "LocationName", "State", "Region") == [
        ("A", "A", "STATE A", "North"),
        ("B", "B", "Unknown", "Unknown"),
    ]


def test_versions_of_a_customer_who_came_back(star):
    *_, customers, _ = star
    got = values(customers, "CustomerID", "Location", "StartDate", "EndDate", "IsCurrent")
    assert got == [
        ("C1", "A", date(2015, 1, 1), None, True),
        ("C1", "B", date(2015, 3, 1), date(2015, 3, 1), False),
        ("C2", "Unspecified", date(2015, 5, 2), None, True),
    ]
    assert quality.customers_without_one_current(customers).count() == 0
    assert values(scd2.scd_version_histogram(customers)) == [(1, 1), (2, 1)]


def test_groups_without_a_date_are_skipped_and_counted(star):
    _, _, history, *_ = star
    assert quality.skipped_histories(history).first().SkippedGroups == 1


def test_tie_on_the_last_day_goes_to_the_first_place(spark):
    rows = [("t1", "C1", "Z", "1/1/2015", "1"), ("t2", "C1", "Y", "1/1/2015", "1")]
    history = dimensions.location_history(staging.stage_transactions(raw(spark, rows)))
    versions = dimensions.scd2_versions(history)
    assert values(versions, "Location", "IsCurrent") == [("Y", True), ("Z", False)]


def test_version_key_gives_each_transaction_one_version(star):
    stg, places, _, customers, days = star
    fact = facts.build_fact_transaction(stg["Stg_Transaction"], customers, days, places)
    named = fact.join(customers.select("CustomerKey", "CustomerID", "Location"), "CustomerKey")
    assert values(named, "TransactionID", "Location", "DateKey", "TransactionAmount") == [
        ("t1", "A", 20150101, Decimal("10.00")),
        ("t2", "A", 20150205, Decimal("0.00")),
        ("t3", "B", 20150301, Decimal("30.00")),
        ("t5", "A", 20150501, Decimal("50.00")),
        ("t7", "Unspecified", 20150502, Decimal("70.00")),
    ]
    assert quality.duplicated_transactions(fact).count() == 0
    assert fact.where("TransactionID = 't7'").first().LocationKey is None


def test_date_range_meets_every_version_that_holds_the_day(star):
    stg, places, _, customers, days = star
    fact = facts.build_fact_transaction(stg["Stg_Transaction"], customers, days, places, "date_range")
    doubled = values(quality.duplicated_transactions(fact))
    assert doubled == [("t3", 2)]
    assert fact.count() == 6


def test_unknown_join_mode(star):
    stg, _, _, customers, _ = star
    with pytest.raises(ValueError):
        scd2.scd2_join(stg["Stg_Transaction"], customers, "CustomerID", "TransactionDay", "nearest")


def test_merge_closes_opens_and_overwrites(spark):
    schema = "CustomerKey long, CustomerID string, Location string, Gender string, StartDate date, EndDate date, IsCurrent boolean"
    day = date(2015, 1, 1)
    current = spark.createDataFrame(
        [
            (1, "C1", "A", "Male", day, None, True),
            (2, "C2", "A", "Male", day, None, True),
            (3, "C3", "A", "Male", day, None, True),
            (4, "C3", "Z", "Male", day, day, False),
        ],
        schema,
    )
    updates = spark.createDataFrame(
        [("C1", "B", "Male"), ("C2", "A", "Female"), ("C9", "Q", "Male")], "CustomerID string, Location string, Gender string"
    )
    merged = scd2.scd2_merge(
        current, updates, "CustomerID", ["Location"], ["Gender"], date(2016, 1, 1), surrogate="CustomerKey"
    )
    assert merged.columns == current.columns
    got = values(merged, "CustomerID", "Location", "Gender", "StartDate", "EndDate", "IsCurrent")
    assert got == [
        ("C1", "A", "Male", day, date(2015, 12, 31), False),
        ("C1", "B", "Male", date(2016, 1, 1), None, True),
        ("C2", "A", "Female", day, None, True),
        ("C3", "A", "Male", day, None, True),
        ("C3", "Z", "Male", day, day, False),
        ("C9", "Q", "Male", date(2016, 1, 1), None, True),
    ]
    assert sorted(r.CustomerKey for r in merged.collect()) == [1, 2, 3, 4, 5, 6]


def test_merge_refuses_repeated_keys_and_early_dates(spark):
    schema = "CustomerKey long, CustomerID string, Location string, StartDate date, EndDate date, IsCurrent boolean"
    current = spark.createDataFrame([(1, "C1", "A", date(2015, 1, 1), None, True)], schema)
    twice = spark.createDataFrame([("C1", "B"), ("C1", "C")], "CustomerID string, Location string")
    with pytest.raises(ValueError, match="C1"):
        scd2.scd2_merge(current, twice, "CustomerID", ["Location"], [], date(2016, 1, 1))
    with pytest.raises(Exception, match="not after the start"):
        scd2.scd2_merge(current, twice.limit(1), "CustomerID", ["Location"], [], date(2015, 1, 1)).collect()


def test_a_customer_who_returns_keeps_one_row_per_transaction(star):
    stg, places, _, customers, days = star
    one = customers.sparkSession.createDataFrame
    at = lambda place: one([("C1", place), ("C9", "B")], "CustomerID string, Location string")
    away = scd2.merge_customers(customers, at("B"), places, date(2016, 1, 1))
    back = scd2.merge_customers(away, at("A"), places, date(2016, 3, 1))
    assert back.columns == customers.columns
    assert back.where("LocationMatch is null or FirstTransactionDate is null or DatedRows is null").count() == 0
    assert back.where("Location in ('A', 'B') and LocationKey is null").count() == 0
    keys = [r.CustomerKey for r in back.collect()]
    assert len(set(keys)) == len(keys) and quality.customers_without_one_current(back).count() == 0
    rows = [(f"x{m}", "C1", "A", f"5/{m}/2016", "1") for m in (1, 2, 4)] + [("y2", "C1", "B", "5/2/2016", "1")]
    batch = staging.stage_transactions(raw(customers.sparkSession, rows))
    fact = facts.build_fact_transaction(batch, back, days, places).join(back.select("CustomerKey", "StartDate"), "CustomerKey")
    assert values(fact, "TransactionID", "StartDate") == [
        ("x1", date(2016, 3, 1)),  # no version at A holds the day: the last one
        ("x2", date(2016, 3, 1)),
        ("x4", date(2016, 3, 1)),
        ("y2", date(2016, 1, 1)),
    ]

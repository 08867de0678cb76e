from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.config import Settings
from ledgerloom.functions.calendar import build_dim_date, with_month_label
from ledgerloom.plans import dashboards, transitions
from ledgerloom.plans.measures import MEASURES, anchor, measures, trend
from ledgerloom.plans.model import Model, report_name
from ledgerloom.sources.readers import segment_rules
from tests.conftest import values

COLUMNS = (
    "CustomerKey long, DateKey int, SegmentKey int, TransactionCount long, TotalTransactionAmount decimal(18,2), "
    "AvgTransactionAmount decimal(18,2), DaysSinceLastTransaction int, RecencyScore int, FrequencyScore int, "
    "LoyaltyScore decimal(5,2), SatisfactionScore decimal(3,2), ComplaintFlag boolean, ChurnFlag boolean, "
    "AtRiskFlag boolean, TrendCategory string, GrowthRate decimal(5,2)"
)
JUL, AUG = 19990731, 19990831


def row(customer, key, segment, count=1, churn=False, risk=False, trend="Stable", growth=None, satisfaction="3.00", complaint=False):
    amount = Decimal(count * 10)
    return (
        customer, key, segment, count, amount, Decimal(10), 5, 5, 2, Decimal("2.00"), Decimal(satisfaction),
        complaint, churn, risk, trend, None if growth is None else Decimal(growth),
    )


ROWS = [
    row(1, JUL, 3, growth="10"),
    row(2, JUL, 3, trend="New"),
    row(3, JUL, 6, count=0, risk=True),
    row(1, AUG, 2, growth="5", satisfaction="4.00"),
    row(2, AUG, 3, growth="3", satisfaction="2.00", complaint=True),
    row(3, AUG, 7, count=0, churn=True),
    row(4, AUG, 4, trend="New", satisfaction="4.50"),
]


def model_with(spark, rows):
    customers = spark.createDataFrame(
        [(k, f"C{k}", g, 30, "26-35", "Existing", "X", k % 2 + 1) for k, g in ((1, "Male"), (2, "Female"), (3, "Male"), (4, "Female"))],
        "CustomerKey long, CustomerID string, Gender string, Age int, AgeGroup string, CustomerType string, Location string, LocationKey long",
    )
    places = spark.createDataFrame(
        [(1, "A", "A", "A", "S1", "India", "R"), (2, "B", "B", "B", "S2", "India", "R")],
        "LocationKey long, LocationCode string, LocationName string, City string, State string, Country string, Region string",
    )
    days = with_month_label(build_dim_date(spark, date(1998, 1, 1), date(1999, 12, 31), date(1999, 8, 31)))
    return Model(spark.createDataFrame(rows, COLUMNS), days, customers, places, segment_rules(spark), Settings())


@pytest.fixture(scope="module")
def model(spark):
    return model_with(spark, ROWS)


def one(model, name, **how):
    return measures(model, name, **how).first()[0]


def test_anchors_look_back_by_month_quarter_and_year(model):
    a = model.anchors()
    assert (a.last, a.previous, a.quarter, a.year) == (AUG, JUL, 19990531, 19980831)
    assert anchor(model, {"YearMonth": "1999-07"}) == JUL
    assert anchor(model, {"Year": 1998}) is None


def test_counts_and_rates(model):
    assert one(model, "total_customers") == 4
    assert one(model, "active_customers") == 3
    assert one(model, "churn_rate") == 0.25
    assert one(model, "retention_rate") == 0.75
    assert one(model, "customer_growth_mom") == pytest.approx(1 / 3)
    assert one(model, "nps_score") == 0.25
    assert one(model, "avg_growth_rate") == pytest.approx(0.04)
    assert one(model, "total_transaction_amount") == Decimal("50.00")


def test_nothing_is_blank_and_not_zero(model):
    assert one(model, "at_risk_customers") is None
    assert one(model, "customer_growth_qoq") is None  # no such month: nothing to divide by
    assert one(model, "champions_count") is None
    assert one(model, "churn_rate_mom_change") == 0.25  # no churn the month before counts as zero


def test_groups_without_a_value_are_absent(model):
    assert values(measures(model, "churned_customers", by=["Gender"])) == [("Male", 1)]
    rates = measures(model, ["churn_rate", "total_customers"], by=["Gender"])
    assert values(rates) == [("Female", None, 2), ("Male", 0.5, 2)]
    assert values(measures(model, "retention_rate", by=["Gender"])) == [("Female", 1.0), ("Male", 0.5)]


def test_segment_share_ignores_segment_filters(model):
    share = measures(model, "segment_share", by=["SegmentName"])
    assert {v for _, v in values(share)} == {0.25}
    one_segment = measures(model, ["segment_share", "total_customers"], where={"SegmentCode": "RF_Loyal"})
    assert tuple(one_segment.first()) == (0.25, 1)


def test_date_filters_meet_the_anchor(model):
    july = {"YearMonth": "1999-07"}
    assert one(model, "total_customers", where=july) is None
    assert one(model, "total_customers", where=july, anchor="selected") == 3
    assert one(model, "transaction_volume_trend", where=july) == 2


def test_location_filters_and_groups(model):
    assert values(measures(model, "total_customers", by=["State"])) == [("S1", 2), ("S2", 2)]
    assert one(model, "total_customers", where={"State": "S2", "Gender": ["Male", "Female"]}) == 2


def test_trend_takes_each_month_as_its_own_anchor(model):
    got = values(trend(model, ["total_customers", "churned_customers"]))
    assert got == [(JUL, "1999-07", 3, None), (AUG, "1999-08", 4, 1)]
    with pytest.raises(ValueError):
        trend(model, "customer_growth_mom")
    with pytest.raises(ValueError):
        measures(model, "customer_growth_yoy", by=["YearMonth"])
    with pytest.raises(ValueError):
        measures(model, "total_customers", by=["Colour"])


def test_every_measure_has_a_column(model):
    row = measures(model, list(MEASURES)).first()
    assert len(row) == len(MEASURES)


def test_a_model_of_one_month(spark):
    single = model_with(spark, [r for r in ROWS if r[1] == AUG])
    assert one(single, "total_customers") == 4
    assert one(single, "customer_growth_mom") is None
    assert transitions.segment_migration(single, "month").first()[0] is None
    assert transitions.transitions(single).first().NewCustomers == 0
    assert transitions.transitions(single, per_month=True).count() == 0


def test_transitions(model):
    moved = transitions.segment_migration(model, "month").first()[0]
    assert moved == 2  # one to Loyal, one to Churned
    got = transitions.transitions(model).first()
    assert (got.NewCustomers, got.NewRetained, got.PotentialLoyalists, got.LoyalConversions) == (1, 1, 2, 1)
    assert (got.LoyalConversionRate, got.HibernatingCustomers, got.WonBack) == (0.5, 1, 0)
    assert values(transitions.converted_customers(model)) == [("C1",)]
    flow = values(transitions.segment_flow(model, "month"))
    assert ("Potential Loyalists", "Loyal Customers", 1) in flow and len(flow) == 3


def test_streaks_need_neighbouring_months(spark):
    months = [(19990131, "9"), (19990228, "7"), (19990331, "5"), (19990531, "1"), (19990630, "0"), (19990731, "2")]
    streaks = transitions.declining_streaks(model_with(spark, [row(1, k, 2, growth=g) for k, g in months]))
    assert values(streaks, "DateKey", "DecliningMonths") == [
        (19990131, 0), (19990228, 1), (19990331, 2), (19990531, 0), (19990630, 1), (19990731, 0),
    ]


def test_at_risk_list(model):
    assert values(transitions.at_risk_customers(model, k=1), "CustomerID", "DecliningMonths") == [("C1", 1)]


def test_kpi_targets(model):
    kpis = {r.Measure: (r.Target, r.Status) for r in dashboards.visual(model, "executive", "kpis").collect()}
    assert kpis["churn_rate"] == (0.10, "Off target")
    assert kpis["total_customers"] == (900000.0, "Off target")
    assert set(dashboards.dashboard(model, "crm")) == set(dashboards.CRM)


def test_report_names():
    assert report_name("TotalTransactionAmount") == "Total Transaction Amt"
    assert report_name("DaysSinceLastTransaction") == "Days Since Last Transaction"
    assert report_name("MonthLabel") == "MonthLabel"

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.operators import reports, seed, staging
from ledgerloom.plans.model import load_model
from ledgerloom.plans.warehouse import TABLES, MissingTable, Warehouse, run_warehouse_load
from ledgerloom.sources import readers, sinks, workspace
from ledgerloom.sources.schemas import RAW_SCHEMA
from tests.conftest import values

SETTINGS = Settings(calendar_end=date(2017, 12, 31))
RAW = [
    (f"t{i}", f"C{i % 4}", "3/4/1980", "F", "Pune" if i % 3 else "Delhi", "50.00", f"{1 + i % 27}/{1 + i % 12}/2015", "1", "12.50")
    for i in range(60)
]


def test_seed_csv_strips_headers_and_reads_numbers_leniently(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(
        "TransactionID,CustomerID , TransactionAmount,CustAccountBalance\nt1,C1,12.5,nan\nt2,C1,x,7\nt3,C2,,\n"
    )
    seeds = readers.read_seed_csv(spark, str(tmp_path / "seed.csv"))
    assert seeds.columns == ["TransactionID", "CustomerID", "TransactionAmount", "CustAccountBalance"]
    assert values(seeds) == [("t1", "C1", 12.5, 10000.0), ("t2", "C1", 500.0, 7.0), ("t3", "C2", 500.0, 10000.0)]


def test_seed_profiles_take_the_first_known_attribute_and_cap(spark):
    rows = [("C1", 100.0, 5.0, None, "A", "d1", 1), ("C1", 1.0, 6.0, "M", "B", "d2", 2), ("C2", -5.0, 7.0, "F", "A", "d", 3)]
    schema = "CustomerID string, TransactionAmount double, CustAccountBalance double, CustGender string, CustLocation string, CustomerDOB string, n int"
    profiles = seed.seed_customer_profiles(spark.createDataFrame(rows, schema), ["n"]).cache()
    got = {r.CustomerID: r for r in profiles.collect()}
    assert got["C1"].AvgAmount == pytest.approx(10.0) and got["C2"].AvgAmount == 500.0
    assert (got["C1"].Gender, got["C1"].Location, got["C1"].StartingBalance) == ("M", "A", 5.0)
    capped = {r.CustomerID: r.AvgAmount for r in seed.cap_at_percentile(profiles, p=0.5).collect()}
    assert capped["C2"] == pytest.approx(255.0)


def test_partitioned_fact_is_replaced_and_appended(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("m"))
    assert sinks.write_fact(rows, "f", str(tmp_path), "Key", "m").count() == 100
    assert sinks.write_fact(rows, "f", str(tmp_path), "Key", "m").count() == 100
    both = sinks.append_fact(rows, "f", str(tmp_path), "Key", "m")
    assert both.count() == both.select("Key").distinct().count() == 200
    assert {p.name for p in (tmp_path / "f").iterdir() if p.is_dir()} == {"m=0", "m=1", "m=2"}


def test_rows_are_counted_while_they_pass(spark, tmp_path):
    watched, seen = sinks.observed(spark.range(42), "stage")
    sinks.write_stage(watched, str(tmp_path / "s"))
    assert seen.get == {"rows": 42}
    assert values(sinks.stage_metrics(spark, {"a": spark.range(3), "b": spark.range(4)})) == [("a", 3), ("b", 4)]


def test_schema_listing(spark):
    listing = sinks.describe_schema(spark.createDataFrame([], "a int, b decimal(18,2) not null"), "t")
    assert values(listing) == [("t", 1, "a", "int", True, 2), ("t", 2, "b", "decimal(18,2)", False, 2)]


def test_reading_raw_keeps_nine_text_columns(spark, tmp_path):
    spark.createDataFrame(RAW, RAW_SCHEMA).withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "r"))
    assert readers.read_raw(spark, str(tmp_path / "r")).schema == RAW_SCHEMA


def test_sources_are_spread_when_asked(spark):
    small = spark.range(10).coalesce(1)
    assert readers.spread(small, 6).rdd.getNumPartitions() == 6
    assert readers.spread(small, None) is small


def test_workspace_is_the_named_folder(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir", None) or workspace.shared_folder(
        spark
    ).startswith("/tmp/ledgerloom-")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    cities = spark.createDataFrame([("Pune", "Maharashtra", "West")], "CityName string, State string, Region string")
    return run_warehouse_load(spark, spark.createDataFrame(RAW, RAW_SCHEMA), cities, folder, SETTINGS)


def test_load_writes_every_table(loaded):
    counts = {r.TableName: r.TableRows for r in reports.table_counts({n: loaded.table(n) for n in TABLES}).collect()}
    assert counts["RawTransactions"] == counts["Stg_Transaction"] == counts["Fact_Transaction"] == 60
    assert (counts["Dim_Location"], counts["Dim_Segment"]) == (2, 7)
    assert loaded.table("Fact_Transaction").select("TransactionKey").distinct().count() == 60
    assert loaded.table("Fact_CustomerSnapshot").where("SegmentKey is null").count() == 0


def test_a_written_warehouse_is_read_again(spark, loaded):
    model = load_model(spark, loaded.directory, SETTINGS, current_only=True)
    assert model.snapshot.count() == loaded.table("Fact_CustomerSnapshot").count()
    assert model.dim_customer.where("not IsCurrent").count() == 0


def test_a_missing_stage_is_an_error(spark, tmp_path):
    with pytest.raises(MissingTable):
        Warehouse(spark, str(tmp_path), SETTINGS).table("Fact_Transaction")
    with pytest.raises(MissingTable):
        load_model(spark, str(tmp_path))
    with pytest.raises(KeyError):
        Warehouse(spark, str(tmp_path), SETTINGS).table("Fact")


def test_later_transactions_get_later_keys(loaded):
    fact = loaded.table("Fact_Transaction")
    last = fact.agg(F.max("TransactionKey")).first()[0]
    more = fact.limit(5).drop("TransactionKey", "ETLLoadDate", "ETLBatchID")
    grown = loaded.append_transactions(more)
    assert grown.count() == 65 and grown.where(F.col("TransactionKey") > last).count() == 5


def test_staging_flags(spark):
    rows = [("t1", "nan", None, None, " nan ", "nan", "nan", None, "nan"), (None, "C1", None, None, "X", "1", "1/1/2015", None, "1")]
    staged = staging.stage_transactions(spark.createDataFrame(rows, RAW_SCHEMA)).collect()
    assert len(staged) == 1
    only = staged[0]
    assert only.HasInvalidCustomerID and only.HasInvalidDate and only.HasInvalidAmount and only.CustLocation is None


def test_top_groups_and_the_rest(spark):
    states = spark.createDataFrame([("A", 5), ("B", 5), ("C", 3), ("D", 1), ("E", 1)], "State string, n long")
    assert values(reports.top_n_other(states, "State", "n", 2)) == [("A", 5), ("B", 5), ("C", 3), ("Other", 2)]


def test_shares_are_exact_decimals(spark):
    frame = spark.createDataFrame([("a",)] * 2 + [("b",)], "v string")
    assert values(reports.distribution(frame, "v")) == [("a", 2, Decimal("66.67")), ("b", 1, Decimal("33.33"))]


def test_settings_refuse_unknown_modes():
    with pytest.raises(ValueError):
        Settings(scd_join="nearest")
    with pytest.raises(ValueError):
        Settings(start=date(2017, 1, 1))


def test_numbers_that_are_not_finite_are_unreadable(spark):
    texts = ["Infinity", "-inf", "1e999", "nan", "x", " 2.5 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(readers.finite_number("t").alias("n"))
    assert [r.n for r in df.collect()] == [None] * 5 + [2.5, None]


def test_fact_keys_are_given_above_the_last_exchange(spark):
    rows = sinks.keyed_layout(spark.range(100).selectExpr("id", "id % 3 as m"), "Key", "m", "id", 4)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("monotonically_increasing_id") < plan.index("RebalancePartitions")
    assert rows.select("Key").distinct().count() == 100


def test_raw_transactions_move_line_items_once(spark, tmp_path, capsys):
    from checks.lake import raw_transactions

    lines = "id as l_orderkey, id as l_partkey, id as l_suppkey, 1 as l_linenumber, cast(id as decimal(18,2)) as l_extendedprice"
    spark.range(40).selectExpr(*lines.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = ("id as o_orderkey", "id % 7 as o_custkey", "cast(id as decimal(18,2)) as o_totalprice")
    spark.range(30).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(25).selectExpr("id as n_nationkey", "'N' as n_name").write.parquet(f"{tmp_path}/nation.parquet")
    raw = raw_transactions(spark, str(tmp_path))
    assert raw.count() == 30
    raw.explain()
    plan = capsys.readouterr().out
    assert "RoundRobin" not in plan  # it would sort all rows first, and the join would move them again
    assert "hashpartitioning(l_orderkey" in plan


def test_exchanges_begin_with_more_partitions_for_more_rows(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert readers.widen_exchanges(spark, 10) == 8 and spark.conf.get(key, None) is None
        assert readers.widen_exchanges(spark, 216_000_000) == 432 == readers.exchange_width(spark)
        assert readers.widen_exchanges(spark, 10) == 432
        folder = spark.range(1000).repartition("id")
        assert folder.groupBy("id").count().count() == 1000
    finally:
        spark.conf.unset(key)


def test_load_stamps_come_after_the_exchange_of_a_fact(spark, tmp_path, capsys):
    from ledgerloom.config import Settings
    from ledgerloom.plans.warehouse import Warehouse

    lake = Warehouse(spark, str(tmp_path), Settings())
    rows = spark.range(10).selectExpr("id as CustomerKey", "'2015-01' as year_month")
    stamped = lake._fact_rows(rows, batch_id=3)
    assert stamped.columns == ["TransactionKey", "CustomerKey", "year_month", "ETLLoadDate", "ETLBatchID"]
    stamped.explain()
    plan = capsys.readouterr().out
    assert {r["ETLBatchID"] for r in stamped.collect()} == {3}
    assert plan.index("ETLBatchID") < plan.index("Exchange") and "ETLBatchID" not in plan[plan.index("Exchange") :]


def test_large_exchanges_have_some_tasks_a_core(spark):
    settings = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", *readers._FEWEST)
    rows = spark.range(500_000).selectExpr("id", "uuid() as a", "uuid() as b")
    tasks = lambda df: df.repartition("id").rdd.getNumPartitions()
    try:
        spark.conf.set(settings[0], "64")
        before = tasks(rows)
        assert readers.even_tasks(spark) == 32
        assert tasks(rows) > max(before, 16)
        assert tasks(spark.range(1000)) == 1
        spark.conf.set(settings[1], "5")
        readers.even_tasks(spark)
        assert spark.conf.get(settings[1]) == "5"
    finally:
        for setting in settings:
            spark.conf.unset(setting)

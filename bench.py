"""Time the warehouse load, layer by layer, and headline queries; print one JSON line.

Load layers are timed as they are built and written. A query is timed from the call that
plans it to the last row, with its result written to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.lake import SETTINGS, city_lookup, raw_transactions, warehouse  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from checks.session import local_session  # noqa: E402
from ledgerloom.plans.warehouse import TABLES, Warehouse  # noqa: E402
from ledgerloom.sources.sinks import write_stage  # noqa: E402
from ledgerloom.sources.workspace import session_folder  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINE = (
    "stg_transaction",
    "stg_customer",
    "raw_profile",
    "seed_profiles",
    "location_history",
    "dim_customer",
    "scd2_merge",
    "fact_transaction_version_key",
    "fact_transaction_date_range",
    "scd_overlap_duplicates",
    "monthly_volume",
    "monthly_activity",
    "customer_spine",
    "merged_spine",
    "rf_scores",
    "segments_as_coded",
    "segments_range",
    "segment_distribution",
    "recency_distribution",
    "hierarchy_rollup",
    "measure_churn_rate",
    "measure_customer_growth_yoy_by_state",
    "measure_segment_share_by_state",
    "measures_with_filters",
    "trend_headline",
    "segment_migration_month",
    "transitions_per_month",
    "declining_streak",
    "churn_profile",
    "dashboard_executive_kpis",
    "dashboard_executive_segments",
    "dashboard_marketing_conversion_trend",
    "dashboard_crm_churned_by_state",
    "dq_foreign_keys",
)


SCALED_ROWS = int(os.environ.get("BENCH_ROWS", "10000000"))
PUBLISHED = {
    "stg_transaction": 92_000,
    "dim_customer": 1_280_000,
    "fact_transaction": 102_000,
    "monthly_activity": 2_200_000,
    "fact_customersnapshot": 24_400,
}


def scaled_load(spark, sf_dir: str, hot: bool) -> dict:
    """Load the given transactions so often under new customer numbers that they are 10 million.

    With ``hot`` a third of all rows belongs to one customer in one city. Rates are rows a
    second: of transactions, but of its own rows for the snapshot. The customer dimension
    has the time of its history, too.
    """
    raw = raw_transactions(spark, sf_dir)
    times = -(-SCALED_ROWS // raw.count())
    again = F.explode(F.sequence(F.lit(1), F.lit(times)))
    rows = raw.withColumn("_n", again).withColumns(
        {c: F.concat_ws("-", c, F.col("_n").cast("string")) for c in ("CustomerID", "TransactionID")}
    )
    if hot:
        in_third = F.pmod(F.xxhash64("TransactionID"), F.lit(3)) == 0
        rows = rows.withColumns(
            {
                "CustomerID": F.when(in_third, "HOT").otherwise(F.col("CustomerID")),
                "CustLocation": F.when(in_third, "HOT CITY").otherwise(F.col("CustLocation")),
            }
        )
    folder = session_folder(spark, f"bench-{'hot' if hot else 'plain'}-{os.getpid()}")
    stored = write_stage(rows.drop("_n"), f"{folder}/source")
    lake = Warehouse(spark, folder, SETTINGS, stored, city_lookup(spark, sf_dir))
    count, found, history = stored.count(), {"rows": 0}, 0.0
    start = time.perf_counter()
    for table in TABLES:
        began = time.perf_counter()
        done = lake.table(table)
        name = table.lower()
        took = time.perf_counter() - began
        if name == "location_history":
            history = took
        if name in PUBLISHED:
            took += history if name == "dim_customer" else 0.0
            rate = (done.count() if name == "fact_customersnapshot" else count) / took
            found[f"{name}_rows_per_second"] = round(rate)
            found[f"{name}_against_published"] = round(rate / PUBLISHED[name], 2)
    return {**found, "rows": count, "seconds": round(time.perf_counter() - start, 1)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock

    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    lake = warehouse(spark, sf_dir)
    for table in TABLES:
        timed(f"load_{table.lower()}", lambda: lake.table(table))
    rows = {name: lake.table(name).count() for name in ("Stg_Transaction", "Fact_Transaction", "Fact_CustomerSnapshot")}
    for name in names:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    load = sum(s for n, s in seconds.items() if n.startswith("load_"))
    total = sum(seconds.values())
    scaled = {
        f"{kind}_customer": scaled_load(spark, sf_dir, hot=kind == "hot")
        for kind in os.environ.get("BENCH_SCALED", "plain,hot").split(",")
        if kind
    }
    print(
        json.dumps(
            {
                "metric": "load and headline queries",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "load_seconds": round(load, 3),
                "rows": rows,
                "fact_rows_per_second": round(rows["Fact_Transaction"] / seconds["load_fact_transaction"]),
                "scaled": scaled,
            }
        )
    )


if __name__ == "__main__":
    main()

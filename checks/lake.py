"""The warehouse over the given tables, loaded once per session and folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from checks.raw_sql import CITY_SQL, RAW_SQL
from ledgerloom.config import Settings
from ledgerloom.plans.model import Model, model_of
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources.readers import even_tasks, widen_exchanges
from ledgerloom.sources.workspace import session_folder

SETTINGS = Settings(
    start=date(1998, 1, 1),
    cutoff=date(1999, 8, 31),
    calendar_start=date(1998, 1, 1),
    calendar_end=date(2000, 12, 31),
    as_of=date(2016, 8, 31),
    seed=42,
)

_warehouses: dict[tuple[str, str], Warehouse] = {}
_models: dict[int, Model] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: given(spark, sf_dir, name) for name in ("lineitem", "orders", "nation")}
    # the exchange of the join spreads the rows of a file that one task reads; dealing them out before would move and sort them twice
    tables["orders"] = tables["orders"].hint("merge")
    return spark.sql(RAW_SQL, **tables)


def city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CITY_SQL, nation=given(spark, sf_dir, "nation"), region=given(spark, sf_dir, "region"))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The loaded warehouse; tables are built when first asked for, and then read."""
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        # the JVM never compiles methods above 8000 bytes: rather split such a stage up
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        widen_exchanges(spark, given(spark, sf_dir, "lineitem").count())
        even_tasks(spark)
        folder = session_folder(spark, f"warehouse-{len(_warehouses)}")
        _warehouses[key] = Warehouse(
            spark, folder, SETTINGS, raw_transactions(spark, sf_dir), city_lookup(spark, sf_dir), land_raw=True
        )
    return _warehouses[key]


def model(spark: SparkSession, sf_dir: str) -> Model:
    lake = warehouse(spark, sf_dir)
    if id(lake) not in _models:
        _models[id(lake)] = model_of(lake)
    return _models[id(lake)]

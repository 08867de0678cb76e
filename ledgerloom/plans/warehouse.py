"""The warehouse: each table is built from the ones before it, written, and read back.

Writing every layer keeps plans short, lets later layers use file sizes and partitions,
and means that a lost executor costs the tasks of one layer only. A load or batch becomes
visible as a whole, by the manifest that it writes last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Settings
from ledgerloom.functions.calendar import build_dim_date
from ledgerloom.operators.dimensions import (
    build_dim_customer,
    build_dim_location,
    customer_rows,
    location_history,
    location_rows,
    merged_history,
)
from ledgerloom.operators.facts import build_fact_transaction
from ledgerloom.operators.keys import with_kept_keys
from ledgerloom.operators.scd2 import window_gains
from ledgerloom.operators.snapshot import build_snapshot, monthly_activity
from ledgerloom.operators.staging import stage_customers, stage_locations, stage_transactions
from ledgerloom.sources.readers import exchange_width, segment_rules
from ledgerloom.sources.sinks import keyed_layout, load_stamped, snapshot_rows
from ledgerloom.sources.versions import Change, TableStore, fingerprint

TABLES = (
    "RawTransactions",
    "City_Lookup",
    "Stg_Transaction",
    "Stg_Customer",
    "Stg_Location",
    "Dim_Date",
    "Dim_Segment",
    "Dim_Location",
    "Location_History",
    "Dim_Customer",
    "Fact_Transaction",
    "Monthly_Activity",
    "Fact_CustomerSnapshot",
)
INDEPENDENT = ("Stg_Transaction", "Stg_Customer", "Stg_Location", "City_Lookup", "Dim_Date", "Dim_Segment")


class MissingTable(RuntimeError):
    """A stage was asked for before the stage it needs."""


class Warehouse:
    """Tables of one load below one directory.

    With ``raw`` and ``city_lookup`` a table is built the first time it is asked for,
    together with what it needs; :meth:`load` builds all and makes them the version that
    others read. Without them the warehouse reads the version that was the latest when it
    was opened, and a table that is not in it is an error. The raw table is read where it
    is stored; ``land_raw`` copies one that would be costly to read again. ``rules`` takes
    the place of the usual segment rules; those without a start hold from the day of the load.
    """

    def __init__(
        self,
        spark: SparkSession,
        directory: str,
        settings: Settings,
        raw: DataFrame | None = None,
        city_lookup: DataFrame | None = None,
        land_raw: bool = False,
        rules: DataFrame | None = None,
    ) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.settings = settings
        self.store = TableStore(spark, directory)
        self._raw = raw
        self._city_lookup = city_lookup
        self._land_raw = land_raw
        self._rules = rules
        self._change = self.store.begin(f"load{uuid.uuid4().hex}") if raw is not None else None
        self._manifest = self.store.latest()
        self._tables: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "RawTransactions": self._raw_transactions,
            "City_Lookup": lambda: self._write("City_Lookup", self._source("city_lookup", self._city_lookup)),
            "Stg_Transaction": lambda: self._stage("Stg_Transaction", stage_transactions),
            "Stg_Customer": lambda: self._stage("Stg_Customer", stage_customers),
            "Stg_Location": lambda: self._stage("Stg_Location", stage_locations),
            "Dim_Date": self._dim_date,
            "Dim_Segment": self._dim_segment,
            "Dim_Location": self._dim_location,
            "Location_History": self._location_history,
            "Dim_Customer": self._dim_customer,
            "Fact_Transaction": self._fact_transaction,
            "Monthly_Activity": self._monthly_activity,
            "Fact_CustomerSnapshot": self._snapshot,
        }

    def table(self, name: str) -> DataFrame:
        if name not in self._builders:
            raise KeyError(name)
        if name not in self._tables:
            self._tables[name] = self._builders[name]() if self._change is not None else self._stored(name)
        return self._tables[name]

    def load(self) -> dict[str, DataFrame]:
        """Build all tables and commit them, or read all. Those that need only the sources are built at the same time."""
        if self._change is None:
            return {name: self.table(name) for name in TABLES if name != "RawTransactions" or self._has_raw()}
        self.table("RawTransactions")
        with ThreadPoolExecutor(len(INDEPENDENT)) as together:
            list(together.map(self.table, INDEPENDENT))
        tables = {name: self.table(name) for name in TABLES}
        self._manifest, self._change = self._change.commit(restart=True), None
        return tables

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}"

    def _has_raw(self) -> bool:
        return self._raw is not None or "RawTransactions" in self._manifest.tables

    def _source(self, name: str, df: DataFrame | None) -> DataFrame:
        if df is None:
            raise MissingTable(f"{name} is needed to build this warehouse")
        return df

    def _stored(self, name: str) -> DataFrame:
        if name == "RawTransactions" and self._raw is not None and name not in self._manifest.tables:
            return self._raw
        if name not in self._manifest.tables:
            raise MissingTable(f"{name} not found in {self.directory}: run the step that loads it first")
        return self.store.read(name, self._manifest.tables[name])

    def _write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        return self._change.write(name, lambda: df, partition_by)

    def _stage(self, name: str, flow: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return self._write(name, flow(self.table("RawTransactions")).withColumn("LoadDate", F.current_timestamp()))

    def _raw_transactions(self) -> DataFrame:
        raw = self._source("raw", self._raw)
        return self._write("RawTransactions", raw) if self._land_raw else raw

    def _slices(self) -> int:
        """Groups per month such that all months together fill the partitions of an exchange."""
        first, last = self.settings.start, self.settings.cutoff
        months = (last.year - first.year) * 12 + last.month - first.month + 1
        return max(1, exchange_width(self.spark) // months)

    def _dim_date(self) -> DataFrame:
        s = self.settings
        days = build_dim_date(self.spark, s.calendar_start, s.calendar_end, s.as_of).coalesce(1)
        return self._write("Dim_Date", days.withColumn("CreatedDate", F.current_timestamp()))

    def _dim_segment(self) -> DataFrame:
        stamps = {
            "StartDate": F.coalesce("StartDate", F.current_date()),
            "CreatedDate": F.current_timestamp(),
            "ModifiedDate": F.lit(None).cast("timestamp"),
        }
        rules = segment_rules(self.spark) if self._rules is None else self._rules
        return self._write("Dim_Segment", rules.coalesce(1).withColumns(stamps))

    def _dim_location(self) -> DataFrame:
        return self._write("Dim_Location", build_dim_location(self.table("Stg_Location"), self.table("City_Lookup")))

    def _location_history(self) -> DataFrame:
        return self._write("Location_History", location_history(self.table("Stg_Transaction")))

    def _dim_customer(self) -> DataFrame:
        history, people, places = (self.table(n) for n in ("Location_History", "Stg_Customer", "Dim_Location"))
        return self._write("Dim_Customer", build_dim_customer(history, people, places, self.settings))

    def _fact_transaction(self) -> DataFrame:
        fact = build_fact_transaction(
            self.table("Stg_Transaction"),
            self.table("Dim_Customer"),
            self.table("Dim_Date"),
            self.table("Dim_Location"),
            self.settings.scd_join,
        )
        return self._write("Fact_Transaction", self._fact_rows(fact), "year_month")

    def _fact_rows(self, rows: DataFrame, after: int = -1, batch_id: int | None = None) -> DataFrame:
        """Rows as they are written; stamps come last, so that no exchange carries them."""
        return load_stamped(keyed_layout(rows, "TransactionKey", "year_month", "CustomerKey", self._slices(), after), batch_id)

    def _monthly_activity(self) -> DataFrame:
        return self._write("Monthly_Activity", monthly_activity(self.table("Fact_Transaction"), self.settings.cutoff))

    def _snapshot(self) -> DataFrame:
        return self._write("Fact_CustomerSnapshot", self._snapshot_rows(self.staged_snapshot()), "DateKey")

    def _snapshot_rows(self, staged: DataFrame) -> DataFrame:
        return keyed_layout(snapshot_rows(staged), "SnapshotKey", "DateKey", "CustomerKey", self._slices())

    def staged_snapshot(self) -> DataFrame:
        """The scored customer-months before they are written, with CustomerID."""
        return self._scored(self.table)

    def _scored(self, table: Callable[[str], DataFrame]) -> DataFrame:
        sources = [table(n) for n in ("Monthly_Activity", "Dim_Customer", "Dim_Date", "Dim_Segment")]
        return build_snapshot(*sources, self.settings)

    def apply_batch(
        self, raw_batch: DataFrame, batch_id: int | None = None, after_step: Callable[[str], None] | None = None
    ) -> dict[str, DataFrame]:
        """Load a batch of raw transactions on top of what is there, as if all had come at once.

        All tables change together, when the last step is done. A batch with an id that the
        warehouse holds already is left alone if its rows are the same, and is an error if
        they are not; one that was stopped goes on after its last finished step. Without an
        id a batch takes the next free one, and is new however often it is given. Facts carry
        the id as ``ETLBatchID``. ``after_step`` is called with the name of each written table.

        The batch alone is staged and joined to the dimensions. Its location history is
        merged into the stored one, from which the customer versions follow; versions and
        locations that were there keep their keys. Under ``date_range`` older transactions
        gain the versions whose windows have come to hold them: these are the transactions
        on days by which a window grew, and no others are joined again. Windows never lose a
        day that has a transaction, as history only adds days. Monthly activity is summed
        again for the months that new facts touch, and the snapshot is built from the
        activity, as a customer's later months depend on all earlier ones.
        """
        self.load()
        latest, digest = self.store.latest(), fingerprint(raw_batch)
        number = max([0, *map(int, latest.batches)]) + 1 if batch_id is None else batch_id
        known = latest.batches.get(str(number))
        if known is not None and known != digest:
            raise ValueError(f"batch {number} was loaded before with other rows")
        if known is None:
            change = self.store.begin(f"batch{number}-{digest}", after_step)
            self._batch_steps(change, raw_batch, number)
            latest = change.commit((str(number), digest))
        self._manifest, self._tables = latest, {}
        return self.load()

    def _batch_steps(self, change: Change, raw_batch: DataFrame, number: int) -> None:
        stamp, s = F.current_timestamp(), self.settings
        stamped = lambda df: df.withColumns({"CreatedDate": stamp, "ModifiedDate": stamp})
        like = lambda df, name: df.select(*change.before(name).columns)
        if "RawTransactions" in change.base.tables:
            change.write("RawTransactions", lambda: like(raw_batch, "RawTransactions"), append=True)

        def staged(name: str, flow: Callable[[DataFrame], DataFrame], distinct: bool) -> None:
            rows = flow(raw_batch)
            if distinct:
                rows = rows.subtract(change.before(name).select(*rows.columns))
            change.write(name, lambda: like(rows.withColumn("LoadDate", stamp), name), append=True)

        staged("Stg_Transaction", stage_transactions, distinct=False)
        staged("Stg_Customer", stage_customers, distinct=True)
        staged("Stg_Location", stage_locations, distinct=True)
        transactions = change.added("Stg_Transaction")

        places = change.scratch("Batch_Places", lambda: location_rows(change.table("Stg_Location"), change.table("City_Lookup")))
        change.write(
            "Dim_Location",
            lambda: stamped(with_kept_keys(places, change.before("Dim_Location"), "LocationKey", ["LocationCode"])),
        )
        change.write("Location_History", lambda: merged_history(change.before("Location_History"), location_history(transactions)))

        def customers() -> DataFrame:
            dated = change.table("Location_History").where(F.col("LocStartDate").isNotNull())
            keyed = with_kept_keys(dated, change.before("Dim_Customer"), "CustomerKey", ["CustomerID", "LocationMatch"])
            rows = customer_rows(keyed, change.table("Stg_Customer"), change.table("Dim_Location"), s, counted=dated)
            return like(stamped(rows), "Dim_Customer")

        change.write("Dim_Customer", customers)
        dims = [change.table(n) for n in ("Dim_Customer", "Dim_Date", "Dim_Location")]
        fact = change.scratch("Batch_Fact", lambda: self._batch_fact(change, transactions, dims))

        def further_facts() -> DataFrame:
            last = change.before("Fact_Transaction").agg(F.coalesce(F.max("TransactionKey"), F.lit(-1))).first()[0]
            return like(self._fact_rows(fact, last, number), "Fact_Transaction")

        change.write("Fact_Transaction", further_facts, "year_month", append=True)

        def activity() -> DataFrame:
            touched = [r[0] for r in fact.select("year_month").distinct().collect()]  # months of the calendar
            in_touched = F.col("year_month").isin(*touched) if touched else F.lit(False)
            again = monthly_activity(change.table("Fact_Transaction").where(in_touched), s.cutoff)
            kept = ~F.date_format("MonthEndDate", "yyyy-MM").isin(*touched) if touched else F.lit(True)
            return change.before("Monthly_Activity").where(kept).unionByName(again)

        change.write("Monthly_Activity", activity)
        change.write("Fact_CustomerSnapshot", lambda: self._snapshot_rows(self._scored(change.table)), "DateKey")

    def _batch_fact(self, change: Change, transactions: DataFrame, dims: list[DataFrame]) -> DataFrame:
        """Fact rows of the batch's transactions, and those that older ones gain."""
        fact = build_fact_transaction(transactions, *dims, self.settings.scd_join)
        if self.settings.scd_join != "date_range":
            return fact
        gains = change.scratch(
            "Batch_Gains", lambda: window_gains(change.before("Dim_Customer"), dims[0], transactions.select("CustomerID"))
        )
        first, last = gains.agg(F.min("StartDate"), F.max("EndDate")).first()
        if first is None:
            return fact
        # the days of all gains as one range: files and row groups of other days are not read
        inside = F.col("TransactionDay").between(F.lit(first), F.lit(last))
        older = change.before("Stg_Transaction").where(inside)
        return fact.unionByName(build_fact_transaction(older, *dims, "date_range", windows=gains))

    def append_transactions(self, fact_rows: DataFrame) -> DataFrame:
        """Add fact rows of a later batch, with keys above the present ones."""
        self.load()
        change = self.store.begin(f"facts{uuid.uuid4().hex}")
        before = change.before("Fact_Transaction")
        last = before.agg(F.coalesce(F.max("TransactionKey"), F.lit(-1))).first()[0]
        rows = self._fact_rows(fact_rows, last).select(*before.columns)
        change.write("Fact_Transaction", lambda: rows, "year_month", append=True)
        self._manifest, self._tables = change.commit(), {}
        return self.table("Fact_Transaction")


def run_warehouse_load(
    spark: SparkSession,
    raw: DataFrame,
    city_lookup: DataFrame,
    directory: str,
    settings: Settings,
    land_raw: bool = False,
) -> Warehouse:
    """Load every table from raw transactions and return the loaded warehouse."""
    warehouse = Warehouse(spark, directory, settings, raw, city_lookup, land_raw)
    warehouse.load()
    return warehouse

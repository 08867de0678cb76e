"""Registered queries: a Spark frame, and the DuckDB statement it must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.lake import SETTINGS, model, warehouse
from checks.oracle import _activity as _activity_sql
from checks.oracle import _clean, _code, _dmy, _merged, _money, _pct, sql
from checks.oracle import _spine as _spine_sql
from ledgerloom.functions import calendar, cleanse
from ledgerloom.operators import dimensions, facts, quality, reports, scd2, seed, segments, snapshot, staging
from ledgerloom.plans import dashboards, levels, measures, transitions
from ledgerloom.plans.model import report_view, snapshot_wide
from ledgerloom.plans.warehouse import Warehouse
from ledgerloom.sources.readers import read_raw, read_seed_csv, sample_rows
from ledgerloom.sources.sinks import stage_metrics
from ledgerloom.sources.workspace import session_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, select: str | None = None, **steps: str) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = query
    if select is not None:
        ORACLES[name] = sql(select, **steps)


def on(table: str, then: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over one warehouse table."""
    return lambda spark, sf_dir: then(warehouse(spark, sf_dir).table(table))


def on_model(then: Callable) -> Query:
    return lambda spark, sf_dir: then(model(spark, sf_dir))


# ---------------------------------------------------------------- raw and staging

def _raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = warehouse(spark, sf_dir).table("RawTransactions")  # written on first use
    path = session_folder(spark, f"raw-{uuid.uuid4().hex}")
    raw.write.parquet(path)
    return read_raw(spark, path)


add(
    "raw_scan",
    _raw_scan,
    """select TransactionID, CustomerID, CustomerDOB, CustGender, CustLocation, CustAccountBalance,
              TransactionDate, TransactionTime, TransactionAmount from raw""",
)
add(
    "raw_profile",
    on("RawTransactions", reports.profile_raw),
    "select count(*) as TotalRows, "
    + ", ".join(
        f"count(*) filter (where {c} is null or {c} = 'nan') as {a}" for a, c in reports.PROFILED_COLUMNS.items()
    )
    + f""", count(distinct CustomerID) as UniqueCustomers, min(TransactionDate) as MinDate, max(TransactionDate) as MaxDate,
      min({_dmy('TransactionDate')}) as MinParsedDate, max({_dmy('TransactionDate')}) as MaxParsedDate from raw""",
)
add(
    "approximate_customers",
    # beside the exact count, as an estimate has no one right value: it is off by 5 % at most
    on(
        "RawTransactions",
        lambda raw: raw.agg(F.countDistinct("CustomerID").alias("Customers")).select(
            "Customers",
            (
                F.abs(reports.approximate_customers(raw).scalar() - F.col("Customers")) <= F.col("Customers") * 0.05
            ).alias("WithinFivePercent"),
        ),
    ),
    "select count(distinct CustomerID) as Customers, true as WithinFivePercent from raw",
)
_NUM = "case when not isnan(try_cast({0} as double)) then try_cast({0} as double) end"
add(
    "source_check",
    on(
        "RawTransactions",
        lambda raw: seed.verify_source(raw).withColumns(
            {c: F.round(c, 4) for c in ("AvgAmount", "MaxAmount", "AvgBalance", "MinBalance")}
        ),
    ),
    f"""select min(TransactionDate) as MinDate, max(TransactionDate) as MaxDate, min({_dmy('TransactionDate')}) as MinParsedDate,
      max({_dmy('TransactionDate')}) as MaxParsedDate, count(*) as TotalRows, count(distinct CustomerID) as UniqueCustomers,
      count(distinct CustLocation) as UniqueLocations, round(avg({_NUM.format('TransactionAmount')}), 4) as AvgAmount,
      round(max({_NUM.format('TransactionAmount')}), 4) as MaxAmount,
      round(avg({_NUM.format('CustAccountBalance')}), 4) as AvgBalance,
      round(min({_NUM.format('CustAccountBalance')}), 4) as MinBalance from raw""",
)
add(
    "raw_sample",
    on("RawTransactions", lambda raw: sample_rows(raw, 10, ["TransactionID", "TransactionDate"])),
    """select TransactionID, CustomerID, CustomerDOB, CustGender, CustLocation, CustAccountBalance,
              TransactionDate, TransactionTime, TransactionAmount from raw order by TransactionID, TransactionDate limit 10""",
)
add(
    "time_of_day",
    on(
        "RawTransactions",
        lambda raw: reports.distribution(
            raw.select(cleanse.time_of_day(F.col("TransactionTime")).alias("TimeOfDay")), "TimeOfDay"
        ),
    ),
    f"""select TimeOfDay, Records, {_pct('Records', 'Total')} as Pct from (
      select TimeOfDay, count(*) as Records, cast(sum(count(*)) over () as bigint) as Total from (
        select case when h between 6 and 11 then 'Morning' when h between 12 and 17 then 'Afternoon'
                    when h between 18 and 21 then 'Evening' when h is not null then 'Night' end as TimeOfDay
        from (select cast(TransactionTime as integer) // 10000 as h from raw)) group by 1)""",
)


def _seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table as a CSV seed, written once per load and read back leniently."""
    lake = warehouse(spark, sf_dir)
    path = lake.path("seed_csv")
    if path not in _seeds_written:
        lake.table("RawTransactions").write.mode("overwrite").csv(path, header=True)
        _seeds_written.add(path)
    return read_seed_csv(spark, path)


_seeds_written: set[str] = set()
_SEED_STEP = """
select TransactionID, CustomerID, CustomerDOB, CustGender, trim(CustLocation) as CustLocation,
       coalesce(case when not isnan(try_cast(CustAccountBalance as double)) then try_cast(CustAccountBalance as double) end, 10000.0) as CustAccountBalance,
       TransactionDate, TransactionTime,
       coalesce(case when not isnan(try_cast(TransactionAmount as double)) then try_cast(TransactionAmount as double) end, 500.0) as TransactionAmount
from raw"""
add(
    "seed_csv",
    lambda s, d: _seed(s, d).withColumn("CustLocation", F.trim("CustLocation")).withColumn("CustGender", F.trim("CustGender")),
    "select * replace (trim(CustGender) as CustGender) from seed",
    seed=_SEED_STEP,
)


def _seed_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = seed.build_seed_profiles(
        _seed(spark, sf_dir).withColumn("CustLocation", F.trim("CustLocation")),
        ["TransactionID", "TransactionDate", "TransactionTime", "TransactionAmount"],
        name=f"seed_profiles-{abs(hash(sf_dir))}",
    )
    return profiles.withColumn("AvgAmount", F.round("AvgAmount", 4)).withColumn("Gender", F.trim("Gender"))


_ORDER = "row(TransactionID, TransactionDate, TransactionTime, TransactionAmount)"
add(
    "seed_profiles",
    _seed_profiles,
    """select CustomerID, round(least(m, (select quantile_cont(m, 0.99) from p)), 4) as AvgAmount, StartingBalance,
              trim(Gender) as Gender, Location, DOB from p""",
    seed=_SEED_STEP,
    p=f"""select CustomerID, coalesce(exp(avg(ln(TransactionAmount)) filter (where TransactionAmount > 0)), 500.0) as m,
       arg_min(CustAccountBalance, {_ORDER}) as StartingBalance,
       arg_min(CustGender, {_ORDER}) filter (where CustGender is not null) as Gender,
       arg_min(CustLocation, {_ORDER}) filter (where CustLocation is not null) as Location,
       arg_min(CustomerDOB, {_ORDER}) filter (where CustomerDOB is not null) as DOB
       from seed where CustomerID is not null group by CustomerID""",
)
add(
    "seed_locations",
    lambda s, d: seed.distinct_locations(_seed(s, d).withColumn("CustLocation", F.trim("CustLocation"))),
    "select distinct trim(CustLocation) as CustLocation from raw where CustLocation is not null",
)
add(
    "stg_transaction",
    on("RawTransactions", staging.stage_transactions),
    f"""select *, {_dmy('TransactionDate')} as TransactionDay, CustomerID is null as HasInvalidCustomerID,
              TransactionDate is null as HasInvalidDate, TransactionAmount is null as HasInvalidAmount from stg_transaction""",
)
add(
    "stg_customer",
    on("RawTransactions", staging.stage_customers),
    f"""select *, CustomerID is null as HasInvalidCustomerID, Location is null as HasInvalidLocation, DOB is null as HasInvalidDOB,
               case when Location is not null and Location <> 'nan' then {_code('Location')} end as LocationCode
        from stg_customer""",
)
add("stg_location", on("RawTransactions", staging.stage_locations), "select * from stg_location")
add(
    "flag_counts",
    on("Stg_Transaction", reports.flag_counts),
    """select CustomerID is null as HasInvalidCustomerID, TransactionDate is null as HasInvalidDate,
              TransactionAmount is null as HasInvalidAmount, count(*) as RecordCount from stg_transaction group by 1, 2, 3""",
)
add(
    "parsed_values",
    on(
        "Stg_Transaction",
        lambda t: t.select(
            "TransactionID",
            cleanse.parse_dmy(F.col("TransactionDate")).alias("ParsedDate"),
            calendar.date_key(cleanse.parse_dmy(F.col("TransactionDate"))).alias("ParsedKey"),
            cleanse.parse_money(F.col("TransactionAmount")).alias("Amount"),
            cleanse.parse_money(F.col("AccountBalance")).alias("Balance"),
            cleanse.location_code(F.col("CustLocation")).alias("LocationCode"),
        ),
    ),
    f"""select TransactionID, {_dmy('TransactionDate')} as ParsedDate,
        cast(year({_dmy('TransactionDate')}) * 10000 + month({_dmy('TransactionDate')}) * 100 + day({_dmy('TransactionDate')}) as integer) as ParsedKey,
        {_money('TransactionAmount')} as Amount, {_money('AccountBalance')} as Balance, {_code('CustLocation')} as LocationCode
        from stg_transaction""",
)
add(
    "recency_distribution",
    on("RawTransactions", lambda raw: reports.recency_distribution(raw, SETTINGS.cutoff)),
    f"""select case when n <= 30 then '0-30 days (Active)' when n <= 60 then '31-60 days (Watch)'
                   when n <= 90 then '61-90 days (AtRisk)' else '90+ days (Churned)' end as RecencyBucket, count(*) as CustomerCount
        from (select datediff('day', max({_dmy('TransactionDate')}), date '1999-08-31') as n from raw
              where {_clean('CustomerID')} is not null group by upper({_clean('CustomerID')})) group by 1""",
)

# ---------------------------------------------------------------- dimensions


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension of the years that the transactions touch."""
    staged = warehouse(spark, sf_dir).table("Stg_Transaction")
    return calendar.with_calendar_columns(calendar.whole_years_of(staged, "TransactionDay"), date(1999, 8, 31))


_CALENDAR_STEP = f"""
select cast(g.d as date) as Date, g.d as ts from
  (select date_trunc('year', min({_dmy('TransactionDate')})) as lo,
          date_trunc('year', max({_dmy('TransactionDate')})) + interval 1 year - interval 1 day as hi from stg_transaction) b,
  generate_series(cast(b.lo as timestamp), cast(b.hi as timestamp), interval 1 day) g(d)"""
_SUNDAY_FIRST = "(dayofweek({0}) + 1)"  # DuckDB counts Sunday as 0
add(
    "dim_date",
    lambda s, d: calendar.with_month_label(_calendar(s, d)),
    f"""select cast(year(Date) * 10000 + month(Date) * 100 + day(Date) as integer) as DateKey, ts as FullDateTime, Date,
      cast(year(Date) as integer) as Year, cast(year(Date) as varchar) as YearName, cast(quarter(Date) as integer) as Quarter,
      'Q' || quarter(Date) as QuarterName, year(Date) || '-Q' || quarter(Date) as YearQuarter, cast(month(Date) as integer) as Month,
      monthname(Date) as MonthName, left(monthname(Date), 3) as MonthNameShort, strftime(Date, '%Y-%m') as YearMonth,
      year(Date) || ' ' || monthname(Date) as YearMonthName, cast(day(Date) as integer) as Day,
      cast(isodow(Date) as integer) as DayOfWeek, dayname(Date) as DayName, left(dayname(Date), 3) as DayNameShort,
      cast(dayofyear(Date) as integer) as DayOfYear,
      cast((dayofyear(Date) + {_SUNDAY_FIRST.format("date_trunc('year', Date)")} - 2) // 7 + 1 as integer) as WeekOfYear,
      cast((day(Date) + {_SUNDAY_FIRST.format("date_trunc('month', Date)")} - 2) // 7 + 1 as integer) as WeekOfMonth,
      cast(case when month(Date) >= 4 then year(Date) else year(Date) - 1 end as integer) as FiscalYear,
      cast(case when month(Date) in (4, 5, 6) then 1 when month(Date) in (7, 8, 9) then 2
           when month(Date) in (10, 11, 12) then 3 else 4 end as integer) as FiscalQuarter,
      cast(case when month(Date) >= 4 then month(Date) - 3 else month(Date) + 9 end as integer) as FiscalMonth,
      '00:00:00' as "Time", 0 as "Hour", '00:00' as HourName, 0 as "Minute", 'Night' as TimeOfDay,
      isodow(Date) >= 6 as IsWeekend, false as IsHoliday, isodow(Date) < 6 as IsWorkingDay,
      Date = date '1999-08-31' as IsToday, Date = date '1999-08-30' as IsYesterday,
      year(Date) = 1999 and month(Date) = 8 as IsCurrentMonth, year(Date) = 1999 and quarter(Date) = 3 as IsCurrentQuarter,
      year(Date) = 1999 as IsCurrentYear, strftime(Date, '%b-%y') as MonthLabel,
      cast(year(Date) * 100 + month(Date) as integer) as MonthSort from days""",
    days=_CALENDAR_STEP,
)
add(
    "dim_date_stats",
    lambda s, d: calendar.date_statistics(_calendar(s, d)),
    """select min(Date) as MinDate, max(Date) as MaxDate, count(*) as TotalDays,
              count(*) filter (where isodow(Date) >= 6) as TotalWeekends,
              count(*) filter (where isodow(Date) < 6) as TotalWorkingDays from days""",
    days=_CALENDAR_STEP,
)
_LOCATION_COLUMNS = """LocationCode, LocationName, LocationName as City, State, 'India' as Country, Region,
    cast(null as decimal(10,7)) as Latitude, cast(null as decimal(10,7)) as Longitude, 'City' as LocationType"""
add(
    "dim_location",
    lambda s, d: dimensions.location_rows(
        warehouse(s, d).table("Stg_Location"), warehouse(s, d).table("City_Lookup")
    ),
    f"select {_LOCATION_COLUMNS} from dim_location",
)
add(
    "locations_by_state",
    on("Dim_Location", lambda t: reports.distribution(t, "State", count="LocationCount")),
    f"""select State, LocationCount, {_pct('LocationCount', 'Total')} as Pct from
        (select State, count(*) as LocationCount, cast(sum(count(*)) over () as bigint) as Total from dim_location group by State)""",
)
add(
    "location_history",
    on("Stg_Transaction", dimensions.location_history),
    "select CustomerID, Location, LocationMatch, LocStartDate, LocEndDate, DatedRows from location_history",
)
add(
    "customer_demographics",
    on("Stg_Customer", dimensions.customer_demographics),
    "select * from demographics",
)
add("scd2_versions", on("Location_History", lambda h: dimensions.scd2_versions(h).drop("DatedRows")), "select * from versions")
_CUSTOMER_COLUMNS = """CustomerID, DateOfBirth, Age, AgeGroup, Gender, Location, LocationCode, CustomerType,
    FirstTransactionDate, StartDate, EndDate, IsCurrent, FirstTransactionDateEver"""


def _customers(settings) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = warehouse(spark, sf_dir)
        places = lake.table("Dim_Location")
        rows = dimensions.customer_rows(lake.table("Location_History"), lake.table("Stg_Customer"), places, settings)
        named = rows.join(places.select("LocationKey", "LocationCode"), "LocationKey", "left")
        return named.select(*[c.strip() for c in _CUSTOMER_COLUMNS.split(",")])

    return build


add("dim_customer", _customers(SETTINGS), f"select {_CUSTOMER_COLUMNS} from dim_customer")
add(
    "dim_customer_other_modes",
    _customers(
        replace(SETTINGS, dob_policy="default_1900", age_mode="as_coded", customer_type_mode="documented")
    ),
    f"select {_CUSTOMER_COLUMNS} from dim_customer_other",
)
add(
    "customer_keys",
    on(
        "Dim_Customer",
        lambda t: t.agg(
            F.count(F.lit(1)).alias("Customers"),
            F.countDistinct("CustomerKey").alias("Keys"),
            F.min("CustomerKey").alias("FirstKey"),
            F.max("CustomerKey").alias("LastKey"),
        ),
    ),
    "select count(*) as Customers, count(*) as Keys, cast(1 as bigint) as FirstKey, count(*) as LastKey from dim_customer",
)
add(
    "scd_version_counts",
    on("Dim_Customer", scd2.scd_version_counts),
    "select CustomerID, count(*) as VersionCount from dim_customer group by CustomerID having count(*) > 1",
)
add(
    "scd_version_histogram",
    on("Dim_Customer", scd2.scd_version_histogram),
    """select VersionCount, count(*) as Customers from
       (select count(*) as VersionCount from dim_customer group by CustomerID) group by VersionCount""",
)
_MERGE_DATE = date(1999, 9, 1)
_MERGE_COLUMNS = "CustomerID, Location, Gender, AgeGroup, StartDate, EndDate, IsCurrent"


def _merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which every customer reports the location of the next customer number,
    one in three keeps its own, and as many new customers appear again."""
    dim = warehouse(spark, sf_dir).table("Dim_Customer").select("CustomerKey", *_MERGE_COLUMNS.split(", "))
    number = F.substring("CustomerID", 2, 20).cast("bigint")
    current = dim.where("IsCurrent").withColumn("n", number)
    same = current.select(
        "CustomerID",
        F.when(F.col("n") % 3 == 0, F.col("Location")).otherwise(F.concat(F.lit("BRANCH "), F.col("n") % 50)).alias("Location"),
        F.lit("Unknown").alias("Gender"),
        "AgeGroup",
    )
    fresh = current.select(
        F.concat(F.lit("N"), F.col("n").cast("string")).alias("CustomerID"), "Location", "Gender", "AgeGroup"
    )
    merged = scd2.scd2_merge(
        dim,
        same.unionByName(fresh),
        "CustomerID",
        tracked=["Location"],
        type1=["Gender", "AgeGroup"],
        eff_date=_MERGE_DATE,
    )
    return merged.select(*_MERGE_COLUMNS.split(", "), F.col("CustomerKey").isNull().alias("IsNewRow"))


add(
    "scd2_merge",
    _merge,
    f"""select {_MERGE_COLUMNS}, false as IsNewRow from dim_customer where not IsCurrent
        union all
        select CustomerID, Location, case when moved then Gender else 'Unknown' end, AgeGroup, StartDate,
               case when moved then date '1999-08-31' end, not moved, false from u
        union all
        select CustomerID, NewLocation, 'Unknown', AgeGroup, date '1999-09-01', null, true, true from u where moved
        union all
        select 'N' || cast(n as varchar), Location, Gender, AgeGroup, date '1999-09-01', null, true, true from u""",
    u="""select *, NewLocation <> Location as moved from (select *, case when n % 3 = 0 then Location
         else 'BRANCH ' || cast(n % 50 as varchar) end as NewLocation from
         (select *, cast(substr(CustomerID, 2) as bigint) as n from dim_customer where IsCurrent))""",
)
add(
    "customer_summary",
    on("Dim_Customer", reports.customer_summary),
    """select count(*) as TotalRecords, count(distinct CustomerID) as UniqueCustomers,
       count(*) filter (where IsCurrent) as CurrentRecords, count(*) filter (where not IsCurrent) as HistoricalRecords from dim_customer""",
)
add(
    "customer_quality",
    on("Dim_Customer", reports.customer_quality),
    """select count(*) filter (where DateOfBirth is null) as MissingDOB, count(*) filter (where Age is null or Age = 0) as MissingAge,
       count(*) filter (where Gender = 'Unknown') as UnknownGender, count(*) filter (where LocationCode is null) as MissingLocation,
       count(*) filter (where AgeGroup = 'Unknown') as UnknownAgeGroup from dim_customer where IsCurrent""",
)


def _share(column: str, source: str, count: str, tail: str = "") -> str:
    return f"""select {column}, {count}, {_pct(count, 'Total')} as Pct from (select {column}, count(*) as {count},
        cast(sum(count(*)) over () as bigint) as Total from {source} group by {column}) {tail}"""


for _name, _column in (("age_distribution", "AgeGroup"), ("gender_distribution", "Gender")):
    add(
        _name,
        on("Dim_Customer", lambda t, c=_column: reports.distribution(t.where("IsCurrent"), c, count="CustomerCount")),
        _share(_column, "dim_customer where IsCurrent", "CustomerCount"),
    )
add(
    "top_locations",
    on("Dim_Customer", lambda t: reports.distribution(t.where("IsCurrent"), "Location", count="CustomerCount", top=10)),
    _share("Location", "dim_customer where IsCurrent", "CustomerCount", "order by CustomerCount desc, Location limit 10"),
)

# ---------------------------------------------------------------- transaction fact


def _fact(mode: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Facts named by what their keys stand for."""
        return _named(_fact_rows(spark, sf_dir, mode), warehouse(spark, sf_dir))

    return build


def _fact_rows(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    sources = [lake.table(n) for n in ("Stg_Transaction", "Dim_Customer", "Dim_Date", "Dim_Location")]
    return facts.build_fact_transaction(*sources, mode)


def _named(fact: DataFrame, lake: Warehouse) -> DataFrame:
    owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID", "LocationMatch")
    places = lake.table("Dim_Location").select("LocationKey", "LocationCode")
    return fact.join(owners, "CustomerKey").join(places, "LocationKey", "left").select(
        "TransactionID", "CustomerID", "LocationMatch", "DateKey", "LocationCode", "TransactionAmount", "AccountBalance"
    )


_FACT_COLUMNS = "TransactionID, CustomerID, LocationMatch, DateKey, LocationCode, TransactionAmount, AccountBalance"
add("fact_transaction_version_key", _fact("version_key"), f"select {_FACT_COLUMNS} from fact")
add("fact_transaction_date_range", _fact("date_range"), f"select {_FACT_COLUMNS} from fact_range")
add(
    "scd_overlap_duplicates",
    lambda s, d: quality.duplicated_transactions(_fact_rows(s, d, "date_range")),
    "select TransactionID, count(*) as FactRows from fact_range group by TransactionID having count(*) > 1",
)
add(
    "monthly_volume",
    on("Fact_Transaction", facts.monthly_volume),
    """select strftime(Date, '%Y-%m') as YearMonth, count(*) as TransactionCount,
              cast(sum(TransactionAmount) as decimal(28,2)) as TotalAmount from fact group by 1""",
)


def _sample_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    fact = lake.table("Fact_Transaction").drop("TransactionKey", "ETLLoadDate", "ETLBatchID")
    rows = reports.sample_facts(fact, lake.table("Dim_Customer"), lake.table("Dim_Date"))
    return rows.select("TransactionID", "CustomerID", "Date", "TransactionAmount", "AccountBalance")


add(
    "sample_facts",
    _sample_facts,
    """select TransactionID, CustomerID, Date, TransactionAmount, AccountBalance from fact
       order by TransactionID, DateKey limit 20""",
)

# ---------------------------------------------------------------- monthly snapshot

_ACTIVITY_COLUMNS = [
    "TransactionCount",
    "TotalTransactionAmount",
    "AvgTransactionAmount",
    "MinTransactionAmount",
    "MaxTransactionAmount",
    "LastTxDateInMonth",
    "MonthEndBalance",
    "TxYear",
    "TxMonth",
]


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    activity = snapshot.monthly_activity(lake.table("Fact_Transaction"), SETTINGS.cutoff)
    owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID", "LocationMatch")
    return activity.join(owners, "CustomerKey").select("CustomerID", "LocationMatch", "MonthEndDate", *_ACTIVITY_COLUMNS)


add(
    "monthly_activity",
    _activity,
    f"select CustomerID, LocationMatch, MonthEndDate, {', '.join(_ACTIVITY_COLUMNS)} from activity",
)


def _whole_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    customers = lake.table("Dim_Customer")
    activity = snapshot.activity_of_customer(lake.table("Monthly_Activity"), customers)
    return activity.join(customers.select("CustomerKey", "CustomerID"), "CustomerKey").select(
        "CustomerID", "MonthEndDate", *_ACTIVITY_COLUMNS
    )


add(
    "monthly_activity_of_customer",
    _whole_activity,
    f"select CustomerID, MonthEndDate, {', '.join(_ACTIVITY_COLUMNS)} from whole_activity",
)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    customers = lake.table("Dim_Customer")
    profile = snapshot.customer_profile(customers, lake.table("Monthly_Activity"), SETTINGS.cutoff)
    return profile.join(customers.select("CustomerKey", "CustomerID"), "CustomerKey").drop("CustomerKey")


add(
    "customer_profile",
    _profile,
    """select CustomerID, min(Date) as FirstTransactionDate, max(Date) as LastEverTxDate,
              cast(datediff('day', max(Date), date '1999-08-31') as integer) as DaysSinceLastTx
       from fact where IsCurrent and Date <= date '1999-08-31' group by CustomerID""",
)


def _snapshot_input(lake):
    return lake.table("Monthly_Activity"), lake.table("Dim_Customer"), lake.table("Dim_Date")


def _spine(**changes) -> Query:
    settings = replace(SETTINGS, **changes)
    return lambda s, d: snapshot.customer_spine(*_snapshot_input(warehouse(s, d)), settings).drop("CustomerKey")


def _merged_spine(**changes) -> Query:
    settings = replace(SETTINGS, **changes)
    return lambda s, d: snapshot.merge_spine(*_snapshot_input(warehouse(s, d)), settings).drop("CustomerKey")


add("customer_spine", _spine(), "select * from spine")
add("customer_spine_whole_history", _spine(grain="customer_id"), "select * from whole_spine")
add("merged_spine", _merged_spine(), "select * from merged")
add("merged_spine_last_balance", _merged_spine(balance_carry="last_value"), "select * from merged_last")
add("merged_spine_whole_history", _merged_spine(grain="customer_id"), "select * from whole_merged")
# months before the snapshot starts still count as previous months, but not as history
_LATE = "date '1998-06-15'"



def _late_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    settings = replace(SETTINGS, start=date(1998, 6, 15), cutoff=date(1999, 7, 20))
    activity = snapshot.monthly_activity(lake.table("Fact_Transaction"), settings.cutoff)
    rows = snapshot.merge_spine(activity, lake.table("Dim_Customer"), lake.table("Dim_Date"), settings)
    return rows.drop("CustomerKey")


add(
    "merged_spine_late_start",
    _late_spine,
    "select * from late_merged",
    late_fact="select * from fact where Date <= date '1999-07-20'",
    late_current=_activity_sql("CustomerID", "late_fact").replace("where Date <=", "where IsCurrent and Date <="),
    late_spine=_spine_sql("late_current", "FirstTransactionDate")
    .replace("date '1998-01-01'", _LATE)
    .replace("date '1999-08-31'", "date '1999-07-20'"),
    late_merged=_merged("late_spine", "late_current", "max"),
)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = snapshot.merge_spine(*_snapshot_input(warehouse(spark, sf_dir)), SETTINGS)
    return snapshot.score_snapshot(merged, SETTINGS.seed)


_SCORES = """CustomerID, MonthEndDate, DaysSinceLastTransaction, RecencyScore, FrequencyScore, LoyaltyScore, ChurnFlag,
    AtRiskFlag, PreviousMonthTransactionCount, IsFirstMonth, GrowthRate, SatisfactionScore, ComplaintFlag, TrendCategory"""
add(
    "rf_scores",
    lambda s, d: _scored(s, d).select(*[c.strip() for c in _SCORES.split(",")]),
    f"select {_SCORES} from scored",
)


def _segmented(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return segments.assign_segment(_scored(spark, sf_dir), warehouse(spark, sf_dir).table("Dim_Segment"), mode)


add(
    "segments_as_coded",
    lambda s, d: _segmented(s, d, "as_coded").select("CustomerID", "MonthEndDate", "SegmentKey"),
    "select CustomerID, MonthEndDate, SegmentKey from segmented",
)
add(
    "segments_range",
    lambda s, d: _segmented(s, d, "range").select("CustomerID", "MonthEndDate", "SegmentKey"),
    """select s.CustomerID, s.MonthEndDate, coalesce(r.SegmentKey, -1) as SegmentKey from scored s
       left join rules r on DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax
            and TransactionCount between r.FrequencyMin and r.FrequencyMax""",
)
add(
    "segment_step_counts",
    lambda s, d: segments.segment_step_counts(_segmented(s, d, "as_coded")),
    "select SegmentStep, count(*) as Records from segmented group by SegmentStep",
)
_SNAPSHOT_COLUMNS = """CustomerID, DateKey, SegmentKey, TransactionCount, TotalTransactionAmount, AvgTransactionAmount,
    MinTransactionAmount, MaxTransactionAmount, DaysSinceLastTransaction, RecencyScore, FrequencyScore, LoyaltyScore,
    SatisfactionScore, ComplaintFlag, ChurnFlag, AtRiskFlag, TrendCategory, PreviousMonthTransactionCount, GrowthRate,
    FinalAccountBalance"""


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID")
    rows = lake.table("Fact_CustomerSnapshot").join(owners, "CustomerKey")
    return rows.select(*[c.strip() for c in _SNAPSHOT_COLUMNS.split(",")])


add("snapshot", _snapshot, f"select {_SNAPSHOT_COLUMNS} from snap")

# ---------------------------------------------------------------- reports on the snapshot

add(
    "recency_score_distribution",
    on("Fact_CustomerSnapshot", lambda t: reports.with_percent_text(reports.distribution(t, "RecencyScore"))),
    f"""select RecencyScore, Records, format('{{:.2f}}', Pct) || '%' as Pct from ({_share('RecencyScore', 'snap', 'Records')})""",
)
add(
    "loyalty_distribution",
    on("Fact_CustomerSnapshot", reports.loyalty_distribution),
    f"""select Category, Records, {_pct('Records', 'Total', 1)} as Pct from (select Category, count(*) as Records,
        cast(sum(count(*)) over () as bigint) as Total from (select case when LoyaltyScore >= 4.5 then 'Very High'
        when LoyaltyScore >= 3.5 then 'High' when LoyaltyScore >= 2.5 then 'Medium' else 'Low' end as Category from snap) group by 1)""",
)
_SIX = "cast(cast((cast({0} as hugeint) * 20000 + {1}) // (2 * {1}) as decimal(18,6)) * cast(0.000001 as decimal(7,6)) as decimal({2},6))"
add(
    "churn_loyalty",
    on("Fact_CustomerSnapshot", reports.churn_loyalty),
    f"""select ChurnFlag, count(*) as Records, {_SIX.format('sum(cast(LoyaltyScore * 100 as bigint))', 'count(*)', 9)} as AvgLoyalty
        from snap group by ChurnFlag""",
)
add(
    "segment_distribution",
    lambda s, d: reports.segment_distribution(
        warehouse(s, d).table("Fact_CustomerSnapshot"), warehouse(s, d).table("Dim_Segment")
    ),
    f"""select SegmentName, cast(DisplayOrder as integer) as DisplayOrder, CustomerMonths, {_pct('CustomerMonths', 'Total')} as Pct from
        (select SegmentName, DisplayOrder, count(*) as CustomerMonths, cast(sum(count(*)) over () as bigint) as Total
         from snap s join rules r on r.SegmentKey = s.SegmentKey group by 1, 2)""",
)
add(
    "latest_risk",
    on_model(lambda m: reports.latest_risk(m.snapshot, m.anchors().last)),
    f"""select *, {_pct('ChurnedCustomers', 'TotalCustomers')} as ChurnRate, {_pct('AtRiskCustomers', 'TotalCustomers')} as AtRiskRate
        from (select count(*) filter (where ChurnFlag) as ChurnedCustomers, count(*) filter (where AtRiskFlag) as AtRiskCustomers,
              count(*) as TotalCustomers from snap where DateKey = (select max(DateKey) from snap))""",
)
_WIDE = """CustomerID, DateKey, Year, YearMonth, SegmentName, Gender, AgeGroup, Location, State, Region, RecencyBucket,
    LoyaltyBand, GrowthCategory"""
add(
    "snapshot_wide",
    on_model(lambda m: snapshot_wide(m).select(*[c.strip() for c in _WIDE.split(",")])),
    f"select {_WIDE} from w",
)
add(
    "report_view",
    on_model(
        lambda m: report_view(
            snapshot_wide(m).select("CustomerID", "YearMonth", "TotalTransactionAmount", "ChurnFlag", "LocationKey")
        )
    ),
    """select CustomerID as "Customer ID", YearMonth as "Year Month", TotalTransactionAmount as "Total Transaction Amt",
              ChurnFlag as "Churn Flag" from w""",
)
add(
    "table_counts",
    lambda s, d: reports.table_counts(
        {n: warehouse(s, d).table(n) for n in ("Dim_Date", "Dim_Segment", "Dim_Location", "Dim_Customer", "Fact_Transaction", "Fact_CustomerSnapshot")}
        | {"Dim_Customer (Current)": warehouse(s, d).table("Dim_Customer").where("IsCurrent")}
    ),
    """select 'Dim_Date' as TableName, count(*) as TableRows from dim_date union all select 'Dim_Segment', count(*) from rules
       union all select 'Dim_Location', count(*) from dim_location union all select 'Dim_Customer', count(*) from dim_customer
       union all select 'Dim_Customer (Current)', count(*) from dim_customer where IsCurrent
       union all select 'Fact_Transaction', count(*) from fact union all select 'Fact_CustomerSnapshot', count(*) from snap""",
)
add(
    "stage_metrics",
    lambda s, d: stage_metrics(
        s, {n: warehouse(s, d).table(n) for n in ("Stg_Transaction", "Stg_Customer", "Stg_Location", "Monthly_Activity")}
    ),
    """select 'Stg_Transaction' as stage, count(*) as rows from stg_transaction union all
       select 'Stg_Customer', count(*) from stg_customer union all select 'Stg_Location', count(*) from stg_location
       union all select 'Monthly_Activity', count(*) from activity""",
)
add(
    "top_states_other",
    on_model(
        lambda m: reports.top_n_other(
            reports.customers_by_place(m.dim_customer, m.dim_location).withColumnRenamed("CustomerCount", "Customers"),
            "State",
            "Customers",
            3,
        )
    ),
    """select case when rk <= 3 then State else 'Other' end as StateGroup, cast(sum(n) as bigint) as Customers from
       (select State, n, dense_rank() over (order by n desc) as rk from
         (select l.State, count(*) as n from dim_customer c left join dim_location l on l.LocationCode = c.LocationCode
          where c.IsCurrent group by 1)) group by 1""",
)
add(
    "hierarchy_rollup",
    on_model(measures.hierarchy_rollup),
    """select Year, QuarterName, MonthName, MonthLabel, Date,
         cast(grouping(Year, QuarterName, MonthName, MonthLabel, Date) as integer) as GroupingLevel,
         count(*) as CustomerMonths, count(*) filter (where ChurnFlag) as ChurnedMonths,
         cast(sum(TransactionCount) as bigint) as Transactions, cast(sum(TotalTransactionAmount) as decimal(28,2)) as Amount
       from (select *, 'Q' || quarter(MonthEndDate) as QuarterName, monthname(MonthEndDate) as MonthName,
                    strftime(MonthEndDate, '%b-%y') as MonthLabel, MonthEndDate as Date from w)
       group by rollup (Year, QuarterName, MonthName, MonthLabel, Date)""",
)
add(
    "data_months",
    on_model(measures.last_months),
    """select a as LastDataDateKey, strftime(strptime(cast(a as varchar), '%Y%m%d'), '%Y-%m') as LastDataMonth,
              p as PrevDataDateKey from k""",
)


add(
    "customers_by_balance_level",
    on_model(levels.customers_by_balance_level),
    _share(
        "BalanceLevel",
        """(select case when FinalAccountBalance < 50000 then 'Low' when FinalAccountBalance < 250000 then 'Medium' else 'High' end
            as BalanceLevel from snap where DateKey = (select max(DateKey) from snap))""",
        "Customers",
    ),
)

# ---------------------------------------------------------------- measures


def _distinct(test: str, point: str = "a") -> str:
    return f"nullif(count(distinct CustomerID) filter (where DateKey = {point} and ({test})), 0)"


def _rows(test: str, point: str | None = "a") -> str:
    at = f"DateKey = {point} and " if point else ""
    return f"nullif(count(*) filter (where {at}({test})), 0)"


def _sum(column: str, point: str | None = "a") -> str:
    at = f" filter (where DateKey = {point})" if point else ""
    return f"sum({column}){at}"


def _div(x: str, y: str) -> str:
    return f"(cast({x} as double) / cast({y} as double))"


def _avg(column: str, point: str | None = "a") -> str:
    return _div(_sum(column, point), _rows(f"{column} is not null", point))


def _minus(x: str, y: str) -> str:
    return f"(case when {x} is not null or {y} is not null then coalesce({x}, 0) - coalesce({y}, 0) end)"


def _grown(point: str) -> str:
    return _div(_minus(_distinct("true"), _distinct("true", point)), _distinct("true", point))


def _churn(point: str | None) -> str:
    return _div(_rows("ChurnFlag", point), _rows("true", point))


_ALL = _distinct("true")
MEASURE_SQL = {
    "total_customers": _ALL,
    "active_customers": _distinct("not ChurnFlag and not AtRiskFlag"),
    "active_customer_rate": _div(_distinct("not ChurnFlag and not AtRiskFlag"), _ALL),
    "new_customers": _distinct("TrendCategory = 'New'"),
    "customer_growth_mom": _grown("p"),
    "customer_growth_qoq": _grown("q"),
    "customer_growth_yoy": _grown("y"),
    "churned_customers": _distinct("ChurnFlag"),
    "churn_rate": _div(_distinct("ChurnFlag"), _ALL),
    "retention_rate": f"1.0::double - coalesce({_div(_distinct('ChurnFlag'), _ALL)}, 0)",
    "at_risk_customers": _distinct("AtRiskFlag"),
    "at_risk_rate": _div(_distinct("AtRiskFlag"), _ALL),
    "churn_rate_mom_change": _minus(_churn("a"), _churn("p")),
    "churn_rate_trend": _churn(None),
    "churn_rate_qoq_change": _minus(_churn("a"), _churn("q")),
    "churn_rate_yoy_change": _minus(_churn("a"), _churn("y")),
    "avg_loyalty_score": _avg("LoyaltyScore"),
    "avg_satisfaction_score": _avg("SatisfactionScore"),
    "avg_recency_days": _avg("DaysSinceLastTransaction"),
    "loyalty_score_trend": _avg("LoyaltyScore", None),
    "loyalty_mom_change": _minus(_avg("LoyaltyScore"), _avg("LoyaltyScore", "p")),
    "loyalty_qoq_change": _minus(_avg("LoyaltyScore"), _avg("LoyaltyScore", "q")),
    "loyalty_yoy_change": _minus(_avg("LoyaltyScore"), _avg("LoyaltyScore", "y")),
    "total_transaction_amount": f"cast({_sum('TotalTransactionAmount', None)} as decimal(38,2))",
    "total_transaction_amount_latest": f"cast({_sum('TotalTransactionAmount')} as decimal(38,2))",
    "avg_transaction_amount": _avg("AvgTransactionAmount"),
    "total_transactions": f"cast({_sum('TransactionCount')} as bigint)",
    "avg_transactions_per_customer": _div(_sum("TransactionCount"), _ALL),
    "transaction_volume_trend": f"cast({_sum('TransactionCount', None)} as bigint)",
    "customers_with_complaints": _distinct("ComplaintFlag"),
    "complaint_rate": _div(_distinct("ComplaintFlag"), _ALL),
    "avg_growth_rate": f"{_avg('GrowthRate')} / 100.0::double",
    "growing_customers": _rows("GrowthCategory = 'Growing'"),
    "declining_customers": _rows("GrowthCategory = 'Declining'"),
    "customer_count_by_segment": _ALL,
    "champions_count": _distinct("SegmentCode = 'RF_Champions'"),
    "churned_segment_count": _distinct("SegmentCode = 'RF_Churned'"),
    "promoters": _rows("SatisfactionScore >= 4"),
    "detractors": _rows("SatisfactionScore <= 2"),
    "nps_score": _div(_minus(_rows("SatisfactionScore >= 4"), _rows("SatisfactionScore <= 2")), _ALL),
    "nps_trend": _div(
        _minus(_rows("SatisfactionScore >= 4", None), _rows("SatisfactionScore <= 2", None)), _rows("true", None)
    ),
    "potential_loyalists": _distinct("SegmentCode = 'RF_Potential'"),
    "hibernating_customers": _distinct("SegmentCode = 'RF_Hibernating'"),
    "hibernating_rate": _div(_distinct("SegmentCode = 'RF_Hibernating'"), _ALL),
    "total_complaints": _rows("ComplaintFlag"),
    "complaints_per_1k": _div(f"{_rows('ComplaintFlag')} * 1000", _ALL),
}
# the attribute each measure is also split by
_SPLITS = ["SegmentName", "State", "Gender", "AgeGroup", "RecencyBucket"]


def _measure_sql(name: str, by: str | None = None, where: str = "true") -> str:
    if by is None:
        return f"select {MEASURE_SQL[name]} as {name} from w, k where {where}"
    shown = f"{name} is not null" if name != "retention_rate" else "shown > 0"
    return f"""select {by}, {name} from (select {by}, {MEASURE_SQL[name]} as {name}, {_rows('true')} as shown
        from w, k where {where} group by {by}) where {shown}"""


for _i, _name in enumerate(MEASURE_SQL):
    add(f"measure_{_name}", on_model(lambda m, n=_name: measures.measures(m, n)), _measure_sql(_name))
    _by = _SPLITS[_i % len(_SPLITS)]
    add(
        f"measure_{_name}_by_{_by.lower()}",
        on_model(lambda m, n=_name, b=_by: measures.measures(m, n, by=[b])),
        _measure_sql(_name, _by),
    )
_SHARE_SQL = """select {0}, cast(n as double) / sum(n) over ({1}) as segment_share from
    (select {0}, count(distinct CustomerID) as n from w, k where DateKey = a group by {0})"""
add(
    "measure_segment_share",
    on_model(lambda m: measures.measures(m, "segment_share", by=["SegmentName"])),
    _SHARE_SQL.format("SegmentName", ""),
)
add(
    "measure_segment_share_by_state",
    on_model(lambda m: measures.measures(m, "segment_share", by=["SegmentName", "State"])),
    _SHARE_SQL.format("SegmentName, State", "partition by State"),
)
add(
    "measure_segment_share_of_two_segments",
    on_model(
        lambda m: measures.measures(
            m, ["segment_share", "total_customers"], by=["Gender"], where={"SegmentName": ["Champions", "Loyal Customers"]}
        )
    ),
    """select Gender, cast(n as double) / t as segment_share, n as total_customers from (select Gender,
        count(distinct CustomerID) filter (where SegmentName in ('Champions', 'Loyal Customers')) as n,
        count(distinct CustomerID) as t from w, k where DateKey = a group by Gender) where n > 0""",
)
_FILTERED = ["total_customers", "churn_rate", "customer_growth_yoy", "loyalty_score_trend", "total_transactions"]
add(
    "measures_with_filters",
    on_model(
        lambda m: measures.measures(
            m, _FILTERED, by=["SegmentName", "Region"], where={"Year": 1999, "Gender": ["Male", "Female"]}
        )
    ),
    "select * from (select SegmentName, Region, "
    + ", ".join(
        f"{MEASURE_SQL[n] if n != 'loyalty_score_trend' else _avg_in_1999} as {n}"
        for n in _FILTERED
        for _avg_in_1999 in [_div("sum(LoyaltyScore) filter (where Year = 1999)", "nullif(count(*) filter (where Year = 1999), 0)")]
    )
    + """ from w, k where Gender in ('Male', 'Female') group by SegmentName, Region)
        where total_customers is not null or loyalty_score_trend is not null or customer_growth_yoy is not null""",
)
add(
    "measures_at_selected_month",
    on_model(
        lambda m: measures.measures(
            m, ["total_customers", "customer_growth_mom", "churn_rate"], where={"YearMonth": ["1998-11", "1998-12"]}, anchor="selected"
        )
    ),
    f"""select {_ALL} as total_customers, {_grown('p')} as customer_growth_mom,
        {_div(_distinct('ChurnFlag'), _ALL)} as churn_rate
        from w, (select 19981231 as a, 19981130 as p)""",
)
add(
    "measures_by_month_in_context",
    on_model(
        lambda m: measures.measures(m, ["churn_rate_trend", "nps_trend", "transaction_volume_trend"], by=["YearMonth"])
    ),
    f"""select YearMonth, {_churn(None)} as churn_rate_trend, {MEASURE_SQL['nps_trend']} as nps_trend,
        {MEASURE_SQL['transaction_volume_trend']} as transaction_volume_trend from w group by YearMonth""",
)
_LEVELS = [
    "total_customers",
    "active_customers",
    "churn_rate_trend",
    "loyalty_score_trend",
    "transaction_volume_trend",
    "nps_trend",
]


def _trend_sql(names: list[str], by: str = "", where: str = "true") -> str:
    columns = ", ".join(f"{MEASURE_SQL[n].replace('DateKey = a', 'true')} as {n}" for n in names)
    more = f", {by}" if by else ""
    return f"select DateKey, YearMonth{more}, {columns} from w where {where} group by DateKey, YearMonth{more}"


add("trend_headline", on_model(lambda m: measures.trend(m, _LEVELS)), _trend_sql(_LEVELS))
add(
    "trend_by_state",
    on_model(lambda m: measures.trend(m, ["total_customers", "churn_rate"], by=["State"], where={"Year": 1999})),
    _trend_sql(["total_customers", "churn_rate"], "State", "Year = 1999"),
)

_PATTERNS = [
    "churned_customers",
    "churn_rate",
    "hibernating_customers",
    "hibernating_rate",
    "customers_with_complaints",
    "complaint_rate",
    "total_customers",
]
for _by in ("SegmentName", "State"):
    add(
        f"churn_and_complaints_by_{_by.lower()}",
        on_model(lambda m, b=_by: measures.measures(m, _PATTERNS, by=[b])),
        f"select * from (select {_by}, "
        + ", ".join(f"{MEASURE_SQL[n]} as {n}" for n in _PATTERNS)
        + f" from w, k group by {_by}) where total_customers is not null",
    )
add(
    "customers_by_state",
    on_model(lambda m: reports.customers_by_place(m.dim_customer, m.dim_location)),
    _share(
        "State",
        """(select l.State from dim_customer c left join dim_location l on l.LocationCode = c.LocationCode where c.IsCurrent)""",
        "CustomerCount",
    ),
)

# ---------------------------------------------------------------- transitions

for _period, _point in (("month", "p"), ("quarter", "q"), ("year", "y")):
    _moved = f"""from snap s, k, snap b where s.DateKey = k.a and b.CustomerID = s.CustomerID and b.DateKey = k.{_point}"""
    add(
        f"segment_migration_{_period}",
        on_model(lambda m, p=_period: transitions.segment_migration(m, p)),
        f"select nullif(count(*), 0) as segment_migration_{_period} {_moved} and s.SegmentKey <> b.SegmentKey",
    )
    add(
        f"segment_flow_{_period}",
        on_model(lambda m, p=_period: transitions.segment_flow(m, p)),
        f"""select f.SegmentName as FromName, t.SegmentName as ToName, n as Customers from
            (select b.SegmentKey as x, s.SegmentKey as z, count(*) as n {_moved} group by 1, 2)
            left join rules f on f.SegmentKey = x left join rules t on t.SegmentKey = z""",
    )
add(
    "segment_migration_month_by_state",
    on_model(lambda m: transitions.segment_migration(m, "month", by=["State"], where={"Gender": "Male"})),
    """select s.State, count(*) as segment_migration_month from w s, k, snap b where s.DateKey = k.a and b.CustomerID = s.CustomerID
       and b.DateKey = k.p and s.SegmentKey <> b.SegmentKey and s.Gender = 'Male' group by s.State""",
)
_TRANSITIONS = """count(*) filter (where TrendCategory = 'New') as NewCustomers,
    count(*) filter (where TrendCategory = 'New' and NextActive) as NewRetained,
    count(*) filter (where SegmentKey = 3) as PotentialLoyalists,
    count(*) filter (where SegmentKey = 3 and NextSegment = 2) as LoyalConversions,
    count(*) filter (where SegmentKey = 6) as HibernatingCustomers,
    count(*) filter (where SegmentKey = 6 and NextTransacts) as WonBack"""
_TRANSITION_RATES = """cast(NewRetained as double) / nullif(NewCustomers, 0) as NewCustomerRetentionRate,
    cast(LoyalConversions as double) / nullif(PotentialLoyalists, 0) as LoyalConversionRate,
    cast(WonBack as double) / nullif(HibernatingCustomers, 0) as WinBackRate"""


def _transitions_sql(by: str = "", source: str = "pairs, k where DateKey = k.p") -> str:
    group, more = (f"group by {by}", f"{by}, ") if by else ("", "")
    return f"select *, {_TRANSITION_RATES} from (select {more}{_TRANSITIONS} from {source} {group})"


add("new_customer_retention", on_model(transitions.transitions), _transitions_sql())
add(
    "loyal_conversion_by_state",
    on_model(lambda m: transitions.transitions(m, by=["State"])),
    _transitions_sql("State"),
)
add(
    "transitions_per_month",
    on_model(lambda m: transitions.transitions(m, by=["Gender"], per_month=True)),
    _transitions_sql("DateKey, Gender", "pairs"),
)
add(
    "loyalty_funnel",
    on_model(transitions.loyalty_funnel),
    f"""select 1 as StageOrder, 'New' as Stage, NewCustomers as Customers from cohort union all
        select 2, 'Potential Loyalists', PotentialLoyalists from cohort union all select 3, 'Converted to Loyal', LoyalConversions from cohort""",
    cohort=f"select {_TRANSITIONS} from pairs, k where DateKey = k.p",
)
add(
    "converted_customers",
    on_model(transitions.converted_customers),
    """select CustomerID from snap, k where DateKey = p and SegmentKey = 3 intersect
       select CustomerID from snap, k where DateKey = a and SegmentKey = 2""",
)
add(
    "declining_streak",
    on_model(lambda m: transitions.declining_streak(m, 2)),
    """select CustomerID, cast(DecliningMonths as bigint) as DecliningMonths from streaks, k where DateKey = a and DecliningMonths >= 2""",
)
add(
    "at_risk_customers",
    on_model(lambda m: transitions.at_risk_customers(m, 2)),
    """select s.CustomerID, s.AtRiskFlag, s.DaysSinceLastTransaction, s.GrowthRate, cast(t.DecliningMonths as bigint) as DecliningMonths
       from snap s join streaks t on t.CustomerID = s.CustomerID and t.DateKey = s.DateKey, k
       where s.DateKey = k.a and (s.AtRiskFlag or t.DecliningMonths >= 2)""",
)
add(
    "churn_profile",
    on_model(transitions.churn_profile),
    f"""select Status, count(*) as Customers, {_SIX.format('sum(cast(SatisfactionScore * 100 as bigint))', 'count(*)', 7)} as AvgSatisfaction,
         count(*) filter (where SatisfactionScore <= 2) as LowSatisfaction, count(*) filter (where EverComplained) as EverComplained,
         count(*) filter (where coalesce(Fell, false)) as FellBeforeSilence
       from (select case when s.ChurnFlag then 'Churned' when s.SegmentKey = 6 then 'Hibernating' else 'Other' end as Status,
              s.SatisfactionScore, h.EverComplained, h.Fell
             from snap s, k, (select CustomerID, bool_or(ComplaintFlag) as EverComplained,
                   arg_max(coalesce(GrowthRate < 0, false), DateKey) filter (where TransactionCount > 0) as Fell from snap group by CustomerID) h
             where s.DateKey = k.a and h.CustomerID = s.CustomerID) group by Status""",
)
add(
    "growth_distribution",
    on_model(transitions.growth_distribution),
    _share("TrendCategory", "snap where DateKey = (select max(DateKey) from snap)", "Customers"),
)

# ---------------------------------------------------------------- dashboards


def _measure_rows(names: list[str]) -> str:
    values = ", ".join(f"cast({MEASURE_SQL[n]} as double) as {n}" for n in names)
    return f"unpivot (select {values} from w, k) on {', '.join(names)} into name Measure value Value"


def _kpi_sql() -> str:
    targets = " ".join(f"when '{n}' then {t}::double" for n, (t, _) in dashboards.KPI_TARGETS.items())
    return f"""select Measure, Value, Target, case when (Measure = 'churn_rate' and Value <= Target)
        or (Measure <> 'churn_rate' and Value >= Target) then 'On target' else 'Off target' end as Status
        from (select *, case Measure {targets} end as Target from ({_measure_rows(list(dashboards.KPI_TARGETS))}))"""


def _board(page: str, name: str) -> Query:
    return on_model(lambda m: dashboards.visual(m, page, name))


_HEADLINE = list(dashboards.KPI_TARGETS)
add("dashboard_executive_kpis", _board("executive", "kpis"), _kpi_sql())
add("dashboard_executive_sparklines", _board("executive", "sparklines"), _trend_sql(_HEADLINE))
add("dashboard_executive_trends", _board("executive", "monthly_trends"), _trend_sql(_LEVELS))
_SEGMENT_NAMES = [
    "customer_count_by_segment",
    "growing_customers",
    "declining_customers",
    "customers_with_complaints",
    "total_transaction_amount",
]
add(
    "dashboard_executive_segments",
    _board("executive", "segment_breakdown"),
    "select SegmentName, cast(DisplayOrder as integer) as DisplayOrder, "
    + ", ".join(f"{MEASURE_SQL[n]} as {n}" for n in _SEGMENT_NAMES)
    + " from w, k group by SegmentName, DisplayOrder",
)
add(
    "dashboard_executive_segment_trend",
    _board("executive", "segment_trend"),
    _trend_sql(["total_customers"], "SegmentName"),
)
_MARKETING = ["new_customers", "potential_loyalists", "hibernating_customers", "hibernating_rate"]
add(
    "dashboard_marketing_kpis",
    _board("marketing", "kpis"),
    f"""select * from ({_measure_rows(_MARKETING)}) union all
        select * from (unpivot (select NewCustomerRetentionRate, LoyalConversionRate from ({_transitions_sql()}))
        on NewCustomerRetentionRate, LoyalConversionRate into name Measure value Value)""",
)


def _top_sql(counts: str, measure: str) -> str:
    return f"""select case when rk <= 3 then State else 'Other' end as StateGroup, cast(sum({measure}) as bigint) as {measure} from
        (select *, dense_rank() over (order by {measure} desc) as rk from ({counts})) group by 1"""


add(
    "dashboard_marketing_new_by_state",
    _board("marketing", "new_by_state"),
    _top_sql(_measure_sql("new_customers", "State"), "new_customers"),
)
add(
    "dashboard_marketing_conversion_trend",
    _board("marketing", "conversion_trend"),
    f"select DateKey, PotentialLoyalists, LoyalConversions, LoyalConversionRate from ({_transitions_sql('DateKey', 'pairs')})",
)
add(
    "dashboard_marketing_hibernating_trend",
    _board("marketing", "hibernating_trend"),
    _trend_sql(["hibernating_customers", "hibernating_rate"]),
)
add(
    "dashboard_marketing_conversions_by_state",
    _board("marketing", "conversions_by_state"),
    _top_sql(f"select State, LoyalConversions from ({_transitions_sql('State')}) where LoyalConversions > 0", "LoyalConversions"),
)
add(
    "dashboard_marketing_hibernating_by_state",
    _board("marketing", "hibernating_by_state"),
    _measure_sql("hibernating_customers", "State"),
)
add(
    "dashboard_marketing_funnel",
    _board("marketing", "funnel"),
    """select 1 as StageOrder, 'New' as Stage, NewCustomers as Customers from cohort union all
       select 2, 'Potential Loyalists', PotentialLoyalists from cohort union all select 3, 'Converted to Loyal', LoyalConversions from cohort""",
    cohort=f"select {_TRANSITIONS} from pairs, k where DateKey = k.p",
)
_CRM = ["total_customers", "churn_rate", "nps_score", "hibernating_customers", "total_complaints", "complaints_per_1k"]
add("dashboard_crm_kpis", _board("crm", "kpis"), f"select * from ({_measure_rows(_CRM)})")
add(
    "dashboard_crm_satisfaction_churn",
    _board("crm", "satisfaction_churn_trend"),
    _trend_sql(["nps_score", "churn_rate_trend"]),
)
add("dashboard_crm_complaints", _board("crm", "complaints_trend"), _trend_sql(["total_complaints"]))
add(
    "dashboard_crm_complaints_by_segment",
    _board("crm", "complaints_by_segment"),
    _measure_sql("total_complaints", "SegmentName"),
)
add("dashboard_crm_risk", _board("crm", "risk_trend"), _trend_sql(["at_risk_customers", "churned_customers"]))
add("dashboard_crm_churned_by_state", _board("crm", "churned_by_state"), _measure_sql("churned_customers", "State"))
add(
    "dashboard_crm_active_segments",
    _board("crm", "active_segments_trend"),
    _trend_sql(["total_customers"], "SegmentName", "SegmentName in ('Champions', 'Loyal Customers', 'Potential Loyalists')"),
)
_ANALYST = ["churn_rate", "avg_loyalty_score", "nps_score", "avg_growth_rate", "total_customers"]
add(
    "dashboard_analyst_segments",
    _board("analyst", "segments"),
    "select * from (select SegmentName, "
    + ", ".join(f"{MEASURE_SQL[n]} as {n}" for n in _ANALYST)
    + " from w, k group by SegmentName) where total_customers is not null",
)

# ---------------------------------------------------------------- data quality

add(
    "dq_skipped_histories",
    on("Location_History", quality.skipped_histories),
    "select count(*) filter (where LocStartDate is null) as SkippedGroups from location_history",
)
add(
    "dq_fact_null_keys",
    on("Fact_Transaction", lambda t: quality.null_counts(t, ["CustomerKey", "DateKey", "LocationKey"])),
    """select cast(0 as bigint) as NullCustomerKey, count(*) filter (where DateKey is null) as NullDateKey,
              count(*) filter (where LocationCode is null) as NullLocationKey from fact""",
)
add(
    "dq_fact_date_range",
    on("Fact_Transaction", quality.date_range),
    "select min(Date) as MinDate, max(Date) as MaxDate from fact",
)
add(
    "dq_one_current_version",
    on("Dim_Customer", quality.customers_without_one_current),
    "select CustomerID, count(*) filter (where IsCurrent) as CurrentRows from dim_customer group by 1 having CurrentRows <> 1",
)
add(
    "dq_segment_rules",
    lambda s, d: segments.segment_rule_coverage(
        warehouse(s, d).table("Fact_CustomerSnapshot"), warehouse(s, d).table("Dim_Segment")
    ),
    """select DaysSinceLastTransaction, TransactionCount, cast(count(r.SegmentKey) as integer) as MatchingRules
       from (select distinct DaysSinceLastTransaction, TransactionCount from snap) left join rules r
       on DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax and TransactionCount between r.FrequencyMin and r.FrequencyMax
       group by 1, 2 having count(r.SegmentKey) <> 1""",
)
add(
    "dq_foreign_keys",
    lambda s, d: quality.foreign_key_report(
        {
            n: warehouse(s, d).table(n)
            for n in ("Fact_CustomerSnapshot", "Fact_Transaction", "Dim_Customer", "Dim_Location", "Dim_Date", "Dim_Segment")
        }
    ),
    """select * from (values ('snapshot-customer', (select count(*) from snap where CustomerID not in (select CustomerID from dim_customer))),
        ('snapshot-date', (select count(*) from snap where DateKey not in (select DateKey from dim_date))),
        ('snapshot-segment', (select count(*) from snap where SegmentKey not in (select SegmentKey from rules))),
        ('fact-customer', (select count(*) from fact where CustomerID not in (select CustomerID from dim_customer))),
        ('fact-date', (select count(*) from fact where DateKey not in (select DateKey from dim_date))),
        ('fact-location', (select count(*) from fact where LocationCode not in (select LocationCode from dim_location))),
        ('customer-location', (select count(*) from dim_customer where LocationCode not in (select LocationCode from dim_location)))
       ) t(Relation, OrphanRows)""",
)
add(
    "dq_score_domains",
    on("Fact_CustomerSnapshot", quality.score_domains),
    """select count(*) filter (where RecencyScore not between 1 and 5) as BadRecencyScore,
              count(*) filter (where FrequencyScore not between 0 and 5) as BadFrequencyScore,
              count(*) filter (where SatisfactionScore not between 1 and 5) as BadSatisfactionScore from snap""",
)
add(
    "dq_unique_locations",
    on("Dim_Location", lambda t: quality.duplicate_keys(t, ["LocationCode"])),
    "select LocationCode, count(*) as KeyRows from dim_location group by 1 having count(*) > 1",
)
add(
    "dq_unique_customer_months",
    on("Fact_CustomerSnapshot", lambda t: quality.duplicate_keys(t, ["CustomerKey", "DateKey"])),
    "select cast(0 as bigint) as CustomerKey, DateKey, count(*) as KeyRows from snap group by CustomerID, DateKey having count(*) > 1",
)
add(
    "dq_required_columns",
    on("Dim_Customer", lambda t: quality.null_counts(t, ["CustomerID", "Gender", "AgeGroup", "Location", "StartDate"])),
    "select "
    + ", ".join(
        f"count(*) filter (where {c} is null) as Null{c}" for c in ("CustomerID", "Gender", "AgeGroup", "Location", "StartDate")
    )
    + " from dim_customer",
)
add(
    "dq_reconciliation",
    lambda s, d: quality.reconciliation(*(warehouse(s, d).table(n) for n in ("RawTransactions", "Stg_Transaction", "Fact_Transaction"))),
    """select 'raw' as Stage, count(*) as Records from raw union all select 'staging', count(*) from stg_transaction union all
       select 'staging with id and date', count(*) from stg_transaction where CustomerID is not null and TransactionDate is not null
       union all select 'fact', count(*) from fact""",
)

for _table, _key, _rows_of in (("Fact_Transaction", "TransactionKey", "fact"), ("Fact_CustomerSnapshot", "SnapshotKey", "snap")):
    add(
        f"dq_unique_{'fact' if _rows_of == 'fact' else 'snapshot'}_keys",
        on(
            _table,
            lambda t, k=_key: t.agg(
                F.count(F.lit(1)).alias("Records"), (F.count(F.lit(1)) - F.countDistinct(k)).alias("RepeatedKeys")
            ),
        ),
        f"select count(*) as Records, cast(0 as bigint) as RepeatedKeys from {_rows_of}",
    )
add(
    "dq_unique_segment_codes",
    on("Dim_Segment", lambda t: quality.duplicate_keys(t, ["SegmentCode"])),
    "select SegmentCode, count(*) as KeyRows from rules group by 1 having count(*) > 1",
)

# ---------------------------------------------------------------- measures whose tests replace filters


def _replaced(measure: str, test: str, by: str, rate: str | None = None) -> tuple[Query, str]:
    """A measure grouped by the very column that it tests, also as a filter on another value."""
    names = [measure] + ([rate] if rate else [])
    share = f", cast(n as double) / count(*) as {rate}" if rate else ""
    return (
        on_model(lambda m: measures.measures(m, names, by=[by])),
        f"""select {by}, n as {measure}{share} from w, k,
            (select nullif(count(*), 0) as n from w, k where DateKey = a and {test}) where DateKey = a group by {by}, n having n is not null""",
    )


add("measure_churn_rate_by_churnflag", *_replaced("churned_customers", "ChurnFlag", "ChurnFlag", "churn_rate"))
add("measure_new_customers_by_trendcategory", *_replaced("new_customers", "TrendCategory = 'New'", "TrendCategory"))
add("measure_champions_count_by_segmentcode", *_replaced("champions_count", "SegmentCode = 'RF_Champions'", "SegmentCode"))
add(
    "measure_growing_customers_by_growthcategory",
    *_replaced("growing_customers", "GrowthCategory = 'Growing'", "GrowthCategory"),
)
add("measure_complaints_by_complaintflag", *_replaced("total_complaints", "ComplaintFlag", "ComplaintFlag"))
add(
    "measures_under_replaced_filters",
    on_model(
        lambda m: measures.measures(
            m,
            ["churned_customers", "total_customers", "churn_rate", "champions_count"],
            by=["Region"],
            where={"ChurnFlag": False, "SegmentCode": "RF_Loyal"},
        )
    ),
    """select * from (select Region, nullif(count(*) filter (where ChurnFlag and SegmentCode = 'RF_Loyal'), 0) as churned_customers,
        nullif(count(*) filter (where not ChurnFlag and SegmentCode = 'RF_Loyal'), 0) as total_customers,
        cast(churned_customers as double) / total_customers as churn_rate,
        nullif(count(*) filter (where not ChurnFlag and SegmentCode = 'RF_Champions'), 0) as champions_count
        from w, k where DateKey = a group by Region)
        where churned_customers is not null or total_customers is not null or champions_count is not null""",
)
add(
    "trend_by_replaced_column",
    on_model(lambda m: measures.trend(m, ["churned_customers", "total_customers"], by=["ChurnFlag"])),
    """select DateKey, YearMonth, ChurnFlag, nullif(cast(sum(count(*) filter (where ChurnFlag)) over (partition by DateKey) as bigint), 0)
        as churned_customers, count(*) as total_customers from w group by DateKey, YearMonth, ChurnFlag""",
)
add(
    "measures_in_ranges",
    on_model(
        lambda m: measures.measures(
            m,
            ["total_customers", "total_transaction_amount", "avg_loyalty_score"],
            by=["Gender"],
            where={
                "Date": measures.Between(date(1999, 2, 1), None),
                "TotalTransactionAmount": measures.Between(1000, 90000),
                "FinalAccountBalance": measures.Between(None, 500000),
            },
        )
    ),
    f"""select Gender, {_ALL} as total_customers, {MEASURE_SQL['total_transaction_amount']} as total_transaction_amount,
        {MEASURE_SQL['avg_loyalty_score']} as avg_loyalty_score from w, k where MonthEndDate >= date '1999-02-01'
        and TotalTransactionAmount between 1000 and 90000 and FinalAccountBalance <= 500000 group by Gender""",
)

# ---------------------------------------------------------------- pages under slicers

_SLICERS = {"Year": 1999, "Gender": "Female"}


def _sliced(page: str, name: str) -> Query:
    return on_model(lambda m: dashboards.visual(m, page, name, where=_SLICERS))


add(
    "dashboard_executive_sliced",
    _sliced("executive", "monthly_trends"),
    _trend_sql(_LEVELS, where="Year = 1999 and Gender = 'Female'"),
)
add(
    "dashboard_executive_segments_sliced",
    _sliced("executive", "segment_breakdown"),
    "select SegmentName, cast(DisplayOrder as integer) as DisplayOrder, "
    + ", ".join(f"{MEASURE_SQL[n]} as {n}" for n in _SEGMENT_NAMES)
    + " from w, k where Gender = 'Female' group by SegmentName, DisplayOrder",
)
add(
    "dashboard_marketing_sliced",
    _sliced("marketing", "conversion_trend"),
    f"""select DateKey, PotentialLoyalists, LoyalConversions, LoyalConversionRate
        from ({_transitions_sql('DateKey', "pairs where Gender = 'Female' and Year = 1999")})""",
)
add(
    "dashboard_crm_sliced",
    _sliced("crm", "risk_trend"),
    _trend_sql(["at_risk_customers", "churned_customers"], where="Year = 1999 and Gender = 'Female'"),
)
add(
    "dashboard_analyst_sliced",
    _sliced("analyst", "segments"),
    "select * from (select SegmentName, "
    + ", ".join(f"{MEASURE_SQL[n]} as {n}" for n in _ANALYST)
    + " from w, k where Gender = 'Female' group by SegmentName) where total_customers is not null",
)

# ---------------------------------------------------------------- merged customers and their facts


def _returning(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Everyone moves to a branch, and back three months later: the dimension, and one batch
    of transactions at each place on days of each version."""
    lake = warehouse(spark, sf_dir)
    dim, places = lake.table("Dim_Customer"), lake.table("Dim_Location")
    now = dim.where("IsCurrent").select("CustomerID", "Location")
    away = scd2.merge_customers(dim, now.select("CustomerID", F.lit("BRANCH").alias("Location")), places, _MERGE_DATE)
    back = scd2.merge_customers(away, now, places, date(1999, 12, 1))
    days = F.explode(F.array(*[F.lit(date(1999, m, 15)) for m in (9, 10, 12)]))
    batch = now.select("CustomerID", F.upper("Location").alias("LocationMatch"), days.alias("Day")).unionByName(
        now.select("CustomerID", F.lit("BRANCH").alias("LocationMatch"), days.alias("Day"))
    )
    return back, batch


add(
    "scd2_merge_with_keys",
    lambda s, d: _returning(s, d)[0].agg(
        F.count(F.lit(1)).alias("Versions"),
        F.count_if("IsCurrent").alias("CurrentVersions"),
        (F.count(F.lit(1)) - F.countDistinct("CustomerKey")).alias("RepeatedKeys"),
        F.count_if(
            F.col("CustomerKey").isNull() | F.col("LocationMatch").isNull() | F.col("FirstTransactionDate").isNull() | F.col("DatedRows").isNull()
        ).alias("Unfilled"),
    ),
    """select (select count(*) from dim_customer) + 2 * count(*) as Versions, count(*) as CurrentVersions,
        cast(0 as bigint) as RepeatedKeys, cast(0 as bigint) as Unfilled from dim_customer where IsCurrent""",
)


def _returning_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, batch = _returning(spark, sf_dir)
    versions = dim.select("CustomerID", "LocationMatch", "CustomerKey", "StartDate", "EndDate", "DatedRows")
    joined = scd2.scd2_join(batch, versions, "CustomerID", "Day", spread_by=["CustomerID", "Day"])
    return joined.groupBy("Day", "StartDate", "EndDate").agg(F.count(F.lit(1)).alias("Transactions"))


add(
    "scd2_merge_returning_customer",
    _returning_facts,
    """select Day, StartDate, EndDate, count(*) as Transactions from (
         select Day, date '1999-09-01' as StartDate, date '1999-11-30' as EndDate from now, days
         union all
         select Day, date '1999-12-01', cast(null as date) from now, days) group by all""",
    now="select CustomerID from dim_customer where IsCurrent",
    days="select unnest([date '1999-09-15', date '1999-10-15', date '1999-12-15']) as Day",
)

# ---------------------------------------------------------------- a batch on top of a load


class Stopped(Exception):
    """A load ends half-way."""


_batched: dict[tuple[str, str, str], Warehouse] = {}


def _after_batch(spark: SparkSession, sf_dir: str, kind: str = "once") -> Warehouse:
    """A warehouse of two loads: transactions of two customers in three, then a batch with the
    others and with one transaction in five of the first.

    ``replayed``: the batch is then given again to the warehouse as opened anew. ``resumed``: the
    batch stops in the middle, and goes on in one that is opened anew.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key in _batched:
        return _batched[key]
    lake = warehouse(spark, sf_dir)
    raw = lake.table("RawTransactions")
    late = (F.pmod(F.xxhash64("CustomerID"), F.lit(3)) == 0) | (F.pmod(F.xxhash64("TransactionID"), F.lit(5)) == 0)
    late = F.coalesce(late, F.lit(False))
    settings = replace(SETTINGS, scd_join="date_range") if kind == "date_range" else SETTINGS
    if kind == "replayed":
        two = Warehouse(spark, _after_batch(spark, sf_dir).directory, settings)
        two.apply_batch(raw.where(late), batch_id=1)
    else:
        folder = session_folder(spark, f"batch-{uuid.uuid4().hex}")
        two = Warehouse(spark, folder, settings, raw.where(~late), lake.table("City_Lookup"), land_raw=False)
        two.load()
        if kind == "resumed":

            def stop(step: str) -> None:
                if step == "Fact_Transaction":
                    raise Stopped

            try:
                two.apply_batch(raw.where(late), batch_id=1, after_step=stop)
            except Stopped:
                two = Warehouse(spark, folder, settings)
        two.apply_batch(raw.where(late), batch_id=1)
    _batched[key] = two
    return two


_COMPARED = [
    "CustomerID", "DateKey", "SegmentKey", "TransactionCount", "TotalTransactionAmount", "RecencyScore", "FrequencyScore",
    "LoyaltyScore", "ChurnFlag", "AtRiskFlag", "TrendCategory", "GrowthRate", "FinalAccountBalance",
]


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows(lake: Warehouse) -> DataFrame:
        owners = lake.table("Dim_Customer").select("CustomerKey", "CustomerID")
        return lake.table("Fact_CustomerSnapshot").join(owners, "CustomerKey").select(*_COMPARED)

    return rows(_after_batch(spark, sf_dir)).groupBy("DateKey").agg(
        F.count(F.lit(1)).alias("Customers"),
        F.sum("TransactionCount").alias("Transactions"),
        F.sum("TotalTransactionAmount").cast("decimal(28,2)").alias("Amount"),
        F.sum("LoyaltyScore").cast("decimal(28,2)").alias("Loyalty"),
        F.sum("FinalAccountBalance").cast("decimal(28,2)").alias("Balance"),
        F.count_if("ChurnFlag").alias("Churned"),
        F.sum("SegmentKey").alias("Segments"),
        F.countDistinct("CustomerID").alias("DistinctCustomers"),
    )


add(
    "incremental_equals_full_snapshot",
    _incremental,
    """select DateKey, count(*) as Customers, cast(sum(TransactionCount) as bigint) as Transactions,
        cast(sum(TotalTransactionAmount) as decimal(28,2)) as Amount, cast(sum(LoyaltyScore) as decimal(28,2)) as Loyalty,
        cast(sum(FinalAccountBalance) as decimal(28,2)) as Balance, count(*) filter (where ChurnFlag) as Churned,
        cast(sum(coalesce(SegmentKey, -1)) as bigint) as Segments, count(distinct CustomerID) as DistinctCustomers
       from snap group by DateKey""",
)


def _loaded_once(kind: str) -> Query:
    """Rows and money of the fact and of the snapshot by month, after a batch that came twice or was stopped."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _after_batch(spark, sf_dir, kind)
        of = lambda df, table, month, amount: df.groupBy(month.alias("Month")).agg(
            F.lit(table).alias("TableName"),
            F.count(F.lit(1)).alias("TableRows"),
            F.sum(amount).cast("decimal(28,2)").alias("Amount"),
        )
        fact, snap = lake.table("Fact_Transaction"), lake.table("Fact_CustomerSnapshot")
        month_of = F.concat_ws("-", F.expr("DateKey div 10000"), F.lpad(F.expr("cast(DateKey div 100 % 100 as string)"), 2, "0"))
        return of(fact, "Fact_Transaction", F.col("year_month"), "TransactionAmount").unionByName(
            of(snap, "Fact_CustomerSnapshot", month_of, "TotalTransactionAmount")
        )

    return build


for _kind in ("replayed", "resumed"):
    add(
        f"batch_{_kind}_equals_once",
        _loaded_once(_kind),
        """select strftime(Date, '%Y-%m') as Month, 'Fact_Transaction' as TableName, count(*) as TableRows,
             cast(sum(TransactionAmount) as decimal(28,2)) as Amount from fact group by 1
           union all
           select strftime(MonthEndDate, '%Y-%m'), 'Fact_CustomerSnapshot', count(*),
             cast(sum(TotalTransactionAmount) as decimal(28,2)) from snap group by 1""",
    )


def _incremental_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts after a batch, under the range join: the batch widens windows over older facts of other places."""
    lake = _after_batch(spark, sf_dir, "date_range")
    return _named(lake.table("Fact_Transaction"), lake)


add("incremental_equals_full_date_range", _incremental_range, f"select {_FACT_COLUMNS} from fact_range")

from checks import further  # noqa: E402, F401 - registers more queries

"""Further registered queries: quantiles, rule versions, differences, sketches, paths, quarantine."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.lake import SETTINGS, model, warehouse
from checks.oracle import _BAND, _PREV, _dmy
from checks.queries import _fact, add, on, on_model
from ledgerloom.operators import difference, quality, quantile, rules, snapshot
from ledgerloom.plans import levels, sketches, transitions
from ledgerloom.plans.model import Model, load_model
from ledgerloom.sources.readers import quarantined
from ledgerloom.sources.schemas import SEGMENT_ROWS, SEGMENT_SCHEMA
from ledgerloom.sources.sinks import stage_metrics
from ledgerloom.sources.workspace import cut_lineage, session_folder


def _scratch(spark: SparkSession, name: str) -> str:
    return session_folder(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- many exact quantiles, levels of equal depth

_TENTHS = [i / 10 for i in range(1, 10)]


def _deciles(fact: DataFrame) -> DataFrame:
    found = quantile.exact_quantiles(fact, "TransactionAmount", _TENTHS) or []
    rows = [(i, round(v, 4)) for i, v in enumerate(found, 1)]
    return fact.sparkSession.createDataFrame(rows, "Decile int, Amount double")


add(
    "transaction_deciles",
    on("Fact_Transaction", _deciles),
    f"""select cast(unnest(range(1, 10)) as integer) as Decile,
      round(unnest(quantile_cont(cast(TransactionAmount as double), {_TENTHS})), 4) as Amount from fact""",
)
for _name, _column in (("balance_levels", "FinalAccountBalance"), ("amount_levels", "TotalTransactionAmount")):
    add(
        _name,
        on_model(getattr(levels, _name)),
        """select cast(1 + (select count(*) from borders where border < v) as integer) as Level, min(v) as LowestValue,
             max(v) as HighestValue, count(*) as Customers, cast(sum(v) as decimal(28,2)) as Total from ranked group by 1""",
        ranked=f"""select {_column} as v, row_number() over (order by {_column}) as rn, count(*) over () as n
          from snap where DateKey = (select max(DateKey) from snap)""",
        borders="select i, r.v as border from ranked r, (select unnest(range(1, 10)) as i) t where r.rn = (t.i * r.n + 9) // 10",
    )

# ---------------------------------------------------------------- rules valid in time, rules as rectangles

_TURN = date(1999, 1, 1)
#: The usual rules, of which two have a further version from 1999 on and one ends in spring.
_VERSIONS = [
    *[(*r[:12], date(1998, 1, 1), date(1998, 12, 31) if r[1] in ("RF_Champions", "RF_Loyal") else None) for r in SEGMENT_ROWS if r[1] != "RF_Hibernating"],
    *[(*r[:12], date(1998, 1, 1), date(1999, 5, 15)) for r in SEGMENT_ROWS if r[1] == "RF_Hibernating"],
    (11, "RF_Champions", "Champions", "RF", "From a dozen on", 0, 59, 12, 9999, 1, "#28A745", True, _TURN, None),
    (12, "RF_Loyal", "Loyal Customers", "RF", "Up to eleven", 0, 59, 8, 11, 2, "#17A2B8", True, _TURN, None),
]
_VERSIONS_SQL = ",".join(
    f"({r[0]}, '{r[1]}', {r[5]}, {r[6]}, {r[7]}, {r[8]}, date '{r[12]}', " + (f"date '{r[13]}')" if r[13] else "cast(null as date))")
    for r in _VERSIONS
)


def _by_rule_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    activity, customers, days = (lake.table(n) for n in ("Monthly_Activity", "Dim_Customer", "Dim_Date"))
    scored = snapshot.score_snapshot(snapshot.merge_spine(activity, customers, days, SETTINGS), SETTINGS.seed)
    months = snapshot.month_calendar(days, SETTINGS.start, SETTINGS.cutoff)
    assigned = rules.assign_segment_as_of(scored, spark.createDataFrame(_VERSIONS, SEGMENT_SCHEMA), months)
    return assigned.groupBy("MonthEndDate", "SegmentKey", F.coalesce("SegmentStep", F.lit("None")).alias("SegmentStep")).agg(
        F.count(F.lit(1)).alias("Customers")
    )


_HELD = "s.MonthEndDate between r.StartDate and coalesce(r.EndDate, date '9999-12-31')"
_RISK = f"""r.SegmentCode = 'RF_AtRisk' and {_HELD}
     and DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax and {_PREV} >= r.FrequencyMin"""
add(
    "segments_by_rule_version",
    _by_rule_version,
    f"""select MonthEndDate, coalesce(risk, new, band, -1) as SegmentKey,
          case when risk is not null then 'AtRisk' when new is not null then 'New' when band is not null then 'Range' else 'None' end as SegmentStep,
          count(*) as Customers
        from (select s.MonthEndDate, (select min(r.SegmentKey) from versions_of_rules r where {_RISK}) as risk,
                case when IsFirstMonth then (select min(r.SegmentKey) from versions_of_rules r where r.SegmentCode = 'RF_New' and {_HELD}) end as new,
                (select min(r.SegmentKey) from versions_of_rules r where r.SegmentCode <> 'RF_AtRisk' and {_HELD} and {_BAND}) as band
              from scored s) group by all""",
    versions_of_rules=f"""select * from (values {_VERSIONS_SQL})
      t(SegmentKey, SegmentCode, RecencyMin, RecencyMax, FrequencyMin, FrequencyMax, StartDate, EndDate)""",
)

#: Rules with faults: loyal customers begin at nine, churned ones at 85 days, champions have no end.
_FAULTY = [("RF_Champions", 0, 59, 15, None), ("RF_Loyal", 0, 59, 9, 14), ("RF_Potential", 0, 59, 5, 7), ("RF_New", 0, 30, 0, 4),
           ("RF_AtRisk", 60, 90, 5, 9999), ("RF_Hibernating", 31, 90, 0, 4), ("RF_Churned", 85, None, 0, 9999)]


def _rule_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    faulty = spark.createDataFrame(_FAULTY, "SegmentCode string, RecencyMin int, RecencyMax int, FrequencyMin int, FrequencyMax int")
    points = warehouse(spark, sf_dir).table("Fact_CustomerSnapshot").select("DaysSinceLastTransaction", "TransactionCount")
    return rules.faulty_points(points, rules.rule_faults(faulty))


_null = lambda v: "cast(null as bigint)" if v is None else str(v)
add(
    "dq_rule_plane",
    _rule_plane,
    """select XFrom, XTo, YFrom, YTo, Rules, Names, (select count(*) from snap where DaysSinceLastTransaction >= XFrom
          and (XTo is null or DaysSinceLastTransaction <= XTo) and TransactionCount >= YFrom and (YTo is null or TransactionCount <= YTo)) as Points
       from (select Names, Rules, YFrom, YTo, min(x0) as XFrom, arg_max(coalesce(x1, -1), i) as xe, nullif(xe, -1) as XTo
             from (select *, i - row_number() over (partition by Names, Rules, YFrom, YTo order by i) as run from strips)
             group by Names, Rules, YFrom, YTo, run)""",
    faulty="select * from (values "
    + ",".join(f"('{n}', {a}, {_null(b)}, {c}, {_null(d)})" for n, a, b, c, d in _FAULTY)
    + ") t(name, a, b, c, d)",
    xs="""select x0, lead(x0) over (order by x0) - 1 as x1, row_number() over (order by x0) as i
          from (select 0 as x0 union select a from faulty union select b + 1 from faulty where b is not null)""",
    ys="""select y0, lead(y0) over (order by y0) - 1 as y1, row_number() over (order by y0) as j
          from (select 0 as y0 union select c from faulty union select d + 1 from faulty where d is not null)""",
    cells="""select x0, x1, i, y0, y1, j, coalesce(string_agg(name, ',' order by name), '') as Names, cast(count(name) as integer) as Rules
             from xs cross join ys left join faulty on x0 >= a and (b is null or x0 <= b) and y0 >= c and (d is null or y0 <= d)
             group by all""",
    strips="""select x0, x1, i, Names, Rules, min(y0) as YFrom, nullif(arg_max(coalesce(y1, -1), j), -1) as YTo
              from (select *, j - row_number() over (partition by i, Names, Rules order by j) as run from cells where Rules <> 1)
              group by x0, x1, i, Names, Rules, run""",
)

# ---------------------------------------------------------------- reconciliation row by row

_LAST_TWO = "right(TransactionID, 2)"
add(
    "reconciliation_by_reason",
    lambda s, d: quality.reconciliation_by_reason(*(warehouse(s, d).table(n) for n in ("RawTransactions", "Fact_Transaction", "Dim_Date"))),
    f"""select Reason, Records from (select unnest(['no transaction id', 'no customer', 'no date', 'unreadable date', 'date outside the calendar']) as Reason) t
          left join (select Reason, count(*) as Records from reasons group by 1) using (Reason) where Records is not null
        union all select Reason, 0 from (select unnest(['no transaction id', 'no customer', 'no date', 'unreadable date', 'date outside the calendar']) as Reason)
          where Reason not in (select Reason from reasons where Reason is not null)
        union all select 'fact', count(*) from fact
        union all select 'unexplained', (select count(*) from reasons where Reason is null) - (select count(*) from fact)""",
    reasons=f"""select case when TransactionID is null then 'no transaction id'
        when CustomerID is null or trim(CustomerID) = 'nan' then 'no customer'
        when TransactionDate is null or TransactionDate = 'nan' then 'no date'
        when {_dmy('trim(TransactionDate)')} is null then 'unreadable date'
        when {_dmy('trim(TransactionDate)')} not in (select Date from dim_date) then 'date outside the calendar' end as Reason from raw""",
)


def _changed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts against a copy in which some are missing, some dearer, some doubled and some new."""
    stored = cut_lineage(_fact("version_key")(spark, sf_dir), f"difference-{uuid.uuid4().hex}")
    last = F.right("TransactionID", F.lit(2))
    dearer = F.when(last == "23", F.col("TransactionAmount") + 1).otherwise(F.col("TransactionAmount")).cast("decimal(18,2)")
    copies = F.explode(F.sequence(F.lit(1), F.when(last == "31", 2).otherwise(1)))
    other = stored.where(last != "17").withColumn("TransactionAmount", dearer).withColumn("_n", copies).drop("_n")
    new = stored.where(last == "47").withColumn("TransactionID", F.concat(F.lit("X"), "TransactionID"))
    return difference.table_difference(stored, other.unionByName(new), ["TransactionID"])


add(
    "table_difference",
    _changed_table,
    f"""select TransactionID, count(*) as LeftRows, case {_LAST_TWO} when '17' then 0 when '31' then 2 * count(*) else count(*) end as RightRows,
          case {_LAST_TWO} when '17' then 'removed' else 'changed' end as Change from fact where {_LAST_TWO} in ('17', '23', '31') group by 1
        union all select 'X' || TransactionID, 0, count(*), 'added' from fact where {_LAST_TWO} = '47' group by 1""",
)


def _changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of 64 buckets an equal copy, dealt out anew, and a copy without one customer differ in."""
    stored = cut_lineage(_fact("version_key")(spark, sf_dir), f"difference-{uuid.uuid4().hex}")
    digest = lambda df: difference.bucket_digests(df, ["CustomerID"], 64)
    known = cut_lineage(digest(stored), f"digests-{uuid.uuid4().hex}")  # 64 rows
    count = lambda df: len(difference.differing_buckets(known, digest(df)))
    without = stored.where(F.col("CustomerID") != F.lit(stored.agg(F.min("CustomerID")).first()[0]))
    return spark.createDataFrame(
        [("equal copy", count(stored.repartition("TransactionID"))), ("without a customer", count(without))], "Copy string, DifferingBuckets int"
    )


add(
    "differing_buckets",
    _changed_buckets,
    """select 'equal copy' as Copy, cast(0 as integer) as DifferingBuckets
       union all select 'without a customer', cast(count(distinct CustomerID) as integer) from fact where CustomerID = (select min(CustomerID) from fact)""",
)
add(
    "dq_required_columns_of_all_tables",
    lambda s, d: quality.required_columns({n: warehouse(s, d).table(n) for n in quality.REQUIRED}),
    "select unnest(["
    + ", ".join(f"{{'TableName': '{t}', 'ColumnName': '{c}', 'NullRows': cast(0 as bigint)}}" for t, cs in quality.REQUIRED.items() for c in cs)
    + "], recursive := true) from (select count(*) from fact)",
)

# ---------------------------------------------------------------- sketches


def _stored_sketches(m: Model, by: list[str]) -> DataFrame:
    return cut_lineage(sketches.customer_sketches(m, by), f"sketches-{uuid.uuid4().hex}")


def _within(estimate: str, exact: str, of: str):
    allowed = F.col(of) * sketches.relative_bound()
    return (F.abs(F.coalesce(estimate, F.lit(0)) - F.col(exact)) <= allowed).alias("WithinBound")


def _over_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir)
    keys = [x["DateKey"] for x in m.months]
    first, last = min(keys), sorted(keys)[len(keys) // 2]
    estimated = sketches.distinct_over(_stored_sketches(m, ["State"]), first, last, ["State"])
    places = m.dim_customer.join(m.dim_location, "LocationKey", "left").select("CustomerKey", "State")
    rows = m.snapshot.where(F.col("DateKey") <= last).join(places, "CustomerKey", "left")
    exact = rows.groupBy("State").agg(F.countDistinct("CustomerKey").alias("Customers"))
    same = exact["State"].eqNullSafe(estimated["State"])
    return exact.join(estimated, same, "left").select(exact["State"], "Customers", _within("DistinctCustomers", "Customers", "Customers"))


add(
    "customers_over_months",
    _over_months,
    """select State, count(distinct CustomerID) as Customers, true as WithinBound from w
       where DateKey <= (select list_sort(list(distinct DateKey))[1 + count(distinct DateKey) // 2] from w) group by 1""",
)


def _shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir)
    estimated = sketches.month_overlap(_stored_sketches(m, []))
    now = m.snapshot.select("DateKey", "CustomerKey")
    pairs = estimated.select("DateKey", "NextKey")
    then = now.withColumnRenamed("DateKey", "NextKey")
    exact = (
        now.join(F.broadcast(pairs), "DateKey")
        .join(then, ["NextKey", "CustomerKey"])
        .groupBy("DateKey", "NextKey")
        .agg(F.count(F.lit(1)).alias("Exact"))
    )
    sizes = now.groupBy("DateKey").agg(F.count(F.lit(1)).alias("Rows"))
    both = estimated.join(exact, ["DateKey", "NextKey"], "left").join(sizes, "DateKey").withColumn("Shared", F.coalesce("Exact", F.lit(0)))
    return both.select("DateKey", "NextKey", F.col("Shared").alias("SharedCustomers"), _within("SharedCustomers", "Shared", "Rows"))


add(
    "month_overlap",
    _shared,
    """select m.DateKey, m.NextKey, (select count(*) from snap a join snap b on a.CustomerID = b.CustomerID
         where a.DateKey = m.DateKey and b.DateKey = m.NextKey) as SharedCustomers, true as WithinBound
       from months m where NextKey is not null""",
)

# ---------------------------------------------------------------- paths

_STAGE = "case SegmentKey when 4 then 1 when 3 then 2 when 2 then 3 end"
add(
    "loyalty_paths",
    on_model(transitions.loyalty_paths),
    """select case best when 0 then 'none' when 1 then 'New' when 2 then 'New > Potential' else 'New > Potential > Loyal' end as Path,
         Months, count(*) as Customers
       from (select CustomerID, max(stage) as best, case when max(stage) > 0 then arg_max(took, stage * 100000 - n) end as Months from walked group by 1)
       group by all""",
    seen=f"""select CustomerID, year(MonthEndDate) * 12 + month(MonthEndDate) as m, {_STAGE} as s,
               row_number() over (partition by CustomerID order by MonthEndDate) as n from snap where {_STAGE} is not null""",
    walked="""
with recursive walk(CustomerID, n, stage, last, entry, took) as (
  select distinct CustomerID, cast(0 as bigint), 0, 0, 0, 0 from snap
  union all
  select CustomerID, n, case when s = st + 1 then st + 1 else st end,
    case when s = st + 1 or (st > 0 and s = st) then m else last end,
    case when s = st + 1 and st = 0 then m else entry end,
    case when s = st + 1 and st > 0 then m - entry when s = st + 1 then 0 else took end
  from (select w.CustomerID, e.n, e.m, e.s, w.last, w.entry, w.took,
          case when w.stage = 3 or (w.stage > 0 and e.m - w.last <= 3) then w.stage else 0 end as st
        from walk w join seen e on e.CustomerID = w.CustomerID and e.n = w.n + 1))
select * from walk""",
)

# ---------------------------------------------------------------- quarantine

_CSV_LINE = (
    "concat_ws(',', coalesce(TransactionID, ''), coalesce(CustomerID, ''), coalesce(CustomerDOB, ''), coalesce(CustGender, ''), "
    "case when right(TransactionID, 2) = '31' then concat('\"', coalesce(CustLocation, ''), ', India\"') else coalesce(CustLocation, '') end, "
    "coalesce(CustAccountBalance, ''), coalesce(TransactionDate, '')"
)
#: Two fields too few for some, one too many for others.
CSV_TEXT = (
    f"case right(TransactionID, 2) when '17' then {_CSV_LINE}) when '23' then {_CSV_LINE}, coalesce(TransactionTime, ''), "
    f"coalesce(TransactionAmount, ''), 'more') else {_CSV_LINE}, coalesce(TransactionTime, ''), coalesce(TransactionAmount, '')) end"
)


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = warehouse(spark, sf_dir).table("RawTransactions")
    folder = _scratch(spark, "quarantine")
    raw.select(F.expr(CSV_TEXT)).write.text(f"{folder}/csv", lineSep="\n")
    kept, rejected = quarantined(spark, f"{folder}/csv", f"{folder}/kept", f"{folder}/rejected", header=False)
    accounted = kept.count() + rejected.count() == raw.count()
    return rejected.select("Rule", "Fields", "RawText", F.lit(accounted).alias("AllAccountedFor"))


add(
    "quarantined_rows",
    _quarantined,
    f"""select case right(TransactionID, 2) when '17' then 'too few fields' else 'too many fields' end as Rule,
          cast(case right(TransactionID, 2) when '17' then 7 else 10 end as integer) as Fields, {CSV_TEXT} as RawText, true as AllAccountedFor
        from raw where right(TransactionID, 2) in ('17', '23')""",
)

# ---------------------------------------------------------------- the model as reports import it


def _imported(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = warehouse(spark, sf_dir)
    lake.load()
    m = load_model(spark, lake.directory, SETTINGS, current_only=True)
    tables = {"Fact_CustomerSnapshot": m.snapshot, "Dim_Customer": m.dim_customer, "Dim_Segment": m.dim_segment, "Dim_Location": m.dim_location}
    return stage_metrics(spark, tables).withColumnsRenamed({"stage": "TableName", "rows": "TableRows"})


add(
    "imported_tables",
    _imported,
    """select 'Fact_CustomerSnapshot' as TableName, count(*) as TableRows from snap
       union all select 'Dim_Customer', count(*) from dim_customer where IsCurrent
       union all select 'Dim_Segment', count(*) from rules
       union all select 'Dim_Location', count(*) from dim_location""",
)

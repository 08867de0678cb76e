"""The same answers in DuckDB SQL, written from the definitions and apart from the Spark code.

Each query is a list of the named steps below that it needs, and a final SELECT.
"""

from __future__ import annotations

import re

from checks.raw_sql import CITY_SQL, RAW_SQL

_TABLES = {t: t for t in ("lineitem", "orders", "nation", "region")}

START, CUTOFF, AS_OF, SEED = "date '1998-01-01'", "date '1999-08-31'", "date '2016-08-31'", "42"


def _clean(col: str) -> str:
    return f"case when trim({col}) <> 'nan' then trim({col}) end"


def _clean_untrimmed(col: str) -> str:
    return f"case when {col} <> 'nan' then trim({col}) end"


def _dmy(col: str) -> str:
    return f"cast(try_strptime({col}, '%d/%m/%Y') as date)"


def _money(col: str) -> str:
    plain = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$'"
    return f"coalesce(case when regexp_matches({col}, {plain}) then try_cast({col} as decimal(18,2)) end, 0)::decimal(18,2)"


def _code(col: str) -> str:
    return f"upper(replace(trim({col}), ' ', '_'))"


def _key(col: str) -> str:
    return f"cast(year({col}) * 10000 + month({col}) * 100 + day({col}) as integer)"


def _average(total: str, n: str) -> str:
    """Decimal average, half-up to six digits and then to two, in whole numbers."""
    cents = f"cast({total} as hugeint)"
    return (
        f"cast(cast((({cents} * 20000 + {n}) // (2 * {n}) + 5000) // 10000 as decimal(18,2)) "
        f"* cast(0.01 as decimal(3,2)) as decimal(18,2))"
    )


def _pct(n: str, total: str, digits: int = 2) -> str:
    """Percent of a total, half-up, in whole numbers."""
    unit = 10**digits
    return (
        f"cast(cast(({n} * 200 * {unit} + {total}) // (2 * {total}) as decimal(18,{digits})) "
        f"* cast({1 / unit} as decimal(4,{digits})) as decimal(7,{digits}))"
    )


def _demographics(dob: str) -> str:
    return f"""
select CustomerID, max({dob}) as DateOfBirth,
       max(case when upper(trim(Gender)) in ('M', 'MALE') then 'Male'
                when upper(trim(Gender)) in ('F', 'FEMALE') then 'Female' else 'Unknown' end) as Gender
from stg_customer where CustomerID is not null group by CustomerID"""


def _customer(demographics: str, oldest: str, kind: str) -> str:
    return f"""
select *, case when Age between 18 and 25 then '18-25' when Age between 26 and 35 then '26-35'
               when Age between 36 and 45 then '36-45' when Age between 46 and 55 then '46-55'
               when {oldest} then '56+' else 'Unknown' end as AgeGroup
from (select v.CustomerID, p.DateOfBirth,
             cast(year({AS_OF}) - year(DateOfBirth) - case when month(DateOfBirth) > month({AS_OF})
                  or (month(DateOfBirth) = month({AS_OF}) and day(DateOfBirth) > day({AS_OF})) then 1 else 0 end
                  as integer) as Age,
             p.Gender, v.Location, l.LocationCode, {kind} as CustomerType, v.StartDate as FirstTransactionDate,
             v.StartDate, v.EndDate, v.IsCurrent, v.FirstTransactionDateEver, v.LocationMatch
      from versions v join {demographics} p on v.CustomerID = p.CustomerID
      left join dim_location l on l.LocationCode = {_code('v.Location')})"""


_DOB = f"case when year({_dmy('DOB')}) between 1930 and 2005 then {_dmy('DOB')} end"
_SPINE_AMOUNTS = ("TotalTransactionAmount", "AvgTransactionAmount", "MinTransactionAmount", "MaxTransactionAmount")


def _spine(act: str, first: str) -> str:
    return f"""
select p.CustomerID, m.MonthEndDate, m.MonthEndDateKey
from (select c.CustomerID, c.{first} as first_date, max(a.LastTxDateInMonth) as last_date
      from dim_customer c join {act} a on a.CustomerID = c.CustomerID where c.IsCurrent group by 1, 2) p,
     (select last_day(Date) as MonthEndDate, max(DateKey) as MonthEndDateKey from dim_date
      where Date between {START} and {CUTOFF} group by 1) m
where m.MonthEndDate >= p.first_date and m.MonthEndDate <= {CUTOFF}
  and ((m.MonthEndDate >= p.last_date and m.MonthEndDate <= p.last_date + interval 12 month)
       or exists (select 1 from {act} a where a.CustomerID = p.CustomerID and a.MonthEndDate = m.MonthEndDate))"""


def _merged(spine: str, act: str, carry: str) -> str:
    zeroed = ", ".join(f"coalesce(a.{c}, 0)::decimal(18,2) as {c}" for c in _SPINE_AMOUNTS)
    running = "over (partition by s.CustomerID order by s.MonthEndDate rows unbounded preceding)"
    balance = f"max(a.MonthEndBalance) {running}" if carry == "max" else f"last_value(a.MonthEndBalance ignore nulls) {running}"
    return f"""
select s.CustomerID, s.MonthEndDate, s.MonthEndDateKey, coalesce(a.TransactionCount, 0) as TransactionCount, {zeroed},
       coalesce(b.TransactionCount, 0) as PreviousMonthTransactionCount, b.CustomerID is null as IsFirstMonth,
       max(a.LastTxDateInMonth) {running} as RunningLastTxDate,
       coalesce(a.MonthEndBalance, {balance}) as FinalAccountBalance
from {spine} s
left join {act} a on a.CustomerID = s.CustomerID and a.MonthEndDate = s.MonthEndDate
left join {act} b on b.CustomerID = s.CustomerID
     and b.MonthEndDate = last_day(cast(s.MonthEndDate - interval 1 month as date))"""


def _activity(keys: str, source: str) -> str:
    return f"""
select {keys}, last_day(Date) as MonthEndDate, count(*) as TransactionCount,
       cast(sum(TransactionAmount) as decimal(18,2)) as TotalTransactionAmount,
       {_average('sum(cast(TransactionAmount * 100 as bigint))', 'count(*)')} as AvgTransactionAmount,
       min(TransactionAmount) as MinTransactionAmount, max(TransactionAmount) as MaxTransactionAmount,
       max(Date) as LastTxDateInMonth, max(AccountBalance) as MonthEndBalance,
       cast(year(max(Date)) as integer) as TxYear, cast(month(max(Date)) as integer) as TxMonth
from {source} where Date <= {CUTOFF} group by {keys}, last_day(Date)"""


def _number(first: int) -> str:
    text = f"CustomerID || '|' || cast(MonthEndDateKey as varchar) || '|{SEED}'"
    return f"cast('0x' || substr(md5({text}), {first}, 8) as bigint)"


_CHANGE, _PREV = "(TransactionCount - PreviousMonthTransactionCount)", "PreviousMonthTransactionCount"
_GROWTH = f"({_CHANGE} * 100.0 / nullif({_PREV}, 0))"
_SCORED = f"""
select *, cast(RecencyScore * 0.3 + FrequencyScore * 0.7 as decimal(5,2)) as LoyaltyScore,
  coalesce(DaysSinceLastTransaction > 90, false) as ChurnFlag,
  coalesce(DaysSinceLastTransaction between 60 and 90, false) as AtRiskFlag,
  case when {_PREV} = 0 then null
       when {_CHANGE} * 10000 > 99999 * {_PREV} then cast(999.99 as decimal(5,2))
       when {_CHANGE} * 10000 < -9999 * {_PREV} then cast(-99.99 as decimal(5,2))
       else cast(sign({_CHANGE}) * cast((abs({_CHANGE}) * 20000 + {_PREV}) // (2 * {_PREV}) as decimal(10,2))
                 * cast(0.01 as decimal(3,2)) as decimal(5,2)) end as GrowthRate,
  case when DaysSinceLastTransaction > 90 then 'Churned' when {_PREV} = 0 then 'New'
       when {_CHANGE} * 100 > 20 * {_PREV} then 'Strong Growth'
       when {_CHANGE} * 100 > 5 * {_PREV} then 'Moderate Growth'
       when abs({_CHANGE}) * 100 <= 5 * {_PREV} then 'Stable'
       when {_CHANGE} * 100 >= -20 * {_PREV} then 'Moderate Decline' else 'Sharp Decline' end as TrendCategory,
  cast((case when RecencyScore >= 4 and FrequencyScore >= 4 then 400 + {_number(1)} % 101
             when RecencyScore <= 2 and FrequencyScore <= 2 then 100 + {_number(1)} % 151
             else 250 + {_number(1)} % 151 end)::decimal(5,2) * cast(0.01 as decimal(3,2)) as decimal(3,2)) as SatisfactionScore,
  ({_PREV} > 0 and {_CHANGE} * 100 < -30 * {_PREV} and {_number(9)} % 100 < 70) as ComplaintFlag
from (select *,
  case when DaysSinceLastTransaction <= 30 then 5 when DaysSinceLastTransaction <= 60 then 4
       when DaysSinceLastTransaction <= 90 then 3 when DaysSinceLastTransaction <= 180 then 2 else 1 end as RecencyScore,
  case when TransactionCount >= 15 then 5 when TransactionCount >= 10 then 4 when TransactionCount >= 5 then 3
       when TransactionCount >= 2 then 2 when TransactionCount >= 1 then 1 else 0 end as FrequencyScore
  from (select *, cast(datediff('day', RunningLastTxDate, MonthEndDate) as integer) as DaysSinceLastTransaction from merged))"""

_BAND = """DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax
           and TransactionCount between r.FrequencyMin and r.FrequencyMax"""

# name -> (text, steps it reads)
STEPS: dict[str, str] = {
    "raw": RAW_SQL.format(**_TABLES),
    "city": CITY_SQL.format(**_TABLES),
    "stg_transaction": f"""
select trim(TransactionID) as TransactionID, upper({_clean('CustomerID')}) as CustomerID,
       {_clean_untrimmed('TransactionDate')} as TransactionDate,
       {_clean_untrimmed('TransactionAmount')} as TransactionAmount,
       {_clean_untrimmed('CustAccountBalance')} as AccountBalance, {_clean('CustLocation')} as CustLocation
from raw where TransactionID is not null""",
    "stg_customer": f"""
select upper({_clean('CustomerID')}) as CustomerID, {_clean('CustLocation')} as Location,
       {_clean_untrimmed('CustomerDOB')} as DOB, {_clean('CustGender')} as Gender
from (select distinct CustomerID, CustLocation, CustomerDOB, CustGender from raw where CustomerID is not null)""",
    "stg_location": f"select distinct {_clean('CustLocation')} as Location from raw where {_clean('CustLocation')} is not null",
    "dim_date": """
select cast(d as date) as Date,
       cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as DateKey, strftime(d, '%Y-%m') as YearMonth
from generate_series(timestamp '1998-01-01', timestamp '2000-12-31', interval 1 day) g(d)""",
    "dim_location": f"""
select c.LocationCode, c.LocationName, coalesce(k.State, 'Unknown') as State, coalesce(k.Region, 'Unknown') as Region
from (select {_code('Location')} as LocationCode, min(Location) as LocationName from stg_location group by 1) c
left join city k on upper(trim(k.CityName)) = upper(c.LocationName)""",
    "location_history": f"""
select CustomerID, min(loc) as Location, upper(loc) as LocationMatch, min(d) as LocStartDate, max(d) as LocEndDate,
       count(d) as DatedRows
from (select CustomerID, coalesce({_clean('CustLocation')}, 'Unspecified') as loc, {_dmy('TransactionDate')} as d
      from stg_transaction where CustomerID is not null)
group by CustomerID, upper(loc)""",
    "demographics": _demographics(_DOB),
    "demographics_1900": _demographics(f"coalesce({_dmy('DOB')}, date '1900-01-01')"),
    "versions": """
select CustomerID, Location, LocationMatch, LocStartDate as StartDate,
       case when rn > 1 then LocEndDate end as EndDate, rn = 1 as IsCurrent,
       min(LocStartDate) over (partition by CustomerID) as FirstTransactionDateEver
from (select *, row_number() over (partition by CustomerID order by LocEndDate desc, Location) as rn
      from location_history where LocStartDate is not null)""",
    "dim_customer": _customer("demographics", "Age >= 56", "'Existing'"),
    "dim_customer_other": _customer(
        "demographics_1900",
        "Age > 56",
        f"case when datediff('day', v.StartDate, {AS_OF}) <= 90 then 'New' else 'Existing' end",
    ),
    "dated": f"""
select * from (select TransactionID, CustomerID, {_dmy('TransactionDate')} as Date, CustLocation,
       upper(coalesce(CustLocation, 'Unspecified')) as LocationMatch,
       {_money('TransactionAmount')} as TransactionAmount, {_money('AccountBalance')} as AccountBalance
from stg_transaction where CustomerID is not null and TransactionDate is not null)
where Date in (select Date from dim_date)""",
    "fact": f"""
select t.TransactionID, t.CustomerID, c.LocationMatch, c.IsCurrent, t.Date, {_key('t.Date')} as DateKey,
       l.LocationCode, t.TransactionAmount, t.AccountBalance
from dated t join dim_customer c on c.CustomerID = t.CustomerID and c.LocationMatch = t.LocationMatch
left join dim_location l on l.LocationCode = {_code('t.CustLocation')}""",
    "fact_range": f"""
select t.TransactionID, t.CustomerID, c.LocationMatch, c.IsCurrent, t.Date, {_key('t.Date')} as DateKey,
       l.LocationCode, t.TransactionAmount, t.AccountBalance
from dated t join dim_customer c on c.CustomerID = t.CustomerID
     and t.Date between c.StartDate and coalesce(c.EndDate, date '9999-12-31')
left join dim_location l on l.LocationCode = {_code('t.CustLocation')}""",
    "activity": _activity("CustomerID, LocationMatch, IsCurrent", "fact"),
    "current_activity": "select * from activity where IsCurrent",
    "whole_activity": _activity("CustomerID", "fact"),
    "spine": _spine("current_activity", "FirstTransactionDate"),
    "whole_spine": _spine("whole_activity", "FirstTransactionDateEver"),
    "merged": _merged("spine", "current_activity", "max"),
    "merged_last": _merged("spine", "current_activity", "last"),
    "whole_merged": _merged("whole_spine", "whole_activity", "max"),
    "scored": _SCORED,
    "rules": """
select * from (values (1, 'RF_Champions', 'Champions', 0, 59, 15, 9999, 1), (2, 'RF_Loyal', 'Loyal Customers', 0, 59, 8, 14, 2),
 (3, 'RF_Potential', 'Potential Loyalists', 0, 59, 5, 7, 3), (4, 'RF_New', 'New Customers', 0, 30, 0, 4, 4),
 (5, 'RF_AtRisk', 'At Risk', 60, 90, 5, 9999, 5), (6, 'RF_Hibernating', 'Hibernating', 31, 90, 0, 4, 6),
 (7, 'RF_Churned', 'Churned', 91, 9999, 0, 9999, 7))
 t(SegmentKey, SegmentCode, SegmentName, RecencyMin, RecencyMax, FrequencyMin, FrequencyMax, DisplayOrder)""",
    "segmented": f"""
select s.*, coalesce(
  (select min(r.SegmentKey) from rules r where r.SegmentCode = 'RF_AtRisk'
     and DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax and {_PREV} >= r.FrequencyMin),
  case when IsFirstMonth then 4 end,
  (select min(r.SegmentKey) from rules r where r.SegmentCode <> 'RF_AtRisk' and {_BAND}), -1) as SegmentKey,
  coalesce((select min('AtRisk') from rules r where r.SegmentCode = 'RF_AtRisk'
     and DaysSinceLastTransaction between r.RecencyMin and r.RecencyMax and {_PREV} >= r.FrequencyMin),
  case when IsFirstMonth then 'New' end,
  (select min('Range') from rules r where r.SegmentCode <> 'RF_AtRisk' and {_BAND}), 'None') as SegmentStep
from scored s""",
    "snap": """
select CustomerID, MonthEndDateKey as DateKey, SegmentKey, TransactionCount, TotalTransactionAmount,
       AvgTransactionAmount, MinTransactionAmount, MaxTransactionAmount, DaysSinceLastTransaction, RecencyScore,
       FrequencyScore, LoyaltyScore, SatisfactionScore, ComplaintFlag, ChurnFlag, AtRiskFlag, TrendCategory,
       PreviousMonthTransactionCount, GrowthRate, coalesce(FinalAccountBalance, 0)::decimal(18,2) as FinalAccountBalance,
       MonthEndDate
from segmented""",
    "w": """
select s.*, r.SegmentCode, r.SegmentName, r.DisplayOrder, c.Gender, c.AgeGroup, c.Location, l.State, l.Region, l.LocationName,
       cast(year(MonthEndDate) as integer) as Year, strftime(MonthEndDate, '%Y-%m') as YearMonth,
       case when ChurnFlag then 'Churned' when GrowthRate > 20 then 'Growing' when GrowthRate < -20 then 'Declining'
            else 'Stable' end as GrowthCategory,
       case when coalesce(DaysSinceLastTransaction, 0) <= 30 then '0-30 days' when DaysSinceLastTransaction <= 60 then '31-60 days'
            when DaysSinceLastTransaction <= 90 then '61-90 days' when DaysSinceLastTransaction <= 180 then '91-180 days'
            else '180+ days' end as RecencyBucket,
       case when LoyaltyScore >= 4 then 'High (4-5)' when LoyaltyScore >= 2.5 then 'Medium (2.5-4)' else 'Low (<2.5)' end as LoyaltyBand
from snap s left join rules r on r.SegmentKey = s.SegmentKey
left join dim_customer c on c.CustomerID = s.CustomerID and c.IsCurrent
left join dim_location l on l.LocationCode = c.LocationCode""",
    "k": f"""
select a, p, {_key("last_day(cast(ad - interval 3 month as date))")} as q,
       {_key("last_day(cast(ad - interval 12 month as date))")} as y
from (select max(DateKey) as a, max(MonthEndDate) as ad, max(DateKey) filter (where DateKey < (select max(DateKey) from snap)) as p
      from snap)""",
    "months": "select DateKey, lead(DateKey) over (order by DateKey) as NextKey from (select distinct DateKey from snap)",
    "pairs": """
select s.*, m.NextKey, n.SegmentKey as NextSegment, (not n.ChurnFlag and not n.AtRiskFlag) as NextActive,
       n.TransactionCount > 0 as NextTransacts
from w s join months m on m.DateKey = s.DateKey
left join snap n on n.CustomerID = s.CustomerID and n.DateKey = m.NextKey
where m.NextKey is not null""",
    "streaks": """
select CustomerID, DateKey, sum(case when falls then 1 else 0 end) over (partition by CustomerID, run order by DateKey) as DecliningMonths
from (select *, sum(case when falls then 0 else 1 end) over (partition by CustomerID order by DateKey) as run
from (select s.CustomerID, s.DateKey, coalesce(s.GrowthRate < b.GrowthRate, false) as falls from snap s
      left join snap b on b.CustomerID = s.CustomerID
           and b.MonthEndDate = last_day(cast(s.MonthEndDate - interval 1 month as date))))""",
}
_FROM_GIVEN = {"raw", "city"}  # these read the given tables alone
_ONCE = {"raw", "stg_transaction", "fact", "fact_range", "activity", "whole_activity", "dim_customer", "spine", "snap", "w"}


def sql(select: str, **more: str) -> str:
    """A statement: the steps that ``select`` names, directly or through others, and itself."""
    steps = {**STEPS, **more}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in steps:
            if name not in needed and re.search(rf"\b(from|join|,)\s*{name}\b", text):
                if name not in _FROM_GIVEN:
                    visit(steps[name])
                needed.append(name)

    visit(select)
    parts = [f"{n} as {'materialized ' if n in _ONCE else ''}({steps[n]})" for n in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select

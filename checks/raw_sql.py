"""Raw transactions made from the given tables, in text both Spark and DuckDB run.

Every line item is one transaction of the customer who placed the order; no row is left
out. The customer's number decides the stretch of days its transactions fall in, so that
steady, growing, fading, returning, silent and lost customers all occur, and some
customers move between cities. The raw columns are text with the usual gaps and errors.
"""

RAW_SQL = """
with b as (
  select o_custkey as cid, l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_suppkey as sk,
         l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7 + l_suppkey * 3 as mix,
         cast(l_extendedprice as decimal(18,2)) as amt, cast(o_totalprice as decimal(18,2)) as bal
  from {lineitem} join {orders} on l_orderkey = o_orderkey),
s as (
  select *,
         case cid % 12
           when 0 then mix % 400
           when 1 then 548 + mix % 60
           when 2 then case when mix % 2 = 0 then mix % 90 else 420 + mix % 188 end
           when 5 then 488 + mix % 120
           when 6 then 408 + mix % 200
           when 7 then 200 + mix % 358
           when 8 then case when mix % 178 < 70 then 430 + mix % 70 else 546 end
           when 9 then cast(floor((mix % 608) * (mix % 97) / 97) as bigint)
           when 10 then 300 + mix % 150
           when 11 then 607 - cast(floor((mix % 608) * (mix % 89) / 89) as bigint)
           else mix % 608 end as day_no
  from b),
t as (
  select *, date '1998-01-01' + cast(day_no as int) as d,
         (cid + case when cid % 3 = 0 and day_no between 243 and 395 then 1
                     when cid % 6 = 3 and day_no > 395 then 2 else 0 end) % 25 as loc_id
  from s)
select 'T' || cast(cid as string) || '_' || cast(ok as string) || '_' || cast(ln as string) || '_'
           || cast(pk as string) || '_' || cast(sk as string) as TransactionID,
       case when (ok + ln) % 499 = 0 then null when (ok + ln) % 503 = 0 then 'nan'
            else 'C' || cast(cid as string) end as CustomerID,
       case when cid % 7 = 0 then 'nan'
            when cid % 11 = 0 then '1/1/1800'
            else cast(1 + cid % 28 as string) || '/' || cast(1 + cid % 12 as string) || '/'
                 || cast(1930 + cid % 76 as string) end as CustomerDOB,
       case when cid % 13 = 0 then 'nan' when cid % 5 = 0 then ' m ' when cid % 2 = 0 then 'M'
            when cid % 17 = 0 then 'Female' else 'F' end as CustGender,
       case when (ok + 2 * ln) % 389 = 0 then 'nan' when ok % 10 = 3 then ' ' || replace(n_name, '_', ' ') || ' '
            else replace(n_name, '_', ' ') end as CustLocation,
       case when (ok + 3 * ln) % 307 = 0 then 'nan' else cast(bal as string) end as CustAccountBalance,
       case when (ok + 5 * ln) % 211 = 0 then 'nan' when (ok + 5 * ln) % 223 = 0 then '31/2/1998'
            else cast(day(d) as string) || '/' || cast(month(d) as string) || '/' || cast(year(d) as string)
            end as TransactionDate,
       cast(((ok * 13 + ln) % 24) * 10000 + (ok % 60) * 100 + ln as string) as TransactionTime,
       case when (ok + 7 * ln) % 97 = 0 then 'nan' when (ok + 7 * ln) % 101 = 0 then 'abc'
            else cast(amt as string) end as TransactionAmount
from t join {nation} on n_nationkey = loc_id
"""

# two cities are listed under names that no transaction uses, so the lookup has gaps
CITY_SQL = """
select replace(n_name, '_', ' ') || case when n_nationkey >= 23 then ' (former name)' else '' end as CityName,
       'STATE ' || cast(n_nationkey % 8 as string) as State, r_name as Region
from {nation} join {region} on n_regionkey = r_regionkey
"""

"""SQL fragments shared by the checks; they run outside Spark on the same tables."""

from __future__ import annotations

PRICES = ["open", "high", "low", "close", "volume"]

BARS = """bars as (
  select event_type as symbol, date_trunc('hour', ts) as date,
         min_by(value, row(ts, event_id)) as open, max(value) as high, min(value) as low,
         max_by(value, row(ts, event_id)) as close, round(sum(value), 6) as volume
  from events group by 1, 2)"""

HOUR = "(cast(epoch(date) as bigint) // 3600)"

MINUTE_BARS = BARS.replace("'hour'", "'minute'")

MINUTE = "(cast(epoch(date) as bigint) // 60)"


def _indexed(bars: str) -> str:
    return f"""{bars}, indexed as (
  select *, row_number() over (partition by symbol order by date) - 1 as row_idx from bars)"""


def _parted(bars: str) -> str:
    """Those after the first 70 % of a symbol's bars are for testing."""
    return f"""{_indexed(bars)}, parted as (
  select i.*, first_test, row_idx >= first_test as is_test
  from indexed i join (select symbol, cast(ceil(count(*) * 7e-1) as bigint) as first_test
                       from bars group by 1) s using (symbol))"""


INDEXED = _indexed(BARS)
PARTED = _parted(BARS)
MINUTE_PARTED = _parted(MINUTE_BARS)

SURVEY = """v as (
  select c_nationkey as k,
    avg(case when o_orderstatus = 'F' then 1e0 else 0e0 end) as y1,
    avg(case when o_orderstatus = 'P' then 1e0 else 0e0 end) as y2,
    avg(case when o_orderpriority like '1%' then 1e0 else 0e0 end) as y3,
    avg(case when o_orderpriority like '2%' then 1e0 else 0e0 end) as y4,
    avg(case when o_totalprice > 150000 then 1e0 else 0e0 end) as y5
  from customer join orders on c_custkey = o_custkey group by 1),
 pop as (select c_nationkey as k, count(*) as pop from customer group by 1),
 staff as (select s_nationkey as k, count(*) as staff from supplier group by 1),
 back as (
  select c_nationkey as k, sum(case when l_returnflag = 'R' then 1 else 0 end) as returned
  from customer left join orders on c_custkey = o_custkey
       left join lineitem on l_orderkey = o_orderkey group by 1),
 st as (
  select v.*, cast(staff as double) / pop as x1, cast(returned as double) / pop as x2
  from v join pop using (k) join staff using (k) join back using (k))"""

PAIRS = SURVEY + """, pairs as (
  """ + " union all ".join(
    f"select 'y{i}~x{j}' as pair, k as row_key, x{j} as x, y{i} as y from st"
    for i in range(1, 6)
    for j in (1, 2)
) + ")"


def r(expression: str, digits: int = 6) -> str:
    """Counterpart of ``functions.values.rounded``."""
    return f"round(({expression}) + 1e-9, {digits})"

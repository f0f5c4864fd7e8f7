"""The queries of ``suite`` as SQL over the same tables."""

_EVENT_DAYS = """
  b as (select concat('U', cast(user_id as varchar)) as symbol, cast(user_id as varchar) as id,
      cast(ts as date) as d, event_type
    from events)"""

_CATALOG = """
  catalog as (select concat('U', cast(c_custkey as varchar)) as symbol, cast(c_custkey as varchar) as id,
      cast(date '2024-01-01' + c_nationkey as date) as earliest
    from customer)"""

_LINES = """
  lines as (select l_suppkey as symbol, l_shipdate as timestamp, l_quantity as volume,
      cast(year(l_shipdate) as int) as yr, cast(l_shipdate as date) as d
    from lineitem)"""

_REQUESTED = """
  requested as (select o_orderkey, trim(part) as symbol
    from (select o_orderkey, unnest(string_split(
        concat('U', cast(o_custkey as varchar), ', ', o_orderpriority, ' ,', o_orderstatus), ',')) as part
      from orders))"""

_MERGE = """,
  marks as (select symbol, yr, cast(max(timestamp) as date) as hwm from held group by symbol, yr),
  fresh as (select l.* from lines l left join marks m on m.symbol = l.symbol and m.yr = l.yr
    where m.hwm is null or l.d > m.hwm)
select symbol, timestamp, volume, yr from held
union
select symbol, timestamp, volume, yr from fresh"""

_EVENT_BARS = """
  bars as (select event_type as symbol, cast(year(ts) as int) as yr, date_trunc('minute', ts) as timestamp,
      cast(epoch(date_trunc('minute', ts)) as bigint) as unix_time, value as open, value as volume
    from events)"""

_MOVED_BARS = """
  moved as (select *, ts - to_years(cast(user_id % 3 as integer)) as moved_ts from events),
  bars as (select event_type as symbol, cast(year(moved_ts) as int) as yr, cast(moved_ts as date) as d,
      date_trunc('minute', moved_ts) as timestamp, cast(epoch(date_trunc('minute', moved_ts)) as bigint) as unix_time, value
    from moved)"""

_DAYS = "cast(unnest(generate_series({}, {}, interval 1 day)) as date)"


def _fetch_window() -> str:
    return f"""
with {_LINES},
  marks as (select symbol, yr, cast(max(timestamp) as date) as hwm from lines group by symbol, yr),
  spans as (select symbol, yr, hwm + 1 as start, least(date '2001-10-15', make_date(yr, 12, 31)) as "end" from marks)
select symbol, yr, start, "end", case when start > "end" then 'up_to_date' else 'behind' end as status from spans"""


SQL = {
    "ingest_bars": f"""
with {_CATALOG}
select c.symbol, strptime(strftime(e.ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M') as timestamp,
  cast(epoch(date_trunc('minute', e.ts)) as bigint) as unix_time,
  cast(e.value as double) as open, cast(e.value as double) as close
from events e join catalog c on c.id = cast(e.user_id as varchar)""",
    "day_listing": f"with {_EVENT_DAYS} select symbol, d, count(*) as n_rows from b group by symbol, d",
    "newest_date": f"with {_EVENT_DAYS} select symbol, max(d) as newest_date from b group by symbol",
    "earliest_date": f"with {_EVENT_DAYS} select symbol, min(d) as earliest_date from b group by symbol",
    "tail_gap": f"""
with {_EVENT_DAYS}, {_CATALOG},
  newest as (select symbol, max(d) as hi from b group by symbol),
  spans as (select c.symbol, c.id, greatest(coalesce(n.hi + 1, c.earliest), c.earliest) as a, date '2024-01-31' as z
    from catalog c left join newest n on n.symbol = c.symbol)
select symbol, id, {_DAYS.format("a", "z")} as d from spans where a <= z""",
    "head_backfill": f"""
with {_EVENT_DAYS}, {_CATALOG},
  oldest as (select symbol, min(d) as lo from b group by symbol),
  spans as (select c.symbol, c.id, c.earliest as a, coalesce(o.lo, date '2024-01-31') as z
    from catalog c left join oldest o on o.symbol = c.symbol)
select symbol, id, {_DAYS.format("a", "z - 1")} as d from spans where a < z""",
    "override_gap": f"""
with {_EVENT_DAYS}, {_CATALOG},
  wanted as (select symbol, id, {_DAYS.format("greatest(date '2024-01-01', earliest)", "date '2024-01-30'")} as d
    from catalog)
select w.symbol, w.id, w.d from wanted w
where not exists (select 1 from b where b.symbol = w.symbol and b.d = w.d)""",
    "missing_ranges": f"""
with {_EVENT_DAYS}, {_CATALOG},
  wanted as (select symbol, id, {_DAYS.format("earliest", "date '2024-01-30'")} as d from catalog),
  lacking as (select symbol, id, d from wanted w
    where not exists (select 1 from b where b.symbol = w.symbol and b.d = w.d and b.event_type = 'error')),
  numbered as (select *, d - cast(row_number() over (partition by symbol order by d) as integer) as island from lacking)
select symbol, id, min(d) as first_day, max(d) as last_day from numbered group by symbol, id, island""",
    "planned_landed": f"""
with {_EVENT_DAYS}, {_CATALOG},
  wanted as (select symbol, id, {_DAYS.format("greatest(date '2024-01-01', earliest)", "date '2024-01-30'")} as d
    from catalog)
select w.symbol, w.id, w.d from wanted w
where not exists (select 1 from b where b.symbol = w.symbol and b.d = w.d and b.event_type = 'error')
  and exists (select 1 from b where b.id = w.id and b.d = w.d)""",
    "work_status": f"""
with {_EVENT_DAYS}, spans as (select symbol, min(d) as lo, max(d) as hi from b group by symbol)
select symbol, case when hi >= date '2024-01-30' then 'up_to_date' else 'behind' end as tail_status,
  case when date '2024-01-01' < lo then 'backfill' else 'full_history' end as head_status
from spans""",
    "fetch_window": _fetch_window(),
    "run_summary": f"select status, count(*) as n from ({_fetch_window()}) group by status",
    "catalog_filter": """
select e.user_id, c.c_name, count(*) as n_rows from events e join customer c on c.c_custkey = e.user_id
group by e.user_id, c.c_name""",
    "request_list": f"with {_REQUESTED} select o_orderkey, symbol from requested",
    "requested_known": f"""
with {_REQUESTED}, {_CATALOG}
select c.symbol, c.id from catalog c where exists (select 1 from requested r where r.symbol = c.symbol)""",
    "requested_unknown": f"""
with {_REQUESTED}, {_CATALOG}
select distinct r.symbol from requested r where not exists (select 1 from catalog c where c.symbol = r.symbol)""",
    "unknown_symbols": f"""
with {_EVENT_DAYS}, {_CATALOG}
select c.symbol from catalog c where not exists (select 1 from b where b.symbol = c.symbol)""",
    "partition_key_parse": """
with keys as (select event_id, concat('date=2024-', lpad(json_extract_string(props, '$.k'), 2, '0'), '-',
    lpad(cast(day(ts) as varchar), 2, '0'), '/') as k from events),
  parsed as (select event_id, k, try_cast(regexp_extract(k, 'date=(.*)/', 1) as date) as d from keys)
select event_id, k, d from parsed where d is not null""",
    "json_key": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "hwm_symbol_year": f"""
with {_LINES} select symbol, yr, cast(max(timestamp) as date) as hwm from lines group by symbol, yr""",
    "historical_years": f"with {_LINES} select distinct symbol, yr from lines where yr <= 2000",
    "year_range": f"""
with {_LINES} select symbol, min(yr) as first_year, max(yr) as last_year, count(distinct yr) as n_years
from lines where yr <= 2000 group by symbol""",
    "distinct_bars": "select distinct l_suppkey, l_shipdate, l_quantity from lineitem",
    "hwm_merge": f"""
with {_LINES},
  held as (select l.* from lines l join supplier s on s.s_suppkey = l.symbol
    where month(l.timestamp) <= s.s_nationkey + 1){_MERGE}""",
    "hwm_merge_late": f"""
with {_LINES},
  held as (select * from lines where month(timestamp) between 3 and 6){_MERGE}""",
    "missing_days_merge": f"""
with {_LINES},
  held as (select * from lines where month(timestamp) between 3 and 6),
  fresh as (select l.* from lines l
    where not exists (select 1 from held h where h.symbol = l.symbol and h.d = l.d))
select symbol, timestamp, volume, yr from held
union
select symbol, timestamp, volume, yr from fresh""",
    "shipped_merge": f"""
with {_LINES},
  held as (select l_suppkey as symbol, l_shipdate as timestamp, l_quantity as volume,
      cast(year(l_shipdate) as int) as yr from lineitem where l_linestatus = 'F'){_MERGE}""",
    "consolidation_summary": f"""
with {_LINES} select symbol, yr, count(distinct d) as n_days, count(*) as n_rows_in from lines group by symbol, yr""",
    "latest_from_latest_year": f"""
with {_LINES}, tops as (select symbol, yr, max(timestamp) as top from lines group by symbol, yr),
  ranked as (select symbol, top, row_number() over (partition by symbol order by yr desc) as rank from tops)
select symbol, strftime(top, '%Y-%m-%d') as latest from ranked where rank = 1""",
    "metadata_left_join": f"""
with {_EVENT_DAYS}, {_CATALOG}, newest as (select symbol, max(d) as hi from b group by symbol)
select c.symbol, coalesce(n.hi, date '2023-12-31') as latest from catalog c left join newest n on n.symbol = c.symbol""",
    "consolidate_files": f"""
with {_EVENT_BARS}
select distinct symbol, yr, timestamp, unix_time, open, volume from bars
where cast(timestamp as date) >= date '2024-01-11'""",
    "consolidate_files_missing_days": f"""
with {_EVENT_BARS} select distinct symbol, yr, timestamp, unix_time, open, volume from bars""",
    "statistics_of_year_files": f"""
with {_EVENT_BARS},
  kept as (select distinct symbol, yr, timestamp, unix_time, open, volume from bars
    where cast(timestamp as date) >= date '2024-01-11')
select symbol, yr, count(*) as n_rows, cast(max(timestamp) as date) as last_day, cast(min(timestamp) as date) as first_day,
  count(distinct cast(timestamp as date)) as n_days
from kept group by symbol, yr""",
    "history_files": f"""
with {_MOVED_BARS}
select distinct symbol, yr, timestamp, unix_time, value as open, value as volume from bars
where yr <= 2023 and symbol <> 'error'""",
    "year_files_with_bad_days": f"""
with {_MOVED_BARS},
  kept as (select symbol, yr, count(*) as n from (select distinct symbol, yr, timestamp, value from bars) group by symbol, yr),
  found as (select symbol, yr, count(distinct d) as n_days, count(*) as n_rows,
      max(case when symbol = 'error' and day(d) = 15 then 'no column volume' end) as reason
    from bars where yr = 2023 group by symbol, yr)
select symbol, yr, case when reason is null then n_days else 0 end as n_days,
  case when reason is null then n_rows else 0 end as n_rows_in,
  case when reason is null then n else 0 end as n_rows_out,
  case when reason is null then 'merged' else 'error' end as status, reason
from found join kept using (symbol, yr)""",
    "year_files_with_unreadable_days": f"""
with {_MOVED_BARS},
  kept as (select symbol, yr, count(*) as n from (select distinct symbol, yr, timestamp, value from bars) group by symbol, yr),
  found as (select symbol, yr, count(distinct d) as n_days, count(*) as n_rows,
      case when symbol = 'error' and yr = 2023 then 'a file cannot be read'
        when symbol = 'view' and yr = 2023 then 'another type of note' end as reason
    from bars group by symbol, yr)
select symbol, yr, case when reason is null then n_days else 0 end as n_days,
  case when reason is null then n_rows else 0 end as n_rows_in,
  case when reason is null then n else 0 end as n_rows_out,
  case when reason is null then 'merged' else 'error' end as status, reason
from found join kept using (symbol, yr)""",
    "head_from_key_listing": f"""
with {_EVENT_DAYS}, {_CATALOG},
  listed as (select concat('U', cast(user_id as varchar)) as symbol, min(cast(ts as date)) as lo
    from events where event_id % 5 <> 1 group by 1),
  spans as (select c.symbol, c.id, c.earliest as a, coalesce(o.lo, date '2024-01-31') as z
    from catalog c left join listed o on o.symbol = c.symbol)
select symbol, id, {_DAYS.format("a", "z - 1")} as d from spans where a < z""",
    "inventory_nights": f"""
with {_MOVED_BARS}
select distinct case when symbol = 'view' then 2 else 1 end as night, symbol, d, 'added' as change, true as known
from bars where symbol <> 'view' or yr = 2023""",
    "ingest_files": """
select upper(event_type) as symbol, cast(ts as date) as d, date_trunc('minute', ts) as timestamp,
  cast(epoch(date_trunc('minute', ts)) as bigint) as unix_time, value as open, value as volume,
  cast(user_id as varchar) as "user"
from events""",
    "ingest_ledger": """
with days as (select event_type, cast(ts as date) as d, count(*) as n from events group by all),
  runs as (select 0 as run, *, case when event_type = 'view' then 'conflict' else 'ingested' end as status from days
    union all select 1, *, case when event_type = 'signup' then 'changed' else 'exists' end from days
      where event_type in ('signup', 'purchase'))
select run, upper(event_type) as symbol, d, status, case when event_type = 'view' then 0 else n end as n_rows from runs""",
    "planned_files": f"""
with {_EVENT_DAYS}, {_CATALOG},
  oldest as (select symbol, min(d) as lo from b group by symbol),
  spans as (select c.symbol, c.id, c.earliest as a, coalesce(o.lo, date '2024-01-31') as z
    from catalog c left join oldest o on o.symbol = c.symbol),
  plan as (select symbol, id, {_DAYS.format("a", "z - 1")} as d from spans where a < z)
select concat(id, '-s1-bid-', strftime(d, '%Y-%m-%d'), '-', strftime(d + 1, '%Y-%m-%d'), '.csv') as file,
  concat('symbol=', symbol, '/date=', strftime(d, '%Y-%m-%d'), '/') as folder
from plan""",
    "years_of_keys": f"with {_LINES} select distinct symbol, yr from lines where yr <= 2000",
    "assumed_latest": f"""
with {_LINES}, newest as (select symbol, max(yr) as yr from lines group by symbol)
select symbol, yr, case when yr = 2001 then '2001-10-15' else concat(cast(yr as varchar), '-12-31') end as latest,
  'fallback' as latest_source
from newest""",
    "patched_documents": f"""
with {_EVENT_DAYS}, newest as (select symbol, max(d) as hi from b group by symbol),
  documents as (select concat('U', cast(c_custkey as varchar)) as symbol, c_name, c_acctbal from customer)
select t.symbol, t.c_name as name, t.c_acctbal as balance, '2011-01-01' as earliest,
  coalesce(strftime(n.hi, '%Y-%m-%d'), '2023-12-31') as latest, strftime(n.hi, '%Y-%m-%d') as yearly_latest
from documents t left join newest n on n.symbol = t.symbol
union all
select '_data_boundaries_updated', null, null, null, null, null""",
    "refresh_files": """
with tops as (select n_name as symbol, max(cast(e.ts as date)) as hi
    from events e join customer on c_custkey = e.user_id join nation on n_nationkey = c_nationkey group by n_name),
  documents as (select n_name as symbol, n_name as name, null as old from nation
    union all select r_name, r_name, '2023-12-31' from region)
select t.symbol, t.name, coalesce(strftime(p.hi, '%Y-%m-%d'), t.old) as latest,
  strftime(p.hi, '%Y-%m-%d') as yearly_latest, p.hi as bound,
  case when p.hi is not null then 'data' end as latest_source,
  case when p.hi is not null then timestamp '2024-01-31 00:00:00' end as updated
from documents t left join tops p on p.symbol = t.symbol""",
}

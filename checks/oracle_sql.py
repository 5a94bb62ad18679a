"""The registered queries in plain SQL, for comparison in another engine."""

from __future__ import annotations

from lamina.schemas import LINEAGE, TABLES

BATCH, BATCH_DAY = "batch_2024-01-20 11", "batch_2024-01-20"
SUMMARY_DATE = "2024-01-20"
UPSERT_FROM, UPSERT_TO = "2024-01-15", "2024-01-25"

_CTE = """
arrivals as (
  select event_id as no, user_id, event_type, value as amount, ts, 0 as late from events
  union all
  select event_id, user_id, event_type, value + 1, ts, 1 from events where event_id % 50 = 9
),
stg as (
  select case when no % 20 = 3 or no % 50 = 7 then '' else 'ev_' || no end as event_id,
    case when no % 50 = 7 or no % 33 = 4 then ''
         when no % 7 = 2 then '  User_' || user_id || ' ' else 'user_' || user_id end as user_name,
    case when no % 11 = 5 then upper(event_type) else event_type end as category,
    case (no + user_id) % 4 when 0 then 'web' when 1 then ' Mobile' when 2 then 'api' else 'partner' end as source,
    case when no % 13 = 6 then -amount else amount end as value,
    date_trunc('second', ts) as event_time,
    'batch_' || strftime(date_trunc('hour', ts) + late * interval 24 hours, '%Y-%m-%d %H') as batch_id
  from arrivals
),
rejected as (
  select *, case when event_id = '' and user_name = '' then 'empty_event_id,empty_user_name'
                 when event_id = '' then 'empty_event_id' else 'empty_user_name' end as rejection_reason
  from stg where event_id = '' or user_name = ''
),
clean as (
  select *, case when category = 'purchase' and value > 0 then 1 else 0 end as is_revenue_event from (
    select event_id, lower(trim(user_name)) as user_name, lower(trim(category)) as category,
      lower(trim(source)) as source, case when value < 0 then 0.0 else value end as value, event_time,
      cast(event_time as date) as event_date, cast(hour(event_time) as integer) as event_hour, batch_id
    from stg where event_id <> '' and user_name <> '') t
),
fact as (
  select * exclude (rn) from (
    select *, row_number() over (partition by event_id order by batch_id desc) as rn from clean) t
  where rn = 1
)"""

_MONEY = "cast(sum(cast({} as decimal(18,2))) as double)"


def hourly(facts: str) -> str:
    return f"""select event_date, event_hour, category, source, count(*) as event_count,
  cast(sum(is_revenue_event) as bigint) as revenue_events, {_MONEY.format('value')} as total_value
  from {facts} group by event_date, event_hour, category, source"""


def daily(facts: str) -> str:
    return f"""select event_date, count(*) as total_events, count(distinct user_name) as unique_users,
  cast(sum(is_revenue_event) as bigint) as revenue_events,
  {_MONEY.format('case when is_revenue_event = 1 then value else 0 end')} as total_revenue,
  {_MONEY.format('value')} / count(*) as avg_value
  from {facts} group by event_date"""


def _facts_where(condition: str) -> str:
    return f"""(select * exclude (rn) from (
      select *, row_number() over (partition by event_id order by batch_id desc) as rn from clean
      where {condition}) t where rn = 1)"""


_TOUCHED_DATES = f"""(select distinct event_date from {_facts_where(f"batch_id <= '{BATCH}'")} f
  where batch_id = '{BATCH}')"""

_DAY = "substr(batch_id, 7, 10)"
_DAY_ID = f"substr(batch_id, 1, {len(BATCH_DAY)})"
_SERVED = _facts_where(f"substr(batch_id, 1, {len(BATCH_DAY)}) <= '{BATCH_DAY}'")
_WEEK = "strftime(date_trunc('week', strptime(substr(batch_id, 7, 10), '%Y-%m-%d')), '%Y-%m-%d')"

_DIM_TEMPLATE = """
per_label as (
  select user_name, PERIOD as day, category, source, count(*) as n, sum(cast(value as decimal(18,2))) as v,
    max(is_revenue_event) as paid, min(event_date) as d0, max(event_date) as d1
  from fact group by all
),
profile as (
  select t.*, c.category, s.source from (
    select user_name, day, sum(n) as n, sum(v) as v, max(paid) as paid, min(d0) as d0, max(d1) as d1
    from per_label group by all) t
  join (select user_name, day, category, row_number() over (partition by user_name, day order by sum(n) desc, category) as rn
        from per_label group by user_name, day, category) c
    on c.user_name = t.user_name and c.day = t.day and c.rn = 1
  join (select user_name, day, source, row_number() over (partition by user_name, day order by sum(n) desc, source) as rn
        from per_label group by user_name, day, source) s
    on s.user_name = t.user_name and s.day = t.day and s.rn = 1
),
step as (
  select *, case when lag(category) over w is null or lag(category) over w <> category or lag(source) over w <> source
    then 1 else 0 end as opens from profile window w as (partition by user_name order by day)
),
numbered as (select *, sum(opens) over (partition by user_name order by day) as version_no from step),
version as (
  select user_name, version_no, category, source, min(day) as day0, sum(n) as n, sum(v) as v, max(paid) as paid,
    arg_min(d0, day) as d0, arg_max(d1, day) as d1
  from numbered group by user_name, version_no, category, source
),
bounds as (
  select *, strptime(day0, '%Y-%m-%d') as valid_from,
    strptime(lead(day0) over (partition by user_name order by version_no), '%Y-%m-%d') as next_from
  from version
),
dim_reset as (
  select sha256(user_name || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) as user_key, user_name,
    d0 as first_seen_date, d1 as last_seen_date, category as primary_category, source as primary_source,
    cast(n as bigint) as total_events, cast(v as double) as total_value, paid as is_revenue_user, valid_from,
    coalesce(next_from, timestamp '9999-12-31') as valid_to, case when next_from is null then 1 else 0 end as is_current
  from bounds
),
dim as (
  select user_key, d.user_name, first_value(first_seen_date) over w as first_seen_date, last_seen_date,
    primary_category, primary_source, cast(sum(total_events) over w as bigint) as total_events,
    cast(sum(cast(total_value as decimal(18,2))) over w as double) as total_value,
    max(is_revenue_user) over w as is_revenue_user, valid_from, valid_to, is_current
  from dim_reset d window w as (partition by d.user_name order by valid_from)
)"""
_DIM_CTE = _DIM_TEMPLATE.replace("PERIOD", _DAY)
_DIM_WEEK_CTE = _DIM_TEMPLATE.replace("PERIOD", _WEEK)

_SERVING_CTE = f"""
target_fact as (select * from {_facts_where(f"substr(batch_id, 1, 16) <= '{BATCH_DAY}'")} f),
gold_hourly as ({hourly('fact')}), gold_daily as ({daily('fact')}),
target_hourly as ({hourly('target_fact')}), target_daily as ({daily('target_fact')})"""


def _query(body: str, *ctes: str) -> str:
    return "with " + ",".join((_CTE,) + ctes) + "\n" + body


def _upsert(name: str, keys: str) -> str:
    return _query(f"""select * from target_{name} t where not exists (
  select 1 from gold_{name} g where {' and '.join(f'g.{k} = t.{k}' for k in keys.split())}
    and g.event_date between date '{UPSERT_FROM}' and date '{UPSERT_TO}')
union all select * from gold_{name} where event_date between date '{UPSERT_FROM}' and date '{UPSERT_TO}'""", _SERVING_CTE)


_HOUR_SIDE = ("select event_date, event_hour, count(*) as r, sum(event_count) as e, "
              + _MONEY.format("total_value") + " as v from {} group by event_date, event_hour")
_SNAPSHOTS = f"""
before_fact as (select * from {_facts_where(f"batch_id < '{BATCH}'")} f),
snap_hourly as (select *, '{BATCH}' as _snapshot_batch from ({hourly('before_fact')}) g
  where event_date in {_TOUCHED_DATES}),
snap_daily as (select *, '{BATCH}' as _snapshot_batch from ({daily('before_fact')}) g
  where event_date in {_TOUCHED_DATES})"""

# The layers the catalog queries measure: table id, name in the statement.
_MEASURED = {
    "bronze.stg_events": "stg", "silver.fact_events": "fact", "silver.quarantine_events": "rejected",
    "silver.dim_users": "dim", "gold.agg_events_hourly": "gold_hourly", "gold.rpt_daily_summary": "gold_daily",
    "gold.agg_events_hourly_history": "snap_hourly", "gold.rpt_daily_summary_history": "snap_daily",
}
_GOLD = f"gold_hourly as ({hourly('fact')}), gold_daily as ({daily('fact')})"
_SIZES = "sizes as (" + " union all ".join(
    f"select '{t}' as table_id, count(*) as row_count from {n}" for t, n in _MEASURED.items()) + ")"


def _values(rows: list[tuple]) -> str:
    """Declared metadata as rows of a statement; what is measured comes from the tables."""
    def cell(value) -> str:
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    return "(values " + ", ".join(f"({', '.join(map(cell, row))})" for row in rows) + ")"


def _order(table) -> list[str]:
    return list(dict.fromkeys([*table.keys, *table.sort_by]))


_TABLES = _values([
    (t.table_id, t.layer, t.name, t.contract, ", ".join(t.partition_by), ", ".join(_order(t)), ",".join(t.tags)) for t in TABLES
])
_ALL_COLUMNS = _values([
    (t.table_id, c, dtype.simpleString(), int(c in t.nullable), int(c in t.partition_by), int(c in _order(t)))
    for t in TABLES for c, dtype, _ in t.columns
])
_EDGES = "edges (source_table_id, target_table_id, transformation) as " + _values([
    (a.table_id, b.table_id, text) for a, b, text, _ in LINEAGE
])

_FACT_TYPES = {
    "event_id": "string", "user_name": "string", "category": "string", "source": "string", "value": "double",
    "event_time": "timestamp", "event_date": "date", "event_hour": "int", "is_revenue_event": "int", "batch_id": "string",
}


def _profile() -> str:
    def column(name: str, dtype: str) -> str:
        empty = f" or {name} = ''" if dtype == "string" else ""
        return f"""select '{name}' as column_name, '{dtype}' as data_type, count(*) as row_count,
  count(*) filter ({name} is null{empty}) as missing_count, count(distinct {name}) as distinct_count,
  cast(min({name}) as varchar) as min_value, cast(max({name}) as varchar) as max_value from fact"""
    return _query(" union all ".join(column(n, d) for n, d in _FACT_TYPES.items()))


_COLUMNS = {
    "bronze.stg_events": ("stg", "event_id* user_name* category* source* value event_time batch_id*"),
    "silver.fact_events": ("fact", "event_id* user_name* category* source* value event_time event_date event_hour is_revenue_event batch_id*"),
    "silver.quarantine_events": ("rejected", "event_id* user_name* category* source* value event_time batch_id* rejection_reason*"),
    "silver.dim_users": ("dim", "user_key* user_name* first_seen_date last_seen_date primary_category* primary_source* total_events total_value is_revenue_user valid_from valid_to is_current"),
    "gold.agg_events_hourly": ("gold_hourly", "event_date event_hour category* source* event_count revenue_events total_value"),
    "gold.rpt_daily_summary": ("gold_daily", "event_date total_events unique_users revenue_events total_revenue avg_value"),
}


def _catalog_columns() -> str:
    parts = []
    for table_id, (name, columns) in _COLUMNS.items():
        for column in columns.split():
            bare = column.rstrip("*")
            empty = f" or {bare} = ''" if column.endswith("*") else ""
            parts.append(
                f"select '{table_id}' as table_id, '{bare}' as column_name, count(*) as row_count, "
                f"count(*) filter ({bare} is null{empty}) as missing_count from {name}")
    return _query(f"""select r.*, row_count, missing_count
from {_ALL_COLUMNS} r (table_id, column_name, data_type, is_nullable, is_partition_key, is_order_key)
left join ({" union all ".join(parts)}) c on c.table_id = r.table_id and c.column_name = r.column_name""", _DIM_CTE, _GOLD)


_TASKS = """task as (
  select case event_id % 3 when 0 then 'alpha' when 1 then 'beta' else 'gamma' end as framework,
    event_type as task_name, cast(floor(value * 10) as bigint) as duration_ms, user_id as rows_out,
    case when event_id % 10 = 0 then 'failed' else 'success' end as status from events)"""

_RUNS = """run as (
  select 'run_' || batch_id as run_id, batch_id, bronze_rows, silver_rows,
    (cast(substr(batch_id, 15, 2) as integer) * 24 + cast(substr(batch_id, 18, 2) as integer)) % 7 = 0 as unfinished
  from (select batch_id, count(*) as bronze_rows,
          count(*) filter (event_id <> '' and user_name <> '') as silver_rows from stg group by batch_id) t)"""

_ACCOUNTING = """select batch_id, count(*) as bronze_rows,
  count(*) filter (event_id <> '' and user_name <> '') as valid_rows,
  count(*) filter (event_id = '' or user_name = '') as quarantined_rows"""

_METRICS = ("hourly_rows", "hourly_events", "hourly_value", "daily_rows", "daily_events")


def _validation() -> str:
    flags = [f"case when {c} then 1 else 0 end as {m}_match" for m, c in zip(_METRICS, (
        "gold_hourly_rows = serving_hourly_rows", "gold_hourly_events = serving_hourly_events",
        "abs(gold_hourly_value - serving_hourly_value) < 0.01", "gold_daily_rows = serving_daily_rows",
        "gold_daily_events = serving_daily_events"))]
    totals = """select coalesce(h.event_date, sh.event_date) as event_date, coalesce(h.event_hour, sh.event_hour) as event_hour,
      coalesce(h.r, 0) as gold_hourly_rows, cast(coalesce(h.e, 0) as bigint) as gold_hourly_events, coalesce(h.v, 0.0) as gold_hourly_value,
      coalesce(sh.r, 0) as serving_hourly_rows, cast(coalesce(sh.e, 0) as bigint) as serving_hourly_events,
      coalesce(sh.v, 0.0) as serving_hourly_value
    from ({}) h full join ({}) sh on h.event_date = sh.event_date and h.event_hour = sh.event_hour""".format(
        _HOUR_SIDE.format("gold_hourly"), _HOUR_SIDE.format("target_hourly"))
    return _query(f"""select *, case when {' and '.join(f'{m}_match = 1' for m in _METRICS)} then 'pass' else 'fail' end as overall_status
from (select *, {', '.join(flags)} from (
  select t.*, case when g.event_date is null then 0 else 1 end as gold_daily_rows, coalesce(g.total_events, 0) as gold_daily_events,
    case when s.event_date is null then 0 else 1 end as serving_daily_rows, coalesce(s.total_events, 0) as serving_daily_events
  from ({totals}) t left join gold_daily g on g.event_date = t.event_date left join target_daily s on s.event_date = t.event_date) x) y""",
        _SERVING_CTE)


def _mismatches(gold: str, serving: str, keys: str, measures: str) -> str:
    on = " and ".join(f"g.{k} = s.{k}" for k in keys.split())
    doubles = ("total_value", "total_revenue", "avg_value")
    differ = " or ".join(
        f"abs(g.{m} - s.{m}) >= 0.01" if m in doubles else f"g.{m} <> s.{m}" for m in measures.split())
    return f"""select {', '.join(f'coalesce(g.{k}, s.{k}) as {k}' for k in keys.split())},
  case when s.event_date is null then 'missing' when g.event_date is null then 'surplus' else 'different' end as mismatch,
  {', '.join(f'g.{m} as gold_{m}' for m in measures.split())}, {', '.join(f's.{m} as serving_{m}' for m in measures.split())}
from {gold} g full join {serving} s on {on}
where g.event_date is null or s.event_date is null or {differ}"""


def _differences() -> str:
    parts = []
    for table, keys, measures in (
        ("hourly", "event_date event_hour category source", "event_count revenue_events total_value"),
        ("daily", "event_date", "total_events unique_users revenue_events total_revenue avg_value"),
    ):
        found = _mismatches(f"gold_{table}", f"target_{table}", keys, measures)
        finer = "event_hour, category, source" if table == "hourly" else "null as event_hour, null as category, null as source"
        table_id = "gold.agg_events_hourly" if table == "hourly" else "gold.rpt_daily_summary"
        for m in measures.split():
            double = m in ("total_value", "total_revenue", "avg_value")
            apart = f"abs(gold_{m} - serving_{m}) >= 0.01" if double else f"gold_{m} <> serving_{m}"
            parts.append(f"""select '{table_id}' as table_id, event_date, {finer}, mismatch, '{m}' as measure,
  cast(gold_{m} as double) as gold_value, cast(serving_{m} as double) as serving_value
from ({found}) m where mismatch <> 'different' or {apart}""")
    return _query(" union all ".join(parts), _SERVING_CTE)


def statements() -> dict[str, str]:
    hourly_keys = "event_date event_hour category source"
    raw = "event_id, user_name, category, source, value, event_time, batch_id"
    return {
        "bronze_ingest": _query(f"select {raw} from stg"),
        "ingest_new_batches_only": _query(
            f"select {raw} from stg where batch_id not in "
            f"(select batch_id from stg where substr(batch_id, 1, 16) <= '{BATCH_DAY}')"),
        "quarantine_rows": _query(f"select {raw}, rejection_reason from rejected"),
        "quarantine_by_reason": _query("select rejection_reason, count(*) as row_count from rejected group by 1"),
        "silver_clean": _query("select * from clean"),
        "silver_fact_current": _query("select * from fact"),
        "dim_users_scd2": _query("select * from dim", _DIM_CTE),
        "dim_users_scd2_reset": _query("select * from dim_reset", _DIM_CTE),
        "dim_users_current": _query("select * from dim where is_current = 1", _DIM_CTE),
        "dim_users_change_counts": _query(
            """select valid_from, count(*) filter (version_no = 1) as new_users,
  count(*) filter (version_no > 1) as updated_users from bounds group by valid_from""", _DIM_CTE),
        "gold_hourly_full": _query(hourly("fact")),
        "gold_daily_full": _query(daily("fact")),
        "gold_daily_from_states": _query(daily("fact")),
        "gold_weekly_from_states": _query(f"""select event_date as week_start, * exclude (event_date) from ({daily(
            "(select * replace (cast(date_trunc('week', event_date) as date) as event_date) from fact) f")}) g"""),
        "gold_hourly_for_batch": _query(f"""select * from ({hourly('fact')}) g where exists (select 1 from fact f
  where f.batch_id = '{BATCH}' and f.event_date = g.event_date and f.event_hour = g.event_hour)"""),
        "gold_daily_for_batch": _query(f"""select * from ({daily('fact')}) g where event_date in (
  select event_date from fact where batch_id = '{BATCH}')"""),
        "snapshot_hourly": _query("select * from snap_hourly", _SNAPSHOTS),
        "snapshot_daily": _query("select * from snap_daily", _SNAPSHOTS),
        "serving_upsert_hourly": _upsert("hourly", hourly_keys),
        "serving_upsert_daily": _upsert("daily", "event_date"),
        "export_hourly_roundtrip": _query(
            f"""select * exclude (event_hour), lpad(cast(event_hour as varchar), 2, '0') as event_hour
from ({hourly('fact')}) g"""),
        "export_daily_roundtrip": _query(daily("fact")),
        "row_accounting": _query(
            f"{_ACCOUNTING}, 1 as is_balanced from stg group by batch_id"),
        "batch_row_counts": _query(
            f"""select a.batch_id, bronze_rows, quarantined_rows, valid_rows, coalesce(n, 0) as current_rows
from ({_ACCOUNTING} from stg group by batch_id) a
left join (select batch_id, count(*) as n from fact group by batch_id) f on f.batch_id = a.batch_id"""),
        "layer_summary": _query(f"""
select 'bronze' as layer, 'stg_events' as table_name, 'total' as scope, count(*) as row_count from stg
union all select 'bronze', 'stg_events', 'batch', count(*) from stg where batch_id = '{BATCH}'
union all select 'silver', 'fact_events', 'total', count(*) from fact
union all select 'silver', 'fact_events', 'batch', count(*) from fact where batch_id = '{BATCH}'
union all select 'silver', 'quarantine_events', 'total', count(*) from rejected
union all select 'silver', 'quarantine_events', 'batch', count(*) from rejected where batch_id = '{BATCH}'
union all select 'silver', 'dim_users', 'current', count(*) from dim where is_current = 1
union all select 'gold', 'agg_events_hourly', 'date', count(*) from gold_hourly where event_date = date '{SUMMARY_DATE}'
union all select 'gold', 'rpt_daily_summary', 'date', count(*) from gold_daily where event_date = date '{SUMMARY_DATE}'
union all select 'gold', 'agg_events_hourly_history', 'total', count(*) from snap_hourly
union all select 'gold', 'rpt_daily_summary_history', 'total', count(*) from snap_daily""", _DIM_CTE, _GOLD, _SNAPSHOTS),
        "redelivery_verdicts": _query(f"""
select batch_id, case when batch_id > '{BATCH_DAY}' then 'new' when day % 5 = 0 and n_api > 0 then 'split'
  when day % 3 = 0 and n_paid > 0 then 'changed' else 'same' end as verdict
from (select {_DAY_ID} as batch_id, any_value(day(strptime({_DAY}, '%Y-%m-%d'))) as day, count(*) filter (source = 'api') as n_api,
        count(*) filter (lower(category) = 'purchase') as n_paid, count(*) as n
      from stg group by {_DAY_ID}) d where not (day % 5 = 0 and n_api = n)"""),
        "unreadable_rows_aside": _query(f"""
select {_DAY_ID} as batch_id, concat_ws(',', case when event_id = '' then 'empty_event_id' end,
    case when user_name = '' then 'empty_user_name' end, case when right(event_id, 2) = '11' then 'unreadable_event_time' end,
    case when right(event_id, 2) in ('11', '22') then 'unreadable_value' end) as rejection_reason,
  count(*) as row_count, count(*) filter (right(event_id, 2) in ('11', '22')) as with_text
from stg group by 1, 2"""),
        "publish_interrupted": _query(f"""
select step, table_id, row_count, events from (
  select g.name || '_' as name, row_count, events, was from (
    select 'hourly' as name, count(*) as row_count, cast(sum(event_count) as bigint) as events, true as was from ({hourly(_SERVED)}) h
    union all select 'daily', count(*), cast(sum(total_events) as bigint), true from ({daily(_SERVED)}) d
    union all select 'hourly', count(*), cast(sum(event_count) as bigint), false from ({hourly('fact')}) h
    union all select 'daily', count(*), cast(sum(total_events) as bigint), false from ({daily('fact')}) d) g) figures
join (values ('gold.agg_events_hourly', 'hourly_'), ('gold.rpt_daily_summary', 'daily_'), ('serving.agg_events_hourly', 'hourly_'),
  ('serving.rpt_daily_summary', 'daily_')) t(table_id, name) using (name)
join (select cast(unnest(range(6)) as integer) as step) s on was = (step < 5)"""),
        "delivery_validation": _validation(),
        "delivery_mismatches": _query(_mismatches(
            "gold_hourly", "target_hourly", hourly_keys, "event_count revenue_events total_value"), _SERVING_CTE),
        "delivery_mismatches_daily": _query(_mismatches(
            "gold_daily", "target_daily", "event_date",
            "total_events unique_users revenue_events total_revenue avg_value"), _SERVING_CTE),
        "delivery_differences": _differences(),
        "gold_hourly_as_of": _query(f"""
select event_date, event_hour, category, source, as_of, count(*) as event_count,
  cast(sum(is_revenue_event) as bigint) as revenue_events, {_MONEY.format('value')} as total_value
from (select c.*, 'batch_' || week as as_of, row_number() over (partition by week, event_id order by batch_id desc) as rn
      from clean c join (select distinct {_WEEK} as week from stg) w on {_WEEK} <= week) t
where rn = 1 group by event_date, event_hour, category, source, as_of"""),
        "catalog_tables": _query(f"""select r.*, row_count
from {_TABLES} r (table_id, layer, table_name, engine, partition_key, order_key, tags)
left join sizes s on s.table_id = r.table_id""", _DIM_CTE, _GOLD, _SNAPSHOTS, _SIZES),
        "catalog_columns": _catalog_columns(),
        "column_profile": _profile(),
        "lineage_edges": _query("""select source_table_id, target_table_id, transformation, a.row_count as source_rows, b.row_count as target_rows
from edges join sizes a on a.table_id = source_table_id join sizes b on b.table_id = target_table_id""",
            _DIM_CTE, _GOLD, _SNAPSHOTS, _SIZES, _EDGES),
        "lineage_closure": _query("""select ancestor, descendant, depth, a.row_count as ancestor_rows, b.row_count as descendant_rows
from (select e.source_table_id as ancestor, e.target_table_id as descendant, 1 as depth from edges e
  union all select e.source_table_id, f.target_table_id, 2 from edges e join edges f on f.source_table_id = e.target_table_id
  union all select e.source_table_id, g.target_table_id, 3 from edges e join edges f on f.source_table_id = e.target_table_id
    join edges g on g.source_table_id = f.target_table_id) c
join sizes a on a.table_id = ancestor join sizes b on b.table_id = descendant""",
            _DIM_CTE, _GOLD, _SNAPSHOTS, _SIZES, _EDGES),
        "run_log_current": _query("""select run_id, batch_id, case when unfinished then 'running' else 'success' end as status,
  case when unfinished then 0 else bronze_rows end as bronze_rows,
  case when unfinished then 0 else silver_rows end as silver_rows from run""", _RUNS),
        "benchmark_compare": "with " + _TASKS + """
select framework, task_name, sum(duration_ms) / count(*) as avg_ms, round(avg(case when duration_ms = 0 then 0.0
  else rows_out / (duration_ms / 1000.0) end), 4) as avg_throughput
from task where status = 'success' group by framework, task_name""",
        "batch_ledger": _query(
            "select substr(batch_id, 1, 16) as batch_id, count(*) as row_count from stg group by substr(batch_id, 1, 16)"),
        "incremental_replay": _query(daily("fact")),
        "recovery_replay": _query(daily("fact")),
        "stream_replay": _query("select * from dim", _DIM_WEEK_CTE),
    }

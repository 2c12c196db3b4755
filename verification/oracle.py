"""SQL texts that give the expected result of each registered query.

Every text starts from the same chain of CTEs: ticket adapter (FIXTURES.md section 4) -> clean
cells -> typed raw tickets -> dimensions -> fact.
"""

from __future__ import annotations

from deskmart.schemas import NA_TOKENS

AS_OF = "timestamp '2024-01-31 00:00:00'"
_ISO, _US, _MIN = "'%Y-%m-%d %H:%M:%S'", "'%m/%d/%Y %H:%M:%S'", "'%Y-%m-%d %H:%M'"

# The nine date layouts, tried in this order.
_DATE_LAYOUTS = (
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M",
    "%m/%d/%Y", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y", "%Y/%m/%d",
)

TEXT_COLUMNS = (
    "ticket_id", "created_at", "resolved_at", "first_response_at", "status", "priority", "category",
    "channel", "agent_name", "team", "satisfaction_score", "reopen_count", "description",
)

_SOURCE = f"""
with e as (
  select event_id, event_type, user_id, value, date_trunc('second', ts) as ts,
    min(case when event_type = 'click' then date_trunc('second', ts) end) over w as click_ts,
    min(case when event_type = 'purchase' then date_trunc('second', ts) end) over w as purchase_ts
  from events
  window w as (partition by user_id order by ts, event_id
               rows between 1 following and unbounded following)),
src as (
  select event_id,
    concat('TCK-', lpad(cast(event_id as varchar), 8, '0')) as ticket_id,
    case when event_id % 701 = 0 then 'garbage'
         when event_id % 4 = 2 then strftime(ts, {_US})
         when event_id % 4 = 3 then strftime(ts, {_MIN})
         else strftime(ts, {_ISO}) end as created_at,
    case when event_id % 499 = 0 and purchase_ts is not null then '2023-12-25 00:00:00'
         else strftime(purchase_ts, {_ISO}) end as resolved_at,
    strftime(click_ts, {_ISO}) as first_response_at,
    case when purchase_ts is not null then case when event_id % 5 = 0 then 'closed' else ' Solved ' end
         when click_ts is not null then 'In Progress' else 'new' end as status,
    case event_id % 9 when 0 then 'P1' when 1 then 'urgent' when 2 then ' High ' when 3 then 'sev2'
         when 4 then 'Normal' when 5 then 'p3' when 6 then 'low' when 7 then 'planned' end as priority,
    case when event_id % 11 <> 0 then p_type end as category,
    c_mktsegment as channel,
    case when event_id % 17 <> 0 then s_name end as agent_name,
    case when event_id % 13 <> 0 then n_name end as team,
    case when purchase_ts is not null and event_id % 3 <> 0
         then cast(cast(floor(value) as bigint) % 6 as varchar)
         when event_id % 6 = 0 then 'n/a' end as satisfaction_score,
    case when event_id % 7 = 0 then '1' when event_id % 10 <> 0 then '0' end as reopen_count,
    cast(null as varchar) as description
  from e
  left join supplier on s_suppkey = user_id % 8
  left join nation on n_nationkey = s_nationkey
  left join customer on c_custkey = user_id
  left join part on p_partkey = event_id % 50
  where event_type in ('error', 'signup', 'view'))"""


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _cell(column: str) -> str:
    return (f"case when {column} not in ({quoted(NA_TOKENS)}) "
            f"then regexp_replace({column}, '^\\s+|\\s+$', '', 'g') end as {column}")


def parse(text: str) -> str:
    tries = ", ".join(f"try_strptime({text}, '{layout}')" for layout in _DATE_LAYOUTS)
    return f"date_trunc('second', coalesce({tries}))"


def title(w: str) -> str:
    letter = r"'^[\p{Lu}\p{Ll}\p{Lt}]$'"
    return (f"array_to_string(list_transform(range(1, length({w}) + 1), lambda i: "
            f"case when i > 1 and regexp_matches(substring({w}, i - 1, 1), {letter}) "
            f"then lower(substring({w}, i, 1)) else upper(substring({w}, i, 1)) end), '')")


_CELLS = f""",
cells as (select event_id, {", ".join(_cell(c) for c in TEXT_COLUMNS)} from src)"""

_LABELS = ("category", "channel", "agent_name", "team")

PRIORITY = f"""case
    when lower(priority) in ('critical', 'crit', 'urgent', 'p1', '1', 'sev1', 's1') then 'Critical'
    when lower(priority) in ('high', 'p2', '2', 'sev2', 's2') then 'High'
    when lower(priority) in ('medium', 'med', 'normal', 'p3', '3', 'sev3', 's3') then 'Medium'
    when lower(priority) in ('low', 'p4', '4', 'sev4', 's4') then 'Low'
    when priority <> '' then {title('priority')} end"""
STATUS = f"""case
    when lower(status) in ('open', 'new') then 'Open'
    when lower(status) in ('pending', 'in progress', 'in_progress', 'on hold', 'waiting') then 'Pending'
    when lower(status) in ('resolved', 'solved') then 'Resolved'
    when lower(status) in ('closed', 'complete', 'completed') then 'Closed'
    when status <> '' then {title('status')} end"""

_RAW = f""",
raw as (
  select event_id, ticket_id, {", ".join(f"{parse(c)} as {c}" for c in
                                         ("created_at", "resolved_at", "first_response_at"))},
    {STATUS} as status, {PRIORITY} as priority,
    {", ".join(f"case when {c} <> '' then {title(c)} end as {c}" for c in _LABELS)},
    try_cast(satisfaction_score as double) as satisfaction_score,
    coalesce(cast(trunc(try_cast(reopen_count as double)) as bigint), 0) as reopen_count, description
  from cells)"""

_DIMS = f""",
named as (
  select *, coalesce(agent_name, '(Unassigned)') as agent_label, coalesce(team, '(Unknown)') as team_label,
    coalesce(category, '(Uncategorized)') as category_name, coalesce(channel, '(Unknown)') as channel_name,
    coalesce(priority, '(Unknown)') as priority_name
  from raw),
dim_agent as (
  select cast(row_number() over (order by agent_name, team) as integer) as agent_key, agent_name, team
  from (select distinct agent_label as agent_name, team_label as team from named)),
dim_category as (
  select cast(row_number() over (order by category_name) as integer) as category_key, category_name
  from (select distinct category_name from named)),
dim_channel as (
  select cast(row_number() over (order by channel_name) as integer) as channel_key, channel_name
  from (select distinct channel_name from named)),
dim_priority as (
  select cast(row_number() over (order by case priority_name when 'Critical' then 1 when 'High' then 2
      when 'Medium' then 3 when 'Low' then 4 else 5 end, priority_name) as integer) as priority_key,
    priority_name,
    cast(case priority_name when 'Critical' then 4 when 'High' then 8 when 'Medium' then 24
      when 'Low' then 72 else 24 end as integer) as sla_target_hours
  from (select distinct priority_name from named)),
dim_calendar as (
  select cast(strftime(d, '%Y%m%d') as integer) as date_key, strftime(d, '%Y-%m-%d') as date,
    dayname(d) as day_of_week, cast(strftime(d, '%W') as integer) as week_number,
    cast(month(d) as integer) as month_number, monthname(d) as month_name,
    cast(quarter(d) as integer) as quarter, cast(year(d) as integer) as year,
    case when dayofweek(d) in (0, 6) then 1 else 0 end as is_weekend,
    case when dayofweek(d) in (0, 6) then 0 else 1 end as is_business_day
  from (select cast(unnest(generate_series(
          coalesce(cast(min(created_at) as date), cast({AS_OF} as date)),
          greatest(coalesce(cast(min(created_at) as date), cast({AS_OF} as date)),
                   cast({AS_OF} as date) + 30), interval 1 day)) as date) as d from raw))"""


def band(amount: str, unit: int) -> str:
    return (f"case when {amount} <= {24 * unit} then '0-1 Day' when {amount} <= {72 * unit} "
            f"then '1-3 Days' when {amount} <= {168 * unit} then '3-7 Days' "
            f"when {amount} <= {336 * unit} then '7-14 Days' else '14+ Days' end")


_FACT = f""",
fact as (
  select n.event_id, n.ticket_id, n.created_at, n.resolved_at, n.first_response_at, n.status,
    a.agent_key, c.category_key, h.channel_key, p.priority_key,
    cast(strftime(n.created_at, '%Y%m%d') as integer) as created_date_key,
    n.satisfaction_score, n.reopen_count,
    date_diff('second', n.created_at, n.resolved_at) as resolution_seconds,
    date_diff('second', n.created_at, n.first_response_at) as response_seconds,
    date_diff('second', n.created_at, n.resolved_at) / 3600.0::double as resolution_hours,
    date_diff('second', n.created_at, n.first_response_at) / 3600.0::double as response_hours,
    p.sla_target_hours,
    case when date_diff('second', n.created_at, n.resolved_at) > p.sla_target_hours * 3600 then 1
         else 0 end as sla_breached,
    case when n.status = 'Resolved' and n.reopen_count = 0 then 1 else 0 end
      as is_first_contact_resolved,
    case when n.resolved_at is not null then '(Resolved)'
         else {band(f"date_diff('second', n.created_at, {AS_OF})", 3600)} end as ticket_age_band,
    case when n.resolved_at is not null then '(Resolved)'
         else {band(f"date_diff('hour', n.created_at, {AS_OF})", 1)} end as live_age_band,
    case when date_diff('second', n.created_at, n.resolved_at) is not null
         then {band("date_diff('second', n.created_at, n.resolved_at)", 3600)} end as resolution_time,
    a.agent_name, a.team, c.category_name, h.channel_name, p.priority_name, k.date
  from named n
  left join dim_agent a on a.agent_name = n.agent_label and a.team = n.team_label
  left join dim_category c on c.category_name = n.category_name
  left join dim_channel h on h.channel_name = n.channel_name
  left join dim_priority p on p.priority_name = n.priority_name
  left join dim_calendar k on k.date_key = cast(strftime(n.created_at, '%Y%m%d') as integer))"""


def from_source(select: str) -> str:
    return f"{_SOURCE}\n{select}"


def from_cells(select: str) -> str:
    return f"{_SOURCE}{_CELLS}\n{select}"


def from_raw(select: str) -> str:
    return f"{_SOURCE}{_CELLS}{_RAW}\n{select}"


def from_star(select: str) -> str:
    return f"{_SOURCE}{_CELLS}{_RAW}{_DIMS}{_FACT}\n{select}"


def at(column: str) -> str:
    return f"strftime({column}, {_ISO}) as {column}"


# --- measures: expected formula over fact rows --------------------------------------------------

_RES, _RATED = "resolved_at is not null", "satisfaction_score <> 0"
_RISK = (f"resolved_at is null and date_diff('hour', created_at, {AS_OF}) "
         ">= 0.8::double * sla_target_hours")


def _n(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


def _pct(part: str, whole: str) -> str:
    return f"coalesce({_n(part)} / nullif({_n(whole)}, 0)::double, 0) * 100.0::double"


def _mean(column: str) -> str:
    return f"(sum({column}) / 3600.0::double) / nullif(count({column}), 0)"


def _clock(column: str) -> str:
    h = _mean(column)
    return (f"coalesce(cast(cast(floor({h}) as bigint) as varchar) || 'h ' || "
            f"cast(cast(floor(({h} - floor({h})) * 60) as bigint) as varchar) || 'm', 'n/a')")


def tenth(x: str) -> str:
    return f"printf('%.1f', round({x}, 1))"


_CSAT = f"(sum(satisfaction_score) filter (where {_RATED}) / nullif({_n(_RATED)}, 0))"

MEASURE_SQL = {
    "total_tickets": _n("true"),
    "tickets_created": _n("true"),
    "tickets_resolved": _n(_RES),
    "tickets_open": _n("status in ('Open', 'Pending')"),
    "tickets_by_day": _n("true"),
    "mttr_hours": _mean("resolution_seconds"),
    "mttr_display": _clock("resolution_seconds"),
    "mtta_hours": _mean("response_seconds"),
    "mtta_display": _clock("response_seconds"),
    "fcr_count": _n("is_first_contact_resolved = 1"),
    "fcr_rate": _pct("is_first_contact_resolved = 1", _RES),
    "fcr_rate_display": tenth(_pct("is_first_contact_resolved = 1", _RES)) + " || '%'",
    "sla_compliant_count": _n(f"sla_breached = 0 and {_RES}"),
    "sla_breach_count": _n("sla_breached = 1"),
    "sla_compliance_rate": _pct(f"sla_breached = 0 and {_RES}", _RES),
    "sla_compliance_display": tenth(_pct(f"sla_breached = 0 and {_RES}", _RES)) + " || '%'",
    "sla_at_risk": _n(_RISK),
    "sla_breach_rate": _pct("sla_breached = 1", _RES),
    "backlog_count": _n("resolved_at is null"),
    "oldest_open_days": f"cast(max(date_diff('day', created_at, {AS_OF})) "
                        "filter (where resolved_at is null) as integer)",
    "band_0_1_day": _n("ticket_age_band = '0-1 Day'"),
    "band_1_3_days": _n("ticket_age_band = '1-3 Days'"),
    "band_3_7_days": _n("ticket_age_band = '3-7 Days'"),
    "band_over_7_days": _n("ticket_age_band in ('7-14 Days', '14+ Days')"),
    "tickets_per_agent": "coalesce(count(*) / nullif(count(distinct agent_key), 0)::double, 0)",
    "agent_mttr": _mean("resolution_seconds"),
    "agent_fcr_rate": _pct("is_first_contact_resolved = 1", _RES),
    "agent_sla_compliance": _pct(f"sla_breached = 0 and {_RES}", _RES),
    "avg_csat": _CSAT,
    "csat_display": f"coalesce({tenth(_CSAT)} || ' / 5.0', 'n/a')",
    "csat_satisfied_rate": _pct(f"satisfaction_score >= 4 and {_RATED}", _RATED),
    "csat_dissatisfied_rate": _pct(f"satisfaction_score <= 2 and {_RATED}", _RATED),
}
REALS = {
    "mttr_hours", "mtta_hours", "fcr_rate", "sla_compliance_rate", "sla_breach_rate",
    "tickets_per_agent", "agent_mttr", "agent_fcr_rate", "agent_sla_compliance", "avg_csat",
    "csat_satisfied_rate", "csat_dissatisfied_rate",
}


def measures(names, by=(), where: str = "true", extra: str = "") -> str:
    """Expected result of one evaluation: grouped rows with six-digit reals."""
    shown = [f"round({MEASURE_SQL[m]}, 6) as {m}" if m in REALS else f"{MEASURE_SQL[m]} as {m}"
             for m in names]
    group = f" group by {', '.join(by)}" if by else ""
    return from_star(f"select {', '.join([*by, *shown])}{extra} from fact where {where}{group}")

"""The named queries as plain SQL for a second engine (DuckDB).

Written independently of the Spark plans where the rule allows another
formulation: A1 through runs of comments and ``lag``, A2 through an
interval self-join, derived sessions through a per-user running sum.
"""

from __future__ import annotations

# Adapters (see ``sources.adapters``), as CTEs over the driver tables.
_PRELUDE = """
with com as (
  select event_id, ts, user_id, event_type, item_id, duration_sec, comment_text,
         concat('sess_', strftime(ts, '%Y%m%d'), '_', cast(user_id as varchar)) as session_id
  from (
    select event_id, ts, user_id,
      case raw when 'view' then 'enter_item' when 'error' then 'leave_item'
        when 'signup' then case when k < 40 then 'app_open' when k < 55 then 'follow'
                                when k < 70 then 'unfollow' when k < 85 then 'dm'
                                else 'enter_profile' end
        when 'click' then case k % 3 when 0 then 'like' when 1 then 'fav' else 'share' end
        else case when k < 80 then 'comment' when k < 90 then 'click_tag' else 'dislike' end
      end as event_type,
      case when raw <> 'signup' then k end as item_id,
      case when raw = 'error' then case event_id % 3 when 0 then value * 10
                                                     when 1 then value / 100
                                                     else value end end as duration_sec,
      case when raw = 'purchase' and k < 80 then concat('c', cast(k % 7 as varchar)) end as comment_text
    from (select event_id, cast(ts as timestamp) as ts, user_id, event_type as raw, value,
                 cast(json_extract_string(props, '$.k') as bigint) as k
          from events) b
  ) c
),
dim as (
  select p_partkey as dim_item_id, p_type as category, p_size * 100 as dim_content_len
  from part
),
enr as (
  select com.*, coalesce(dim.category, 'Unknown') as category,
         cast(coalesce(dim.dim_content_len, 0) as integer) as content_len
  from com left join dim on com.item_id = dim.dim_item_id
),
den as (
  select l_orderkey * 8 + l_linenumber as event_id,
         epoch_ms(1704067200000 + (l_orderkey * 8 + l_linenumber) * 10) as ts,
         min(l_suppkey) % 8 as user_id, min(l_partkey) % 100 as item_id,
         min(l_partkey) % 5 as item5,
         case when min(l_quantity) <= 25 then 'like'
              when min(l_quantity) <= 45 then 'comment' else 'enter_item' end as event_type
  from lineitem group by l_orderkey, l_linenumber
),
a1_in as (
  select event_id, user_id, item5 as item_id, event_type, ts, epoch_ms(ts) as t from den
),
a1_runs as (
  select *, sum(case when event_type = 'comment' then 0 else 1 end)
              over (partition by user_id, item_id order by t, event_id
                    rows between unbounded preceding and current row) as run
  from a1_in
),
a1_gaps as (
  select event_id, user_id, item_id, run, t,
         t - lag(t) over (partition by user_id, item_id, run order by t, event_id) as gap,
         lag(t, 4) over (partition by user_id, item_id, run order by t, event_id) as t4
  from a1_runs where event_type = 'comment'
),
a1_flag as (
  select event_id,
         count(gap) over w = 4 and max(gap) over w <= 10000 and t - t4 <= 60000 as flag
  from a1_gaps
  window w as (partition by user_id, item_id, run order by t, event_id
               rows between 3 preceding and current row)
),
a1 as (
  select a.event_id, a.user_id, a.item_id, a.event_type, a.ts, a.t,
         coalesce(f.flag, false) as is_cheat_a1
  from a1_in a left join a1_flag f on a.event_id = f.event_id
),
likes as (
  select event_id, user_id, item_id, event_type, ts, epoch_ms(ts) as t
  from den where event_type = 'like'
),
a2 as (
  select a.event_id, a.user_id, a.item_id, a.event_type, a.ts, a.t
  from likes a join likes b
    on a.user_id = b.user_id and b.t between a.t - 5000 and a.t
   and (b.t < a.t or b.event_id <= a.event_id)
  group by a.event_id, a.user_id, a.item_id, a.event_type, a.ts, a.t
  having count(distinct b.item_id) >= 15
),
gap_starts as (
  select user_id, ts, event_id,
         case when lag(ts) over w is null or event_type = 'app_open'
                or epoch_us(ts) - epoch_us(lag(ts) over w) > 1800000000 then 1 else 0 end as st
  from com where user_id is not null
  window w as (partition by user_id order by ts, event_id)
),
gap_sessions as (
  select user_id, seq, min(ts) as s_start, max(ts) as s_end, count(*) as s_events
  from (select *, sum(st) over (partition by user_id order by ts, event_id
                                rows between unbounded preceding and current row) as seq
        from gap_starts)
  group by user_id, seq
),
given_sessions as (
  select session_id, min(ts) as s_start, max(ts) as s_end, count(*) as s_events
  from com where session_id is not null group by session_id
)
"""

_D = "strftime(ts, '%Y%m%d') as day"


def _w(sec: int) -> str:
    # epoch_ms rounds to the nearest ms; buckets must truncate microseconds.
    us = sec * 1_000_000
    return (f"epoch_us(ts) // {us} * {sec} as window_start, "
            f"epoch_us(ts) // {us} * {sec} + {sec} as window_end")


_PV = "count(*) filter (where event_type = 'enter_item')"
_UV = "count(distinct case when event_type = 'enter_item' then user_id end)"
_LEAVE = "event_type = 'leave_item'"
_D1 = f"count(*) filter (where {_LEAVE} and duration_sec between 0.2 and 1.2)"
_E1 = f"count(*) filter (where {_LEAVE} and duration_sec < 0.8 and content_len > 2000)"
_C = f"count(*) filter (where {_LEAVE} and duration_sec between 1800 and 3600)"


def _cnt(t: str) -> str:
    return f"count(*) filter (where event_type = '{t}')"


_INTER = f"({_cnt('like')} + {_cnt('fav')} + {_cnt('share')} + {_cnt('comment')})"


def _ratio(num: str, den: str) -> str:
    return f"cast({num} as double) / nullif({den}, 0)"


_STAY = (f"cast(round(cast(avg(case when {_LEAVE} then duration_sec end) as decimal(38, 9)), 6)"
         " as double)")

# S-01 counts a session on every day with one of its events; S-02 and S-03
# belong to the day of its first event.
_SESSION_ROLLUP = """
select coalesce(a.day, b.day) as day, coalesce(a.sessions, 0) as sessions,
       b.avg_session_sec, b.avg_events_per_session
from (select day, count(*) as sessions from (
        select distinct strftime(unnest(generate_series(date_trunc('day', s_start),
               date_trunc('day', s_end), interval 1 day)), '%Y%m%d') as day, {id} from {src})
      group by 1) a
full join (
  select strftime(s_start, '%Y%m%d') as day,
         sum(epoch_us(s_end) - epoch_us(s_start)) / count(*) / 1000000.0 as avg_session_sec,
         sum(s_events) / count(*) as avg_events_per_session
  from {src} group by 1) b on a.day = b.day
"""

_ACTIVITY = f"""
  count(distinct user_id) as dau, {_PV} as pv, {_UV} as uv,
  {_cnt('like')} as likes, {_cnt('fav')} as favs, {_cnt('share')} as shares,
  {_cnt('comment')} as comments, {_INTER} as interactions,
  {_cnt('follow')} as follows, {_cnt('unfollow')} as unfollows, {_cnt('dm')} as dms,
  {_cnt('enter_profile')} as profile_visits, count(*) filter (where {_LEAVE}) as n_leave,
  {_D1} as d1_instant_exits, {_E1} as e1_fast_swipes, {_C} as c_long_stays,
  {_ratio(_D1, _PV)} as bounce_rate, {_ratio(_INTER, _PV)} as interaction_rate,
  {_ratio(_cnt('fav'), _PV)} as fav_rate
"""

_KV_FIELDS = [
    "dau", "pv", "uv", "likes", "favs", "shares", "comments", "interactions",
    "follows", "unfollows", "dms", "profile_visits", "n_leave",
    "d1_instant_exits", "e1_fast_swipes", "c_long_stays",
    "bounce_rate", "interaction_rate", "fav_rate",
]

# A stream's serving rows have no distinct users.
_KV_COUNTS = [f for f in _KV_FIELDS if f not in ("dau", "uv")]

_BODIES: dict[str, str] = {
    "event_decode": """
select cast(event_id as varchar) as event_id, user_id, event_type, epoch_us(ts) // 1000 as ts_ms,
       session_id, coalesce(item_id, -1) as item_key, duration_sec, comment_text from com""",
    "event_decode_local_time": """
select cast(event_id as varchar) as event_id, epoch_us(ts) // 1000 as ts_ms from com""",
    "event_tags": f"""
select event_id, coalesce({_LEAVE} and duration_sec between 0.2 and 1.2, false) as is_d1,
       coalesce({_LEAVE} and duration_sec < 0.8 and content_len > 2000, false) as is_e1,
       coalesce({_LEAVE} and duration_sec between 1800 and 3600, false) as is_c
from enr""",
    "enrich_from_file": """
select event_id, category, content_len from enr""",
    "enrich_left_unknown": """
select event_id, coalesce(item_id, -1) as item_key, event_type, category, content_len
from enr""",
    "pv_by_category_30m": f"""
select {_w(1800)}, category, {_PV} as pv from enr group by all""",
    "pv_uv_5m": f"""
select {_w(300)}, {_PV} as pv, {_UV} as uv from com group by all""",
    "pv_uv_by_category_daily": f"""
select {_D}, category, {_PV} as pv, {_UV} as uv from enr group by all""",
    "dau_daily": f"""
select {_D}, count(distinct user_id) as dau,
       count(distinct case when event_type = 'app_open' then user_id end) as dau_app_open
from com group by all""",
    "avg_stay_by_category": f"""
select {_D}, category, count(*) filter (where {_LEAVE}) as n_leave,
       {_STAY} as avg_stay_sec
from enr group by all""",
    "avg_stay_by_item": f"""
select {_D}, item_id, count(*) filter (where {_LEAVE}) as n_leave,
       {_STAY} as avg_stay_sec
from enr where item_id is not null group by all""",
    "bounce_rate_by_item": f"""
select {_D}, item_id, {_PV} as pv, {_D1} as d1_instant_exits,
       {_ratio(_D1, _PV)} as bounce_rate
from enr where item_id is not null group by all""",
    "bounce_rate_by_category": f"""
select {_D}, category, {_PV} as pv, {_D1} as d1_instant_exits,
       {_ratio(_D1, _PV)} as bounce_rate
from enr group by all""",
    "new_users_daily": """
select strftime(first_open, '%Y%m%d') as day, count(*) as new_users
from (select user_id, min(ts) as first_open from com
      where event_type = 'app_open' and user_id is not null group by user_id)
group by 1""",
    "new_users_30m": f"""
select epoch_us(first_open) // 1800000000 * 1800 as window_start,
       epoch_us(first_open) // 1800000000 * 1800 + 1800 as window_end, count(*) as new_users
from (select user_id, min(ts) as first_open from com
      where event_type = 'app_open' and user_id is not null group by user_id)
group by all""",
    "interactions_daily": f"""
select {_D}, category, {_cnt('like')} as likes, {_cnt('fav')} as favs,
       {_cnt('share')} as shares, {_cnt('comment')} as comments, {_INTER} as interactions,
       {_ratio(_INTER, _PV)} as interaction_rate, {_ratio(_INTER, _PV)} as exposure_conversion,
       {_ratio(_cnt('fav'), _PV)} as fav_rate
from enr group by all""",
    "interaction_rates_by_category": f"""
select {_D}, category, {_PV} as pv, {_INTER} as interactions, {_cnt('fav')} as favs,
       {_ratio(_INTER, _PV)} as interaction_rate, {_ratio(_INTER, _PV)} as exposure_conversion,
       {_ratio(_cnt('fav'), _PV)} as fav_rate
from enr group by all""",
    "interactions_30m": f"""
select {_w(1800)}, {_PV} as pv, {_cnt('like')} as likes, {_cnt('fav')} as favs,
       {_cnt('share')} as shares, {_cnt('comment')} as comments, {_INTER} as interactions,
       {_ratio(_INTER, _PV)} as interaction_rate, {_ratio(_INTER, _PV)} as exposure_conversion,
       {_ratio(_cnt('fav'), _PV)} as fav_rate
from enr group by all""",
    "social_counts_daily": f"""
select {_D}, {_cnt('follow')} as follows, {_cnt('unfollow')} as unfollows,
       {_cnt('dm')} as dms, {_cnt('enter_profile')} as profile_visits
from com group by all""",
    "sessions_daily": _SESSION_ROLLUP.format(src="given_sessions", id="session_id"),
    "sessionize_gap": _SESSION_ROLLUP.format(src="gap_sessions", id="user_id, seq"),
    "quality_daily": f"""
select {_D}, count(*) filter (where {_LEAVE}) as n_leave, {_D1} as d1_instant_exits,
       {_E1} as e1_fast_swipes, {_C} as c_long_stays
from enr group by all""",
    "long_stay_daily": f"""
select {_D}, count(*) filter (where {_LEAVE}) as n_leave, {_C} as c_long_stays
from com group by all""",
    "anomalies_by_category": f"""
select day, category, anomaly, events from (
  select day, category, 'D1' as anomaly, d1 as events from q
  union all select day, category, 'E1', e1 from q
  union all select day, category, 'C', c from q
)""",
    "cheat_a1": """
select event_id, user_id, item_id, event_type, t as ts_ms, is_cheat_a1 from a1""",
    "cheat_a2": """
select event_id, user_id, item_id, event_type, t as ts_ms, true as is_cheat_a2 from a2""",
    "cheat_events": """
select a1.event_id, a1.user_id, a1.event_type, a1.t as ts_ms, a1.is_cheat_a1,
       a2.event_id is not null as is_cheat_a2
from a1 left join a2 on a1.event_id = a2.event_id""",
    "cheat_a1_ids": f"""
select {_D}, count(distinct user_id) as a1_users, count(distinct item_id) as a1_items,
       count(*) as a1_events
from a1 where is_cheat_a1 group by all""",
    "cheat_a2_users": f"""
select {_D}, count(distinct user_id) as a2_users, count(*) as a2_events
from a2 group by all""",
    "user_activity_5m": f"""
select {_w(300)}, category, {_ACTIVITY} from enr group by all""",
    "user_activity_30m": f"""
select {_w(1800)}, category, {_ACTIVITY} from enr group by all""",
    "metrics_kv": f"""
select concat('dws:user_activity:', window_start, '_', window_end, ':', category) as key,
       field, value, 3600 as ttl_sec
from (
  unpivot (select window_start, window_end, category,
                  {", ".join(f"coalesce(cast({f} as varchar), '0') as {f}" for f in _KV_FIELDS)}
           from (select {_w(300)}, category, {_ACTIVITY} from enr group by all))
  on {", ".join(_KV_FIELDS)} into name field value value
)""",
}

def _daily_kv(prefix: str, body: str, fields: list[str]) -> str:
    cols = ", ".join(f"coalesce(cast({f} as varchar), '0') as {f}" for f in fields)
    return (f"select '{prefix}:' || day as key, field, value, 3600 as ttl_sec from ("
            f"unpivot (select day, {cols} from ({body})) on {', '.join(fields)} "
            "into name field value value)")


_BODIES["daily_kv"] = "\nunion all\n".join(_daily_kv(p, _BODIES[q], f) for p, q, f in (
    ("dws:dau", "dau_daily", ["dau", "dau_app_open"]),
    ("dws:new_users", "new_users_daily", ["new_users"]),
    ("dws:sessions", "sessions_daily", ["sessions"]),
    ("dws:cheat_a1", "cheat_a1_ids", ["a1_users", "a1_items", "a1_events"]),
    ("dws:cheat_a2", "cheat_a2_users", ["a2_users", "a2_events"])))
_BODIES["interests_daily"] = f"""
, tags as (
  select c_custkey as user_id, c_custkey % 10 as level,
         unnest(case when c_custkey % 5 = 0 then ['Unknown']
                     when c_custkey % 3 = 0 then [lower(c_mktsegment), 'nation_' || c_nationkey]
                     else [lower(c_mktsegment)] end) as tag
  from customer),
per as (
  select {_D}, user_id, count(*) as events, {_PV} as pv, {_INTER} as interactions
  from com where user_id is not null group by all)
select day, coalesce(tag, 'Unknown') as tag, count(*) as users,
       cast(sum(events) as bigint) as events, cast(sum(pv) as bigint) as pv,
       cast(sum(interactions) as bigint) as interactions,
       sum(level) / count(level) as avg_level
from per left join tags using (user_id) group by all"""

# Grain, start and end of the window or day of ts.
_GRAINS = {
    "5m": "epoch_us(ts) // 300000000 * 300 as window_start, window_start + 300 as window_end",
    "30m": "epoch_us(ts) // 1800000000 * 1800 as window_start, window_start + 1800 as window_end",
    "day": ("epoch_us(date_trunc('day', ts)) // 1000000 as window_start, "
            "window_start + 86400 as window_end"),
}


def _all_grains(src: str, what: str, by_category: bool = False) -> str:
    """``what`` over ``src`` per window of every grain, each grain on its own."""
    parts = []
    for grain, bounds in _GRAINS.items():
        for split in ((True, False) if by_category else (None,)):
            keys = "" if split is None else (
                f"{str(split).lower()} as by_category, "
                f"{'category' if split else 'cast(null as varchar) as category'}, ")
            parts.append(f"select '{grain}' as grain, {bounds}, {keys}{what} from {src} group by all")
    return "\nunion all\n".join(parts)


_USERS = f"""count(distinct user_id) as dau,
  count(distinct case when event_type = 'app_open' then user_id end) as dau_app_open, {_UV} as uv"""

_BODIES["activity_all_grains"] = _all_grains("enr", f"""{_USERS},
  count(*) as n_events, {_cnt('app_open')} as n_app_open, {_PV} as pv,
  count(*) filter (where {_LEAVE}) as n_leave,
  {_cnt('like')} as likes, {_cnt('fav')} as favs, {_cnt('share')} as shares,
  {_cnt('comment')} as comments, {_INTER} as interactions, {_cnt('follow')} as follows,
  {_cnt('unfollow')} as unfollows, {_cnt('dm')} as dms, {_cnt('enter_profile')} as profile_visits,
  {_STAY} as avg_stay_sec, {_D1} as d1_instant_exits, {_E1} as e1_fast_swipes,
  {_C} as c_long_stays, {_ratio(_D1, _PV)} as bounce_rate,
  {_ratio(_INTER, _PV)} as interaction_rate, {_ratio(_INTER, _PV)} as exposure_conversion,
  {_ratio(_cnt('fav'), _PV)} as fav_rate""", by_category=True)
_BODIES["users_sketch_rollup"] = _all_grains("enr", _USERS, by_category=True)
_BODIES["users_bitmap_rollup"] = _BODIES["users_sketch_rollup"]
_BODIES["sessions_bitmap_rollup"] = _all_grains(
    "(select * from com where session_id is not null)", "count(distinct session_id) as sessions")
_BODIES["new_users_all_grains"] = _all_grains("""
  (select min(ts) as ts from com where event_type = 'app_open' and user_id is not null
   group by user_id)""", "count(*) as new_users")
_BODIES["cheat_all_grains"] = _all_grains("""
  (select ts, user_id, item_id, 1 as rule from a1 where is_cheat_a1
   union all select ts, user_id, null, 2 from a2)""", """
  count(distinct user_id) filter (where rule = 1) as a1_users,
  count(distinct item_id) filter (where rule = 1) as a1_items,
  count(*) filter (where rule = 1) as a1_events,
  count(distinct user_id) filter (where rule = 2) as a2_users,
  count(*) filter (where rule = 2) as a2_events""")
_STARTED = _all_grains("(select *, s_start as ts from given_sessions)", """
  sum(epoch_us(s_end) - epoch_us(s_start)) / count(*) / 1000000.0 as avg_session_sec,
  sum(s_events) / count(*) as avg_events_per_session""")
_BODIES["sessions_all_grains"] = f"""
select a.grain, a.window_start, a.window_end, a.sessions,
       b.avg_session_sec, b.avg_events_per_session
from ({_BODIES["sessions_bitmap_rollup"]}) a
left join ({_STARTED}) b on a.grain = b.grain and a.window_start = b.window_start"""

# Q-08 needs the per-category counters first.
_Q8 = f"""
, q as (select {_D}, category, {_D1} as d1, {_E1} as e1, {_C} as c from enr group by all)
"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in _BODIES.items():
        if name == "anomalies_by_category":
            out[name] = _PRELUDE + _Q8 + body
        else:
            out[name] = _PRELUDE + body
    return out


# Streaming queries: the whole tables, open windows and sessions included.
def stream_bodies() -> dict[str, str]:
    mid = ("(select cast(min(ts) as date) + cast((cast(max(ts) as date) - cast(min(ts) as date)) // 2 as integer) "
           "from com)")
    bodies = {
        "stream_pv_5m": f"""
select {_w(300)}, category, {_PV} as pv, {_cnt('like')} as likes, count(*) as n_events
from enr group by all""",
        "stream_activity_daily": f"""
select {_D}, category, {_PV} as pv, {_cnt('like')} as likes, {_cnt('comment')} as comments,
       {_D1} as d1_instant_exits, count(*) as n_events
from enr group by all""",
        "stream_uv_5m_exact": f"""
select {_w(300)}, {_UV} as uv from com group by all""",
        "stream_uv_by_category_30m": f"""
select {_w(1800)}, category, {_UV} as uv from enr group by all""",
        "stream_dau_5m_exact": f"""
select {_w(300)}, count(distinct user_id) as dau from com group by all""",
        "stream_cheat_a1": _BODIES["cheat_a1"],
        "stream_cheat_a2": _BODIES["cheat_a2"],
        "stream_new_users": """
select count(distinct user_id) as new_users from com
where event_type = 'app_open' and user_id is not null""",
        "stream_archive": """
select strftime(ts, '%Y%m%d') as day, count(*) as events from com group by 1""",
        "stream_late_dropped": f"""
select count(*) filter (where cast(ts as date) <= {mid}) as dropped_rows,
       count(*) filter (where cast(ts as date) > {mid}) as emitted_rows
from com where item_id is not null""",
        "stream_enrich_versions": f"""
select event_id, case when v2 then 1 else 0 end as batch_id,
       case when v2 and item_id % 2 = 0 and category <> 'Unknown' then category || ' v2'
            else category end as category,
       case when v2 and item_id % 2 = 0 and category <> 'Unknown' then 1 else content_len end
         as content_len
from (select *, cast(ts as date) > {mid} as v2 from enr)""",
        "stream_kv_update": f"""
select concat('dws:user_activity:', window_start, '_', window_end, ':', category) as key,
       field, value, 3600 as ttl_sec
from (
  unpivot (select window_start, window_end, category,
                  {", ".join(f"coalesce(cast({f} as varchar), '0') as {f}" for f in _KV_COUNTS)}
           from (select {_w(300)}, category, {_ACTIVITY} from enr group by all))
  on {", ".join(_KV_COUNTS)} into name field value value
)""",
        "stream_totals_complete": f"""
select category, {_PV} as pv, count(*) as n_events from enr group by all""",
        "stream_cheat_a1_ordered": _BODIES["cheat_a1"],
        "stream_cheat_a2_ordered": _BODIES["cheat_a2"],
        "stream_late_rows": f"""
select event_id, user_id, event_type, epoch_us(ts) // 1000 as ts_ms, count(*) over () as late_rows
from com where cast(ts as date) <= {mid}""",
        "stream_sessions_gap": _BODIES["sessionize_gap"],
    }
    bodies["stream_kv_sink"] = bodies["stream_kv_update"]
    return {k: _PRELUDE + v for k, v in bodies.items()}

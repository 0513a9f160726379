"""Oracle SQL (DuckDB dialect) for every parity query in :mod:`.queries`.

The tables are registered as views by the caller. Column names equal the
Spark results'; averages are rounded to 6 decimals the same way.
"""

from __future__ import annotations

from ..functions.text import (DEFAULT_SENSOR_PATTERN, EQUALS_BRACKET_VALUE, EVENT_VALUE,
                              KEYWORD_VALUE)
from .dumps import DUMPS_SQL
from .tables import GEO_SQL

W_USER = "(partition by user_id order by ts, event_id)"
W_TYPE = "(partition by event_type order by ts, event_id)"
MIN_US = "(select min(epoch_us(ts)) from events)"
MAX_US = "(select max(epoch_us(ts)) from events)"

# The patterns of the dump reader, in RE2 syntax.
_KV = "(?i)" + KEYWORD_VALUE
_EB = "(?i)" + EQUALS_BRACKET_VALUE
_BR = "(?i)" + EVENT_VALUE
_SENSOR = "(?i)" + DEFAULT_SENSOR_PATTERN


def _num(pattern: str, line: str = "l") -> str:
    return f"try_cast(nullif(regexp_extract({line}, '{pattern}', 1), '') as double)"


def extract_sql(source: str) -> str:
    """The dump rule in DuckDB SQL over ``source`` (a relation with event_id, text)."""
    return f"""
with d as {source},
f as (
  select event_id,
    list_transform(string_split(text, chr(10)), lambda l, i: struct_pack(
      i := i,
      s := regexp_matches(l, '{_SENSOR}'),
      kv := coalesce({_num(_KV)}, {_num(_EB)}),
      ev := contains(lower(l), 'event'),
      br := {_num(_BR)})) as facts
  from d
)
select event_id,
  list_filter(
    list_transform(list_filter(facts, lambda x: x.s), lambda s:
      coalesce(
        list_filter(list_slice(facts, s.i, s.i + 24), lambda x: x.kv is not null)[1].kv,
        list_filter(list_slice(facts, s.i, s.i + 24), lambda x:
          x.i > list_filter(list_slice(facts, s.i, s.i + 24), lambda y: y.ev)[1].i
          and not x.ev and x.br is not null)[1].br)),
    lambda v: v is not null)[1] as lx
from f
"""


EXTRACT_SQL = extract_sql(DUMPS_SQL)


ORACLE: dict[str, str] = {
    "window_stats": """
        select date_trunc('hour', ts) as fenster_start,
               date_trunc('hour', ts) + interval 1 hour as fenster_ende,
               round(avg(value + user_id), 6) as avg_absolute,
               round(avg(value), 6) as avg_gx,
               round(avg(user_id::double), 6) as avg_gy,
               round(avg(value - user_id), 6) as avg_gz,
               count(*) as n_samples
        from events group by 1, 2""",
    "half_second_windows": """
        select date_trunc('second', ts) as fenster_start,
               date_trunc('second', ts) + interval 500 millisecond as fenster_ende,
               count(*) as n_samples
        from events group by 1, 2""",
    "valid_coords": f"""
        select event_id, lat, lon from {GEO_SQL}
        where lat between -90 and 90 and lon between -180 and 180""",
    "segments": f"""
        select user_id, event_id, prev_lat, prev_lon, lat, lon from (
          select user_id, event_id, lat, lon,
                 lag(lat) over w as prev_lat, lag(lon) over w as prev_lon,
                 row_number() over w as rn
          from {GEO_SQL} window w as {W_USER}) where rn > 1""",
    "on_change": f"""
        select event_type, event_id, ts, value from (
          select *, lag(value) over {W_TYPE} as p from events)
        where value is distinct from p""",
    "sample_gap": f"""
        select event_id, user_id, gap_us::double as gap_us,
               round(gap_us / 1e6 / 5.0::double, 6) as gap_s,
               round(case when gap_us / 1e6 / 5.0::double > 0
                           and gap_us / 1e6 / 5.0::double < 5
                          then gap_us / 1e6 / 5.0::double else 0.0 end, 6) as pause_s
        from (select event_id, user_id,
                     epoch_us(ts) - lag(epoch_us(ts)) over {W_USER} as gap_us
              from events)""",
    "last_k": """
        select event_id, ts, value from events where event_type = 'click'
        order by ts desc, event_id desc limit 200""",
    "trailing": """
        select event_id, ts, value from events
        where ts >= (select max(ts) from events) - interval 2 hours""",
    "time_range": """
        select event_id, ts, value from events
        where ts >= timestamp '2024-01-05 00:00:00' and ts < timestamp '2024-01-06 00:00:00'
          and event_type = 'click'""",
    "time_bounds": """
        select min(ts) as first_ts, max(ts) as last_ts, count(*) as n from events""",
    "to_points": """
        select event_id, 'reading' as measurement, 'value' as field, value, ts as time,
               epoch_us(ts) * 1000 as time_ns from events
        union all
        select event_id, 'user' as measurement, 'id' as field, user_id::double as value,
               ts as time, epoch_us(ts) * 1000 as time_ns from events""",
    "day_bucket_last": """
        select event_type, ts::date::timestamp as day_bucket, count(*) as n,
               arg_min(value, (ts, event_id)) as first_v,
               arg_max(value, (ts, event_id)) as last_v
        from events group by 1, 2""",
    "latest_by_key": """
        select user_id, event_id, ts, event_type, value from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "magnitude": """
        select event_id,
               round(sqrt(value*value + user_id::double*user_id::double
                          + (event_id % 10)::double*(event_id % 10)::double), 6) as magnitude
        from events""",
    "track_summary": """
        with w as (
          select date_trunc('hour', ts) as s, avg(value) as hr_mean,
                 avg(user_id::double) as alt_mean, count(value) as n
          from events group by 1)
        select count(*) as n_windows,
               round(avg(hr_mean), 6) as hr_mean_avg,
               round(sum(hr_mean * n) / sum(case when hr_mean is not null then n end), 6)
                 as hr_mean_weighted,
               round(avg(alt_mean), 6) as alt_mean_avg,
               round(sum(alt_mean * n) / sum(case when alt_mean is not null then n end), 6)
                 as alt_mean_weighted
        from w""",
    "json_field": """
        select event_id, try_cast(props ->> 'k' as integer) as k from events""",
    "window_key": """
        select concat('sensor:gyro:', epoch_ms(date_trunc('second', ts))) as key,
               count(*) as n_samples
        from events group by 1""",
    "date_formats": """
        select event_id, strftime(ts, '%d.%m.%Y') as d_dot, strftime(ts, '%d.%B %Y') as d_long,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as iso
        from events""",
    "to_zone": """
        select event_id, local_ts, offset_min,
               case when offset_min < 0 then '-' else '+' end
                 || lpad((abs(offset_min) // 60)::varchar, 2, '0') || ':'
                 || lpad((abs(offset_min) % 60)::varchar, 2, '0') as utc_offset
        from (
          select event_id, local_ts,
                 ((epoch_us(local_ts) - epoch_us(ts)) // 60000000)::integer as offset_min
          from (select event_id, ts,
                       (ts at time zone 'UTC') at time zone 'Europe/Zurich' as local_ts
                from events))""",
    "fixed_decimals": f"""
        select event_id, printf('%.6f', alt) as txt,
               printf('%d,%.8f,%.8f,%.2f,%.0f,%.1f', epoch_us(ts) // 1000, lat, lon, alt,
                      user_id::double, (user_id % 40)::double) as message
        from {GEO_SQL}""",
    "extract_readings": EXTRACT_SQL,
    "layout_dispatch": """
        select event_id,
               case event_id % 3 when 0 then 'walk' when 1 then 'fitness' else 'reject' end as kind,
               case when event_id % 3 < 2 then date_trunc('second', ts) end as zeit,
               case when event_id % 3 = 0 then value end as speed,
               case when event_id % 3 = 1 then user_id::double end as hr,
               case when event_id % 3 = 1 then (user_id % 40)::double end as temp
        from events""",
    "rebase": f"""
        select event_id,
               make_timestamp(1700000000000000 + ((epoch_us(ts) - {MIN_US}) // 1000) * 1000)
                 as ts_rebased
        from events""",
    "rebase_to_end": f"""
        select event_id, make_timestamp(1700000000000000 + epoch_us(ts) - {MAX_US}) as ts_rebased
        from events""",
    "elapsed": f"""
        select event_id, round((epoch_us(ts) - {MIN_US}) / 1e6, 6) as elapsed_s from events""",
    "skip_warmup": """
        select event_id, ts from events
        where ts >= (select min(ts) from events) + interval 1 second""",
    "skip_zero": """
        select event_id, ts from events where event_id::varchar <> '0'""",
    "rejects": """
        select event_id, case when event_id % 7 = 0 then null else value end as value,
               case when event_id % 7 = 0 then 'bad:value' end as reason
        from events""",
    "unseen": """
        select e.event_id, e.user_id, e.ts::date::timestamp as day_bucket, e.event_type
        from events e
        where e.event_type <> 'click' and not exists (
          select 1 from events c where c.event_type = 'click'
            and c.user_id = e.user_id and c.ts::date = e.ts::date)""",
    "ttl": """
        select user_id, event_id, ts, ts + interval 6 hours as expires_at from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1
          and ts + interval 6 hours > timestamp '2024-01-30 23:00:00'""",
    "altitude_delta": """
        select user_id, day_bucket::timestamp as day_bucket, round(alt_mean, 6) as alt_mean,
               round(alt_mean - lag(alt_mean) over (partition by user_id order by day_bucket), 6)
                 as d_alt
        from (select user_id, ts::date as day_bucket, avg(value) as alt_mean
              from events group by 1, 2)""",
    "lag_stitched": f"""
        select event_type, event_id, value, lag(value) over {W_TYPE} as prev_value
        from events""",
}

_SC = "(2147483648.0::double / 180.0::double)"
_DEG = "(180.0::double / 2147483648.0::double)"

ORACLE.update({
    "window_stats_by_series": """
        select date_trunc('hour', ts) as fenster_start, user_id,
               round(avg(value), 6) as v_mean, count(value) as n_samples
        from events group by 1, 2""",
    "extract_readings_long": f"select * from ({EXTRACT_SQL}) where lx is not null",
    "payload_ingest": """
        select event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) as zeit,
               value as gx, user_id::double as gy, 0.0::double as gz,
               round(sqrt(value*value + user_id::double*user_id::double + 0.0::double), 6)
                 as absolute
        from events""",
    "last_k_per_key": """
        select user_id, event_id, ts, value from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 3""",
    "trailing_per_key": """
        select e.event_type, e.event_id, e.ts from events e
        join (select event_type, max(ts) as m from events group by 1) t
          on e.event_type = t.event_type
        where e.ts >= t.m - interval 6 hours""",
    "semicircles": f"""
        select event_id, lat, lon,
               case when lat between -90 and 90 and lon between -180 and 180 then null
                    else 'coords out of range' end as reason
        from (select event_id,
                     trunc(lat * {_SC})::bigint::double * {_DEG} as lat,
                     trunc(lon * {_SC})::bigint::double * {_DEG} as lon
              from {GEO_SQL})""",
    "load_counts": """
        select 'kept' as outcome, count(*) as n from events where event_id % 7 <> 0
        union all
        select 'bad:value' as outcome, count(*) as n from events where event_id % 7 = 0""",
    "points_range": """
        select ts as time, value from events
        where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-12 00:00:00'""",
    "detect_unit": """
        select event_id,
               case event_id % 4 when 0 then 's' when 1 then 'ms' when 2 then 'us' else 'ns' end
                 as unit,
               case event_id % 4 when 0 then date_trunc('second', ts)
                                 when 1 then make_timestamp((epoch_us(ts) // 1000) * 1000)
                                 else ts end as ts_back
        from events""",
    "normalise_line": """
        select event_id, cast(value as varchar) || ',' || cast(user_id::double as varchar) as line
        from events""",
    "track_windows": f"""
        select date_trunc('second', ts) as fenster_start,
               round(avg(lat), 6) as lat_mean, round(avg(lon), 6) as lon_mean,
               round(avg(alt), 6) as alt_mean,
               round(avg(case when event_id % 3 = 1 then user_id::double end), 6) as hr_mean,
               round(avg(case when event_id % 3 = 1 then (user_id % 40)::double end), 6)
                 as temp_mean,
               count(lat) as n_samples
        from {GEO_SQL}
        where event_id % 3 < 2 and lat between -90 and 90 and lon between -180 and 180
        group by 1""",
})

ORACLE.update({
    "event_seconds": """
        select event_id, case when event_id % 11 > 3 then date_trunc('second', ts) end as zeit from events""",
    "rebase_seconds": """
        select event_id, case when event_id % 11 > 1 then 1700000000000.0::double + event_id * 250.0::double end as ts_ms
        from events""",
    "bad_times": """
        select event_id,
               case when event_id % 5 > 2 then make_timestamp((epoch_us(ts) // 1000) * 1000) end as zeit,
               case event_id % 5 when 0 then 'bad:time' when 1 then 'bad:time' when 2 then 'empty' end as reason
        from events""",
    "fill_zero": """
        select event_id, case when event_id % 7 < 2 then 0.0::double else value end as v from events""",
    "number_text": """
        select event_id, case when event_id % 7 = 0 then '' else printf('%.1f', user_id::double) end as txt from events""",
    "drop_missing": """
        select event_id, case when event_id % 7 < 2 then 'missing:v' end as reason from events""",
    "min_fields": """
        select event_id, case when event_id % 5 < 3 then 'fields<4' end as reason from events""",
    "drop_incomplete": f"""
        select * from (
          select time_bucket(interval 10 minute, ts) as fenster_start,
                 round(avg(case when lat < 60 then lat end), 6) as lat_mean,
                 round(avg(case when lon > 120 then lon end), 6) as lon_mean, count(*) as n_samples
          from {GEO_SQL} group by 1)
        where lat_mean is not null and lon_mean is not null""",
    "payload_rejects": """
        select event_id,
               case when event_id % 5 > 1 then make_timestamp((epoch_us(ts) // 1000) * 1000) end as zeit,
               case when event_id % 5 > 1 then value end as lat,
               case when event_id % 5 > 1 then user_id::double end as lon,
               case when event_id % 5 > 1 then 0.0::double end as alt,
               case when event_id % 5 > 1 then 0.0::double end as speed,
               case event_id % 5 when 0 then 'bad:json' when 1 then 'bad:lon' end as reason
        from events""",
    "payload_readings": """
        select event_id, 'light' as sensor_id, round((epoch_us(ts) // 1000) / 1000.0::double, 6) as time_sec, value as lx
        from events where event_id % 5 > 1""",
    "track_speed": f"""
        select date_trunc('hour', ts) as fenster_start, round(avg(alt), 6) as alt_mean,
               round(avg(case when event_id % 3 = 0 then alt end), 6) as speed_mean, count(*) as n_samples
        from {GEO_SQL}
        where event_id % 3 < 2 and lat between -90 and 90 and lon between -180 and 180
        group by 1""",
    "track_summary_gaps": """
        select (select count(distinct date_trunc('hour', ts)) from events) as n_windows,
               round(avg(case when event_id % 3 = 0 then value end), 6) as hr_mean_weighted,
               round(avg(user_id::double), 6) as alt_mean_weighted
        from events""",
    "trailing_null_key": """
        select event_id, ts from (
          select *, max(ts) over (partition by case when event_type <> 'click' then event_type end) as m from events)
        where ts >= m - interval 6 hours""",
    "unseen_null_key": """
        select e.event_id from events e where e.event_id % 2 = 0 and not exists (
          select 1 from events s where s.event_id % 16 = 1 and s.user_id = e.user_id and s.ts::date = e.ts::date
            and (case when s.event_type <> 'click' then s.event_type end)
                is not distinct from (case when e.event_type <> 'click' then e.event_type end))""",
})

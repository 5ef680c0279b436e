"""The same results in SQL, for a check against another engine.

Written from the definitions and row by row where the operators aggregate, so
that the two agree only if both are right. ``events``, ``nation`` and
``region`` are the sample tables.
"""

from __future__ import annotations

NY = "timezone('America/New_York', to_timestamp({0}))"
_HOUR = "'%Y-%m-%d %H:%M:%S'"


def _local(epoch: str) -> str:
    return NY.format(epoch)


def _text(local: str) -> str:
    return f"strftime({local}, {_HOUR})"


def _clock(epoch: str, missing: str = "(none)") -> str:
    return f"coalesce(strftime({_local(f'nullif({epoch}, 0)')}, '%H:%M:%S'), '{missing}')"


_STATION = "case when right({0}, 1) in ('N', 'S') then left({0}, length({0}) - 1) else {0} end"
_SIDE = "case when right({0}, 1) in ('N', 'S') then right({0}, 1) end"
_DIRECTION = "case {0} when 1 then 'NORTH' when 2 then 'EAST' when 3 then 'SOUTH' when 4 then 'WEST' end"
_RELATION = "case {0} when 1 then 'SKIPPED' when 2 then 'NO_DATA' when 3 then 'UNSCHEDULED' else 'SCHEDULED' end"
_TRIP = "lpad(cast((user_id * 137) % 144000 as varchar), 6, '0') || '_' || event_type"
_STOP = """case when event_id % 23 = 0 then 'R65N' when event_id % 5 = 0 then '127'
         when event_id % 5 in (1, 2) then '127N' else '127S' end"""
_START = "strftime(make_timestamp((t - 14400) * 1000000), '%Y%m%d')"

S1, S2 = 1_704_700_000, 1_705_700_000

CTES: dict[str, str] = {
    "e": """select event_id, user_id, event_type, cast(floor(epoch(ts)) as bigint) as t,
         cast(floor(value) as bigint) as v from events""",
    "once": f"""select event_id, event_type as feed_id, t as observed_at, t + event_id % 97 as fetched_at,
         {_TRIP} as trip_id, event_type as route_id, {_START} as start_date,
         case when event_id % 4 = 0 then 'SOUTH' else 'NORTH' end as direction,
         'train-' || cast(user_id as varchar) as train_id, event_id % 3 = 0 as is_assigned,
         {_STOP} as stop_id, event_id % 20 as stop_sequence,
         case when event_id % 17 <> 0 then t + v * 4 - 60 end as predicted_arrival,
         case when event_id % 17 <> 0 then t + v * 4 - 30 end as predicted_departure,
         cast(event_id % 4 as varchar) as scheduled_track,
         case when event_id % 2 = 0 then cast(event_id % 4 as varchar) end as actual_track,
         case when event_id % 11 = 0 then 'SKIPPED' when event_id % 13 = 0 then 'NO_DATA'
              else 'SCHEDULED' end as schedule_relationship from e""",
    "landing": """select * exclude (event_id) from once union all
         select * exclude (event_id) replace (fetched_at + 60 as fetched_at) from once where event_id % 7 = 0""",
    "stg": f"""select feed_id, trip_id, stop_id, {_STATION.format('stop_id')} as station_id,
         {_SIDE.format('stop_id')} as platform_direction, route_id, start_date as service_date_raw,
         observed_at, fetched_at, predicted_arrival, predicted_departure,
         fetched_at - observed_at as feed_lag_seconds, direction, train_id, is_assigned, stop_sequence,
         scheduled_track, actual_track, schedule_relationship,
         round(try_cast(split_part(trip_id, '_', 1) as integer) / 100.0, 9) as trip_origin_minutes
         from landing qualify row_number() over (
           partition by feed_id, observed_at, trip_id, stop_id
           order by fetched_at, route_id, start_date, direction, train_id, is_assigned, stop_sequence,
             predicted_arrival, predicted_departure, scheduled_track, actual_track,
             schedule_relationship) = 1""",
    "watermark": "select feed_id, max(observed_at) as observed_through from stg group by 1",
    "ls": """with seen as (select *, row_number() over (partition by service_date_raw, trip_id, stop_id
             order by observed_at desc, feed_id) as recency,
             count(*) over (partition by service_date_raw, trip_id, stop_id) as observations_of_pair
           from stg where predicted_arrival is not null and schedule_relationship = 'SCHEDULED')
         select service_date_raw, seen.feed_id, route_id, trip_id, train_id, stop_id, station_id,
           platform_direction, direction, predicted_arrival as last_predicted_arrival,
           observed_at as last_seen_at, predicted_arrival - observed_at as lead_seconds,
           observations_of_pair, scheduled_track, actual_track,
           observed_at < observed_through as has_vanished
         from seen join watermark on seen.feed_id = watermark.feed_id where recency = 1""",
}


def _facts(grace: int, suffix: str = "") -> dict[str, str]:
    local = _local("inferred_arrival")
    return {
        f"ia{suffix}": f"""select service_date_raw, feed_id, route_id, trip_id, train_id, stop_id, station_id,
           platform_direction, direction, last_predicted_arrival as inferred_arrival, last_seen_at,
           lead_seconds, observations_of_pair, scheduled_track, actual_track
         from ls where has_vanished and last_predicted_arrival <= last_seen_at + {grace}""",
        f"fa{suffix}": f"""select service_date_raw, feed_id, route_id, trip_id, train_id, stop_id, station_id,
           platform_direction, direction, inferred_arrival, {_text(local)} as arrival_local,
           {_text(f"date_trunc('hour', {local})")} as service_hour,
           extract(hour from {local}) as hour_of_day, extract(dayofweek from {local}) as day_of_week,
           last_seen_at, lead_seconds, observations_of_pair, scheduled_track, actual_track from ia{suffix}""",
        f"fh{suffix}": f"""with sequenced as (select *,
             lag(inferred_arrival) over w as previous_arrival, lag(trip_id) over w as previous_trip_id
           from fa{suffix} window w as (partition by service_date_raw, route_id, stop_id
             order by inferred_arrival, trip_id))
         select service_date_raw, route_id, stop_id, station_id, platform_direction, trip_id,
           previous_trip_id, previous_arrival, inferred_arrival, arrival_local, service_hour,
           hour_of_day, day_of_week, (inferred_arrival - previous_arrival) / 60.0 as headway_minutes
         from sequenced where previous_trip_id <> trip_id
           and (inferred_arrival - previous_arrival) / 60.0 between 0.5 and 60""",
        f"fe{suffix}": f"""select service_date_raw, route_id, stop_id, station_id, platform_direction,
           service_hour, hour_of_day, day_of_week, count(*) as headways,
           avg(headway_minutes) as mean_headway_minutes, min(headway_minutes) as min_headway_minutes,
           max(headway_minutes) as max_headway_minutes,
           sum(headway_minutes * headway_minutes) / (2 * sum(headway_minutes)) as rider_wait_minutes,
           avg(headway_minutes) / 2 as even_wait_minutes,
           sum(headway_minutes * headway_minutes) / (2 * sum(headway_minutes)) - avg(headway_minutes) / 2
             as excess_wait_minutes
         from fh{suffix} group by all""",
    }


CTES |= _facts(120)
CTES |= _facts(240, "240")
CTES |= {
    "stops": """select cast(120 + n_nationkey as varchar) || side as stop_id, n_name as stop_name,
         cast(round(40.5 + n_nationkey / 100.0, 2) as double) as lat,
         cast(round(-74.0 + n_regionkey / 10.0, 1) as double) as lon,
         case when side = '' then '1' else '' end as location_type,
         case when side = '' then '' else cast(120 + n_nationkey as varchar) end as parent_station
         from nation, (values (''), ('N'), ('S')) sides(side)""",
    "routes": """select distinct event_type as route_id, upper(event_type) as route_short_name,
         event_type || ' line' as route_long_name, '' as route_desc,
         case event_type when 'click' then '0062CF' when 'view' then '' else 'EB6800' end as route_color,
         'FFFFFF' as route_text_color from events
         union all select r_name, upper(r_name), r_name || ' line', '', null, '' from region""",
    "published": """select stop_id as station_id, stop_name as station_name, lat as latitude,
         lon as longitude from stops where location_type = '1'""",
    "seen_stations": """select station_id, count(*) as observations, count(distinct route_id) as routes_observed
         from stg where station_id is not null group by 1""",
    "ds": """with every as (select *, true as is_published from published union all
           select station_id, null, null, null, false from seen_stations
           where station_id not in (select station_id from published)),
         platforms as (select parent_station as station_id, count(*) as platform_count from stops
           where parent_station <> '' group by 1)
         select station_id, station_name, round(latitude, 4) as latitude, round(longitude, 4) as longitude,
           is_published, coalesce(platform_count, 0) as platform_count,
           coalesce(observations, 0) as observations, coalesce(routes_observed, 0) as routes_observed
         from every left join platforms using (station_id) left join seen_stations using (station_id)""",
    "dr": """with seen as (select route_id, min(feed_id) as feed_id, count(distinct trip_id) as trips_observed,
           min(observed_at) as first_observed_at, max(observed_at) as last_observed_at
           from stg where route_id is not null group by 1)
         select route_id, route_short_name, route_long_name, '#' || nullif(route_color, '') as route_color,
           '#' || nullif(route_text_color, '') as route_text_color, feed_id,
           coalesce(trips_observed, 0) as trips_observed, first_observed_at, last_observed_at
         from routes left join seen using (route_id)""",
    "hours": f"""select distinct date_trunc('hour', {_local('t')}) as h from e""",
    "wx": f"""with numbered as (select h, cast(epoch(h) / 3600 as bigint) as k from hours)
         select {_text('h')} as service_hour,
           case when k % 9 in (0, 1) then (k % 7) * 0.5 else 0.0 end::double as precip_mm,
           (k % 30 - 5.0)::double as temperature_c, (k % 40 * 1.0)::double as wind_kmh,
           k % 9 in (0, 1) and k % 7 > 0 as is_wet from numbered""",
    "graces": "select unnest([30, 60, 120, 240, 480]) as grace",
    "sweep_fa": f"""select grace, ls.*, last_predicted_arrival as inferred_arrival,
           {_text(f"date_trunc('hour', {_local('last_predicted_arrival')})")} as service_hour
         from ls join graces on lead_seconds <= grace where has_vanished""",
    "sweep_fh": """with sequenced as (select *,
             lag(inferred_arrival) over w as previous_arrival, lag(trip_id) over w as previous_trip_id
           from sweep_fa window w as (partition by grace, service_date_raw, route_id, stop_id
             order by inferred_arrival, trip_id))
         select *, (inferred_arrival - previous_arrival) / 60.0 as h from sequenced
         where previous_trip_id <> trip_id and (inferred_arrival - previous_arrival) / 60.0 between 0.5 and 60""",
    "sweep": """with hourly as (select grace, count(*) as n, avg(h) as mean,
             sum(h * h) / (2 * sum(h)) - avg(h) / 2 as excess
           from sweep_fh group by grace, service_date_raw, route_id, stop_id, service_hour)
         select grace, (select count(*) from sweep_fa f where f.grace = g.grace) as arrivals,
           (select count(*) from sweep_fh f where f.grace = g.grace) as headways,
           (select count(*) from hourly h where h.grace = g.grace and n >= 3) as route_hours,
           round((select avg(mean) from hourly h where h.grace = g.grace and n >= 3), 9) as mean_headway,
           (select avg(excess) from hourly h where h.grace = g.grace and n >= 3) as excess_wait
         from graces g""",
}

# -- nested snapshots, unnested again -----------------------------------------------

CTES |= {
    "parts": f"""select event_type as feed_id, event_id // 64 as message, user_id, event_id, t, v,
         {_TRIP} as raw_trip, {_STOP} as stop_id,
         case when event_id % 17 = 0 then 0 else t + v * 4 - 60 end as arrival,
         case when event_id % 17 = 0 or t + v * 4 - 60 = 0 then 0 else t + v * 4 - 30 end as departure from e""",
    "made": "select feed_id, message, max(t) as made from parts group by 1, 2",
    "trip_dates": "select feed_id, message, user_id, max(t) as t from parts group by 1, 2, 3",
    "fetches": """select feed_id, message, made, attempt,
         case when message % 50 = 7 then 0 when attempt = 2 then made - 30 else made end as header,
         cast(made + 3.25 + attempt * 5.5 as double) as fetched_at
         from made, (select unnest([0, 1, 2, 3]) as attempt) a
         where attempt = 0 or (message % 4 = 0 and attempt = 1) or (message % 8 = 0)""",
    "kept": """select * exclude (before) from (select *,
           lag(header) over (partition by feed_id order by fetched_at, header) as before
         from fetches where header > 0) s where before is distinct from header""",
}


def _flat(fetched: str) -> str:
    return f"""select p.feed_id, f.header as observed_at, cast(floor(f.fetched_at) as bigint) as fetched_at,
         case when p.user_id % 29 <> 0 then p.raw_trip end as trip_id, p.feed_id as route_id,
         (select {_START} from (select d.t as t)) as start_date,
         case when p.user_id % 13 <> 0 then {_DIRECTION.format('p.user_id % 6')} end as direction,
         case when p.user_id % 13 <> 0 and p.user_id % 17 <> 0
           then 'train-' || cast(p.user_id as varchar) end as train_id,
         case when p.user_id % 13 <> 0 then p.user_id % 3 = 0 end as is_assigned, p.stop_id,
         row_number() over (partition by p.feed_id, p.message, p.user_id, f.attempt order by p.event_id) - 1
           as stop_sequence,
         nullif(p.arrival, 0) as predicted_arrival, nullif(p.departure, 0) as predicted_departure,
         case when p.event_id % 19 <> 0 then cast(p.event_id % 4 as varchar) end as scheduled_track,
         case when p.event_id % 19 <> 0 and p.event_id % 2 = 0 then cast(p.event_id % 4 as varchar) end
           as actual_track,
         {_RELATION.format('(p.event_id % 6)')} as schedule_relationship
       from parts p join trip_dates d using (feed_id, message, user_id)
         join {fetched} f using (feed_id, message)
       where p.user_id % 7 <> 3 and p.user_id % 11 <> 5"""


_STOP_LINE = f"""stop_id || ' ' || {_clock('arrival')} || ' ' || {_clock('departure')} || ' ' ||
  case when event_id % 19 = 0 then '' else cast(event_id % 4 as varchar) end"""

CTES["longest"] = f"""with trips as (select feed_id, message, user_id, count(*) as stops, max(raw_trip) as raw_trip,
    string_agg(line, '; ' order by event_id) filter (where position <= 5) as next_stops
  from (select *, {_STOP_LINE} as line, row_number() over (
      partition by feed_id, message, user_id order by event_id) as position from parts)
  where user_id % 7 <> 3 and user_id % 11 <> 5 group by 1, 2, 3)
select * from trips qualify row_number() over (partition by feed_id, message order by stops desc, user_id) = 1"""

CTES["entities"] = """select feed_id, message, count(*) as entities,
    count(*) filter (where user_id % 7 <> 3 and user_id % 11 <> 5) as trip_updates,
    count(*) filter (where user_id % 7 = 3) as vehicles,
    count(*) filter (where user_id % 7 <> 3 and user_id % 11 = 5) as alerts
  from (select distinct feed_id, message, user_id from parts) group by 1, 2"""

_NEEDS = list(CTES)


def _sql(body: str, upto: str) -> str:
    """``body`` after the definitions it may use, in order, up to ``upto``."""
    names = _NEEDS[: _NEEDS.index(upto) + 1]
    return "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in names) + "\n" + body


_FE_COLUMNS = """service_date_raw, route_id, stop_id, station_id, platform_direction, service_hour,
  hour_of_day, day_of_week, headways, round(mean_headway_minutes, 9) as mean_headway_minutes,
  round(min_headway_minutes, 9) as min_headway_minutes, round(max_headway_minutes, 9) as max_headway_minutes,
  round(rider_wait_minutes, 9) as rider_wait_minutes, round(even_wait_minutes, 9) as even_wait_minutes,
  round(excess_wait_minutes, 9) + 0.0 as excess_wait_minutes"""


_RAIN_COLUMNS = """case when why is null then 'fitted' else 'insufficient' end as status, why,
  case when why is null then round(slope, 6) + 0.0 end as minutes_per_mm,
  case when why is null then round(se, 6) end as std_error,
  case when why is null then round(slope - 1.959963984540054 * se, 6) + 0.0 end as ci_low,
  case when why is null then round(slope + 1.959963984540054 * se, 6) + 0.0 end as ci_high, n,
  case when why is null then wet end as wet_hours, case when why is null then round(r2, 6) end as r_squared,
  case when why is null then abs(slope) <= 1.959963984540054 * se end as straddles_zero"""

# The normal tail beyond u * sqrt(2), both sides: a sum of 200 terms near the middle, a continued fraction further out.
_U = "(abs(slope / se) / sqrt(2))"
_P_VALUE = f"""case when why is null then round(case
    when {_U} < 2 then 1 - 2 * {_U} * exp(-{_U} * {_U}) / sqrt(pi()) * list_reduce(
      list_prepend(1.0::double, list_transform(range(200, 0, -1), lambda k: k::double)),
      lambda a, k: 1 + a * 2 * {_U} * {_U} / (2 * k + 1))
    else exp(-{_U} * {_U}) / sqrt(pi()) / list_reduce(
      list_prepend({_U}, list_transform(range(200, 0, -1), lambda k: k::double)), lambda a, k: {_U} + k / 2 / a)
    end, 6) end as p_value"""


def _rain(min_headways: int, columns: str = _RAIN_COLUMNS) -> str:
    """Row by row: centred within the hour, leverage and residual of every row."""
    return _sql(f"""
, sample as (select route_id, hour_of_day, excess_wait_minutes as y, precip_mm as x, is_wet
  from fe join wx using (service_hour) where headways >= {min_headways}),
centred as (select *, x - avg(x) over c as dx, y - avg(y) over c as dy, count(*) over c as n_hour,
  y - avg(y) over (partition by route_id) as off from sample
  window c as (partition by route_id, hour_of_day)),
slopes as (select route_id, sum(dx * dx) as sxx, sum(dx * dy) / nullif(sum(dx * dx), 0) as slope
  from centred group by 1),
fits as (select route_id, any_value(slope) as slope,
  sqrt(sum(case when abs(dx) < 1e-12 then 0 else
    dx * dx * pow(dy - slope * dx, 2) / pow(1 - 1.0 / n_hour - dx * dx / sxx, 2) end)) / any_value(sxx) as se,
  1 - sum(pow(dy - slope * dx, 2)) / sum(off * off) as r2
  from centred join slopes using (route_id) group by 1),
support as (select route_id, count(*) as n, count(*) filter (where is_wet) as wet,
  count(distinct x) as kinds from sample group by 1),
judged as (select *, case when n < 60 then cast(n as varchar) || ' route-hours'
  when wet < 8 then cast(wet as varchar) || ' wet hours'
  when kinds < 2 then 'no variation in rainfall'
  when slope is null then 'no variation within hours' end as why from support left join fits using (route_id))
select route_id, {columns}
from judged""", "wx")


def _lines(rows: list[tuple[str, str, str, str]], upto: str = "dr") -> str:
    """A report of counts: table, kind, column, and the query that counts."""
    return _sql("\nunion all\n".join(
        f"select '{t}' as table_name, '{k}' as check_kind, '{c}' as column_name, ({q}) as violations"
        for t, k, c, q in rows
    ), upto)


_NAMES = {
    "stg_stop_time_updates": "stg", "int_last_sightings": "ls", "int_inferred_arrivals": "ia",
    "fct_arrivals": "fa", "fct_headways": "fh", "fct_excess_wait": "fe",
    "dim_stations": "ds", "dim_routes": "dr",
}


def _not_null(table: str, *columns: str, where: str = "true") -> list[tuple[str, str, str, str]]:
    return [
        (table, "not_null", c, f"select count(*) from {_NAMES[table]} where {c} is null and {where}")
        for c in columns
    ]


def _unique(table: str, *columns: str) -> tuple[str, str, str, str]:
    keys = ", ".join(columns)
    known = f"where {keys} is not null" if len(columns) == 1 else ""
    return (table, "unique", keys, f"""select count(*) from (select 1 from {_NAMES[table]} {known}
        group by {keys} having count(*) > 1)""")


def _missing_parent(table: str, column: str, parent: str) -> tuple[str, str, str, str]:
    return (table, "relationships", column, f"""select count(*) from {_NAMES[table]} c
        where c.{column} is not null and c.{column} not in (select {column} from {_NAMES[parent]})""")


def _one_sided(table: str, left: str, right: str) -> str:
    return f"""select '{table}' as table_name,
      (select count(*) from (select * from {left} except select * from {right})) as only_left,
      (select count(*) from (select * from {right} except select * from {left})) as only_right"""


_LANDING = """feed_id, observed_at, fetched_at, trip_id, route_id, start_date, direction, train_id, is_assigned,
  stop_id, stop_sequence, predicted_arrival, predicted_departure, scheduled_track, actual_track,
  schedule_relationship"""
_DIRECTORIES = f"""strftime({_local('observed_at')}, '%Y-%m-%d') as dt,
  cast(extract(hour from {_local('observed_at')}) as integer) as hour"""
_DATE = "strftime(make_timestamp(observed_at * 1000000), '%Y-%m-%d')"

_EQUAL = """select 'stg_stop_time_updates' as table_name, cast(0 as bigint) as only_left, cast(0 as bigint) as only_right
  union all select 'int_last_sightings', 0, 0 union all select 'fct_arrivals', 0, 0
  union all select 'fct_headways', 0, 0 union all select 'fct_excess_wait', 0, 0"""

_WATCHED = """
, seen as (select feed_id, trip_id, stop_id, count(*) as polls, min((observed_at, stop_sequence, stop_id)) as first
  from landing where predicted_arrival is not null group by 1, 2, 3),
best as (select feed_id, trip_id from seen group by 1, 2
  qualify row_number() over (partition by feed_id order by count(*) desc, sum(polls) desc, trip_id) = 1),
watched as (select feed_id, trip_id, stop_id, position from (select *, row_number() over (
    partition by feed_id, trip_id order by first) as position from seen join best using (feed_id, trip_id))
  where position <= 6)"""


def _minutes(epoch: str) -> str:
    return f"strftime({_local(epoch)}, '%M:%S')"


def _fetched_late() -> str:
    return f"""select feed_id, observed_at, fetched_at + (stop_sequence - 2) * 40 as fetched_at,
      fetched_at + (stop_sequence - 2) * 40 - observed_at as feed_lag_seconds from landing
      where fetched_at + (stop_sequence - 2) * 40 - observed_at > 600
         or fetched_at + (stop_sequence - 2) * 40 - observed_at < -60"""


def _sitting_sightings(name: str, where: str) -> str:
    """Last sightings as a warehouse would have them that landed only some rows."""
    return f"""{name}_stg as (select * from stg where {where}),
{name}_mark as (select feed_id, max(observed_at) as observed_through from {name}_stg group by 1),
{name} as (with seen as (select *, row_number() over (partition by service_date_raw, trip_id, stop_id
    order by observed_at desc, feed_id) as recency,
    count(*) over (partition by service_date_raw, trip_id, stop_id) as observations_of_pair
  from {name}_stg where predicted_arrival is not null and schedule_relationship = 'SCHEDULED')
  select service_date_raw, seen.feed_id, route_id, trip_id, train_id, stop_id, station_id,
    platform_direction, direction, predicted_arrival as last_predicted_arrival,
    observed_at as last_seen_at, predicted_arrival - observed_at as lead_seconds,
    observations_of_pair, scheduled_track, actual_track, observed_at < observed_through as has_vanished
  from seen join {name}_mark using (feed_id) where recency = 1)"""


def oracle() -> dict[str, str]:
    stg = _sql("select * from stg", "stg")
    ls = _sql("select * from ls", "ls")
    fe = _sql(f"select {_FE_COLUMNS} from fe", "fe")
    inputs = """select trip_id as text from landing union select stop_id from landing
      union select unnest([stop_id, stop_name, cast(lat as varchar), cast(lon as varchar), location_type,
        parent_station]) from stops
      union select unnest([route_id, route_short_name, route_long_name, route_desc, route_color,
        route_text_color]) from routes"""
    moved = "(observed_at + d * 86400)"
    local = _local("epoch")
    minutes = "(try_cast(split_part(text, '_', 1) as integer) / 100.0)"
    return {
        "identifier_functions": _sql(f""", inputs as ({inputs})
select text, {_STATION.format('text')} as station_id, {_SIDE.format('text')} as platform_direction,
  round({minutes}, 9) as origin_minutes,
  lpad(cast(cast(floor({minutes} / 60) as bigint) as varchar), 2, '0') || ':' ||
    lpad(cast(cast(floor({minutes} - 60 * floor({minutes} / 60)) as bigint) as varchar), 2, '0') as origin,
  '#' || nullif(text, '') as colour,
  {_DIRECTION.format('length(text) % 6')} as direction, {_RELATION.format('length(text) % 6')} as relationship,
  coalesce(nullif(text, ''), '1') as track, nullif(text, '') as text_or_null,
  nullif(length(text) % 6, 0) as code_or_null, coalesce(length(text) % 6, 0) as code_or_zero,
  round(try_cast(text as double), 9) as number from inputs""", "routes"),
        "clock_functions": _sql(f""", inputs as (select distinct {moved} as epoch,
    fetched_at + d * 86400 as later from landing, (select unnest([0, 60, 300]) as d))
select epoch, later, epoch as round_trip, later - epoch as seconds, epoch - 10800 as three_hours_before,
  epoch + 120 as two_minutes_after, {_text(local)} as local,
  {_text(f"date_trunc('hour', {local})")} as hour_start, extract(hour from {local}) as hour_of_day,
  extract(dayofweek from {local}) as day_of_week, strftime({local}, '%Y-%m-%d') as dt,
  strftime({local}, '%H') as hour, {_clock('epoch')} as clock from inputs""", "landing"),
        "stage_dedup": stg,
        "feed_watermark": _sql("select * from watermark", "watermark"),
        "last_sightings": ls,
        "inferred_arrivals": _sql("select * from ia", "ia"),
        "fct_arrivals": _sql("select * from fa", "fa"),
        "fct_headways": _sql("select * replace (round(headway_minutes, 9) as headway_minutes) from fh", "fh"),
        "fct_excess_wait": fe,
        "dim_stations": _sql("select * from ds", "ds"),
        "dim_routes": _sql("select * from dr", "dr"),
        "top_routes": _sql("""select route_id, count(*) as arrivals from fa group by 1
  order by 2 desc, 1 limit 6""", "fa"),
        "worst_excess_wait": _sql("""select service_date_raw, route_id, stop_id, service_hour,
    coalesce(station_name, '(unpublished)') as station_name, headways,
    round(mean_headway_minutes, 9) as mean_headway_minutes, round(excess_wait_minutes, 9) as excess_wait_minutes
  from fe left join ds using (station_id) where headways >= 3
  order by round(fe.excess_wait_minutes, 9) desc, 1, 2, 3, 4 limit 5""", "ds"),
        "observation_span": _sql("""select min(observed_at) as observed_from, max(observed_at) as observed_to,
    count(distinct feed_id) as feeds, round((max(observed_at) - min(observed_at)) / 60.0, 9) as minutes
  from stg""", "stg"),
        "table_counts": _sql(" union all ".join(
            f"select '{table}' as table_name, count(*) as row_count from {name}"
            for table, name in _NAMES.items()), "dr"),
        "unpublished_stations": _sql(
            "select count(*) as stations from ds where not is_published", "ds"),
        "sensitivity_sweep": _sql(
            "select * replace (round(excess_wait, 9) as excess_wait) from sweep", "sweep"),
        "sensitivity_swing": _sql("""select round(max(excess_wait) filter (where grace = 120), 9) as baseline,
    round((max(excess_wait) - min(excess_wait)) / max(excess_wait) filter (where grace = 120), 9) as swing
  from sweep""", "sweep"),
        "weather_rows": _sql("select * from wx", "wx"),
        "weather_summary": _sql("""select count(*) as hours, count(*) filter (where is_wet) as wet_hours,
    round(count(*) filter (where is_wet) / greatest(count(*), 1), 9) as wet_share,
    round(sum(precip_mm), 9) as total_mm from wx""", "wx"),
        "weather_file": _sql("""select count(*) as hours, count(*) filter (where is_wet) as wet_hours,
    round(count(*) filter (where is_wet) / greatest(count(*), 1), 9) as wet_share,
    round(sum(precip_mm), 9) as total_mm from wx""", "wx"),
        "rain_effect": _rain(1),
        "rain_effect_min3": _rain(3),
        "rain_p_values": _rain(1, _P_VALUE),
        "dq_unique": _lines([
            _unique("stg_stop_time_updates", "feed_id", "observed_at", "trip_id", "stop_id"),
            _unique("int_last_sightings", "service_date_raw", "trip_id", "stop_id"),
            _unique("int_inferred_arrivals", "service_date_raw", "trip_id", "stop_id"),
            _unique("fct_arrivals", "service_date_raw", "trip_id", "stop_id"),
            _unique("fct_headways", "service_date_raw", "route_id", "stop_id", "inferred_arrival"),
            _unique("fct_excess_wait", "service_date_raw", "route_id", "stop_id", "service_hour"),
            _unique("dim_stations", "station_id"), _unique("dim_routes", "route_id"),
        ]),
        "dq_not_null": _lines(
            _not_null("stg_stop_time_updates", "feed_id", "trip_id", "stop_id", "station_id",
                      "service_date_raw", "observed_at", "fetched_at")
            + _not_null("int_last_sightings", "service_date_raw", "feed_id", "trip_id", "stop_id",
                        "last_predicted_arrival", "last_seen_at", "lead_seconds",
                        "observations_of_pair", "has_vanished")
            + _not_null("int_inferred_arrivals", "inferred_arrival", "last_seen_at", "lead_seconds",
                        "observations_of_pair")
            + _not_null("fct_arrivals", "route_id", "trip_id", "stop_id", "station_id", "inferred_arrival")
            + _not_null("fct_headways", "previous_arrival", "headway_minutes")
            + _not_null("fct_excess_wait", "headways", "mean_headway_minutes", "excess_wait_minutes")
            + _not_null("dim_stations", "station_id", "is_published")
            + _not_null("dim_stations", "station_name", "latitude", "longitude", where="is_published")
            + _not_null("dim_routes", "route_id", "route_long_name")
        ),
        "dq_between": _lines([
            ("int_inferred_arrivals", "between", "lead_seconds",
             "select count(*) from ia where lead_seconds not between -86400 and 120"),
            ("fct_headways", "between", "headway_minutes",
             "select count(*) from fh where headway_minutes not between 0.5 and 60"),
        ]),
        "dq_accepted_values": _lines([
            ("stg_stop_time_updates", "accepted_values", "feed_id", """select count(*) from stg
               where feed_id not in ('numbered', 'ace', 'bdfm', 'g', 'jz', 'nqrw', 'l', 'sir')"""),
            ("stg_stop_time_updates", "accepted_values", "platform_direction",
             "select count(*) from stg where platform_direction not in ('N', 'S')"),
            ("stg_stop_time_updates", "accepted_values", "schedule_relationship", """select count(*) from stg
               where schedule_relationship not in ('SCHEDULED', 'SKIPPED', 'NO_DATA', 'UNSCHEDULED')"""),
            ("fct_arrivals", "accepted_values", "hour_of_day",
             "select count(*) from fa where hour_of_day not between 0 and 23"),
        ]),
        "dq_relationships": _lines([
            _missing_parent("fct_arrivals", "route_id", "dim_routes"),
            _missing_parent("fct_arrivals", "station_id", "dim_stations"),
            _missing_parent("fct_headways", "station_id", "dim_stations"),
            _missing_parent("fct_excess_wait", "route_id", "dim_routes"),
        ]),
        "dq_vanish": _lines([("fct_arrivals", "observed_to_vanish", "last_seen_at",
            "select count(*) from fa join watermark using (feed_id) where last_seen_at >= observed_through")]),
        "dq_grace": _lines([("fct_arrivals", "within_grace", "lead_seconds",
            "select count(*) from fa where lead_seconds > 120")]),
        "dq_non_negative": _lines([("fct_excess_wait", "non_negative", "excess_wait_minutes",
            "select count(*) from fe where excess_wait_minutes < -1e-9")]),
        "dq_feed_lag": _lines([("stg_stop_time_updates", "feed_lag", "feed_lag_seconds",
            "select count(*) from stg where feed_lag_seconds > 600 or feed_lag_seconds < -60")]),
        "dq_repeated_observations": _sql("""select feed_id, observed_at, trip_id, stop_id, count(*) as records
  from landing group by 1, 2, 3, 4 having count(*) > 1""", "landing"),
        "dq_orphans": _sql("""select station_id, count(*) as records from fa
  where station_id not in (select station_id from published) group by 1""", "published"),
        "dq_grace_changed": _sql("""select trip_id, stop_id, last_seen_at, inferred_arrival, lead_seconds
  from fa240 where lead_seconds > 120""", "fa240"),
        "dq_pending": _sql("""select ls.feed_id, trip_id, stop_id, last_seen_at, observed_through
  from ls join watermark using (feed_id) where last_seen_at >= observed_through""", "ls"),
        "feed_freshness": _sql(_fetched_late(), "landing"),
        "touched_pairs": _sql(f""", {_sitting_sightings('held', f'observed_at < {S1}')},
previous as (select feed_id, max(last_seen_at) as seen_through from held group by 1)
select distinct service_date_raw, trip_id, stop_id from stg left join previous using (feed_id)
where predicted_arrival is not null and schedule_relationship = 'SCHEDULED'
  and (seen_through is null or observed_at >= seen_through - 10800)""", "ls"),
        "upsert_rows": _sql(f""", {_sitting_sightings('held', f'observed_at < {S1}')},
{_sitting_sightings('incoming', f'observed_at >= {S1}')}
select * from incoming union all select * from held where not exists (select 1 from incoming
  where incoming.service_date_raw is not distinct from held.service_date_raw
    and incoming.trip_id is not distinct from held.trip_id
    and incoming.stop_id is not distinct from held.stop_id)""", "ls"),
        "incremental_stage": stg,
        "incremental_sightings": ls,
        "incremental_excess_wait": fe,
        "incremental_diff": _EQUAL,
        "stream_last_sightings": ls,
        "stream_backlog_in_batches": ls,
        "repeated_batch": ls,
        "incremental_dim_stations": _sql("select * from ds", "ds"),
        "incremental_dim_routes": _sql("select * from dr", "dr"),
        "stream_dimensions": _sql("select * from ds", "ds"),
        "late_feed_sightings": ls,
        "stream_snapshots": _sql(_flat("kept"), "kept"),
        "incremental_fact_dates": _sql(" union all ".join(
            f"select '{name}' as table_name, service_date_raw, count(*) as row_count from {fact} group by 2"
            for name, fact in (("fct_arrivals", "fa"), ("fct_headways", "fh"), ("fct_excess_wait", "fe"))
        ), "fe"),
        "too_late_observations": _sql(f"select * from stg where observed_at < {S1} or observed_at >= {S2}", "stg"),
        "warehouse_diff": _sql(" union all ".join([
            _one_sided("int_inferred_arrivals", "ia", "ia240"), _one_sided("fct_arrivals", "fa", "fa240"),
            _one_sided("fct_headways", "fh", "fh240"),
            _one_sided("fct_excess_wait", f"(select {_FE_COLUMNS} from fe)", f"(select {_FE_COLUMNS} from fe240)"),
        ]), "fe240"),
        "flatten_snapshots": _sql(_flat("fetches"), "kept"),
        "snapshots_to_landing": _sql(_flat("kept"), "kept"),
        "suppress_repeats": _sql("""select feed_id, header as observed_at, fetched_at, entities
  from kept join entities using (feed_id, message)""", "entities"),
        "snapshot_profile": _sql(f"""select f.feed_id, header as observed_at,
    cast(floor(fetched_at) as bigint) as fetched_at, {_clock('header')} as generated,
    cast(floor(fetched_at) as bigint) - header as age_seconds, entities, trip_updates, vehicles, alerts,
    case when user_id % 29 = 0 then '' else raw_trip end as trip_id,
    case when user_id is not null then f.feed_id end as route_id,
    case when user_id % 13 <> 0 then case when user_id % 17 = 0 then ''
      else 'train-' || cast(user_id as varchar) end end as train_id,
    case when user_id is not null then coalesce(case when user_id % 13 <> 0 then
      {_DIRECTION.format('user_id % 6')} end, '?') end as direction,
    case when user_id % 29 <> 0 then
      lpad(cast(((user_id * 137) % 144000) // 6000 as varchar), 2, '0') || ':' ||
      lpad(cast((((user_id * 137) % 144000) % 6000) // 100 as varchar), 2, '0') end as origin,
    stops as stops_remaining, next_stops
  from fetches f join entities using (feed_id, message) left join longest using (feed_id, message)""", "entities"),
        "prediction_trace": _sql(f""", newest as (select feed_id, max(observed_at) as newest from landing group by 1),
seen as (select feed_id, trip_id, stop_id, count(*) as polls, max((observed_at, predicted_arrival)) as last
  from landing where predicted_arrival is not null group by 1, 2, 3),
apart as (select *, last[1] as last_seen_at, last[2] as predicted_arrival from seen)
select feed_id, trip_id, stop_id, polls, predicted_arrival, last_seen_at,
  {_clock('predicted_arrival')} as arrival_clock, {_clock('last_seen_at')} as seen_clock,
  case when last_seen_at < newest then 'passed' else 'still ahead' end as state
from apart join newest using (feed_id)""", "landing"),
        "trace_matrix": _sql(f"""{_WATCHED}
select l.feed_id, l.trip_id, observed_at, {_minutes('observed_at')} as feed_time, """ + ", ".join(
    f"{_minutes(f'max(predicted_arrival) filter (where position = {i})')} as stop_{i}" for i in range(1, 7)
) + """
from landing l join watched using (feed_id, trip_id, stop_id) where predicted_arrival is not null
group by 1, 2, 3""", "landing"),
        "landing_roundtrip": _sql(f"select {_LANDING}, {_DIRECTORIES} from landing", "landing"),
        "landed_since": _sql(
            f"select {_LANDING}, {_DIRECTORIES} from landing where observed_at >= {S2}", "landing"),
        "day_replace": _sql(f"""select {_DATE} as observed_date, count(*) as row_count,
    cast(sum(fetched_at - observed_at) as bigint) as lag from (
      select observed_at, fetched_at from landing
        where {_DATE} not in (select {_DATE} from stg where observed_at >= {S2})
      union all select observed_at, fetched_at from stg where observed_at >= {S2})
  group by 1""", "stg"),
        "history_range": _sql(f"""select {_LANDING}, {_DATE} as observed_date from landing
  where {_DATE} between strftime(make_timestamp({S1}000000), '%Y-%m-%d')
    and strftime(make_timestamp({S2}000000), '%Y-%m-%d')""", "landing"),
        "history_one_day": _sql(f"""select {_LANDING}, {_DATE} as observed_date from landing
  where {_DATE} = strftime(make_timestamp({S2}000000), '%Y-%m-%d')""", "landing"),
        "reference_csv": _sql("""select route_id, route_short_name, route_long_name, route_desc,
  coalesce(route_color, '') as route_color from routes""", "routes"),
        "reference_stops": _sql("""select stop_id, stop_name, cast(lat as varchar) as stop_lat,
  cast(lon as varchar) as stop_lon, location_type, parent_station from stops""", "stops"),
    }

"""Independently written SQL for every answer, over the same raw records.

The raw views share their expressions with the Spark side, since they only shape
data. Cleaning, aggregation and all answers are written here a second time, in
SQL and mostly in the straightforward form, not in the form the Spark jobs use.
"""

from __future__ import annotations

import re

from lapwright.sources.racing_views import SOURCE_SQL, VIEWS

AS_OF = "date '2024-04-04'"
YEAR = 2024
RACE = 0
DRIVERS = "1, 4, 7"


def mean(x: str) -> str:
    return f"(cast(sum(cast({x} as decimal(28,10))) as double) / nullif(count({x}), 0))"


def spread(x: str) -> str:
    """Sample standard deviation from exact sums; through text, since a large decimal is not cast to the nearest double."""
    total, squares = (f"cast(cast(sum(cast({v} as decimal(28,10))) as varchar) as double)" for v in (x, f"{x} * {x}"))
    n = f"cast(count({x}) as double)"
    return f"case when count({x}) > 1 then sqrt(greatest(({squares} - {total} * {total} / {n}) / ({n} - 1), 0)) end"


def rnd(x: str, n: int) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {n}) as double)"


def _raw(name: str) -> str:
    view = VIEWS[name]
    cols = ", ".join(f'{text} as "{col}"' for col, text in view.columns.items())
    where = f" where {view.where}" if view.where else ""
    return f"select {cols} from {SOURCE_SQL[view.source]}{where}"


CTE: dict[str, str] = {f"raw_{n}": _raw(n) for n in VIEWS}

CTE["raw_stints"] = """
select session_key, driver_number, n as stint_number, 20 * (n - 1) + 1 as lap_start, 20 * n as lap_end,
  case (n + driver_number) % 3 when 0 then 'SOFT' when 1 then 'MEDIUM' else 'HARD' end as compound,
  cast((session_key + n) % 4 as int) as tyre_age_at_start
from (select distinct session_key, driver_number from raw_laps), (values (1), (2), (3)) as t(n)"""
CTE["raw_all_dirty_meetings"] = "select * from raw_dirty_meetings union all select * from raw_keyless_meetings"


def _silver(raw: str, columns: str, key: str = "", where: str = "true", prefer: str = "") -> str:
    """Typed columns, first row per key (one that passes the rule if there is one) with NULL last, then the rule."""
    typed, others = [], []
    present = {"raw_stints": "session_key driver_number stint_number lap_start lap_end compound tyre_age_at_start",
               "raw_all_dirty_meetings": " ".join(VIEWS["dirty_meetings"].columns),
               "raw_session_result": "session_key driver_number position",
               "raw_starting_grid": "session_key driver_number position"}
    have = present.get(raw) or " ".join(VIEWS[raw[4:]].columns)
    for part in columns.split(","):
        name, kind = part.split()
        value = f'"{name}"' if name in have.split() else "null"
        typed.append(f'try_cast({value} as {kind}) as "{name}"')
        if name not in key.replace(" ", "").split(","):
            others.append(f'"{name}" asc nulls last')
    inner = f"select {', '.join(typed)} from {raw}"
    if not key:
        return f"select * from ({inner}) where {where}"
    return (
        f"select * exclude (nth) from (select *, row_number() over (partition by {key} order by "
        f"coalesce(({prefer or where}), false) desc, {', '.join(others)}) "
        f"as nth from ({inner})) where nth = 1 and ({where})"
    )


MEETING = (
    "meeting_key int, meeting_name varchar, meeting_official_name varchar, location varchar, country_name varchar, "
    "country_code varchar, circuit_short_name varchar, circuit_key int, date_start timestamp, year int, "
    "gmt_offset varchar"
)
LAP = (
    "session_key int, meeting_key int, driver_number int, lap_number int, date_start timestamp, lap_duration double, "
    "is_pit_out_lap boolean, duration_sector_1 double, duration_sector_2 double, duration_sector_3 double, "
    "i1_speed int, i2_speed int, st_speed int, segments_sector_1 varchar, segments_sector_2 varchar, "
    "segments_sector_3 varchar"
)
MEETING_OK = "meeting_key is not null and year >= 2018 and year <= 2030"
LAP_OK = "lap_number is not null and lap_number > 0 and (lap_duration is null or lap_duration > 0)"
LAP_KEY = "session_key, driver_number, lap_number"

CTE.update(
    silver_meetings=_silver("raw_meetings", MEETING, "meeting_key", MEETING_OK),
    clean_dirty_meetings=_silver("raw_all_dirty_meetings", MEETING, "meeting_key", MEETING_OK),
    unruled_dirty_meetings=_silver("raw_all_dirty_meetings", MEETING, "meeting_key", prefer=MEETING_OK),
    silver_sessions=_silver(
        "raw_sessions",
        "session_key int, session_name varchar, session_type varchar, meeting_key int, location varchar, "
        "country_name varchar, country_code varchar, circuit_short_name varchar, circuit_key int, "
        "date_start timestamp, date_end timestamp, gmt_offset varchar, year int",
        "session_key",
        "session_key is not null and meeting_key is not null",
    ),
    silver_drivers=_silver(
        "raw_drivers",
        "driver_number int, broadcast_name varchar, full_name varchar, first_name varchar, last_name varchar, "
        "name_acronym varchar, team_name varchar, team_colour varchar, country_code varchar, session_key int, "
        "meeting_key int, headshot_url varchar",
        "driver_number, session_key",
        "driver_number is not null",
    ),
    silver_laps=_silver("raw_laps", LAP, LAP_KEY, LAP_OK),
    clean_dirty_laps=_silver("raw_dirty_laps", LAP, LAP_KEY, LAP_OK),
    unruled_dirty_laps=_silver("raw_dirty_laps", LAP, LAP_KEY, prefer=LAP_OK),
    silver_pit=_silver(
        "raw_pit",
        "session_key int, meeting_key int, driver_number int, date timestamp, lap_number int, pit_duration double",
        "session_key, driver_number, date",
    ),
    silver_stints=_silver(
        "raw_stints",
        "session_key int, meeting_key int, driver_number int, stint_number int, lap_start int, lap_end int, "
        "compound varchar, tyre_age_at_start int",
        "session_key, driver_number, stint_number",
    ),
    silver_car_data=_silver(
        "raw_car_data",
        "session_key int, meeting_key int, driver_number int, date timestamp, speed int, rpm int, n_gear int, "
        "throttle int, brake int, drs int",
    ),
    silver_position=_silver(
        "raw_position", "session_key int, meeting_key int, driver_number int, date timestamp, position int"
    ),
    silver_weather=_silver(
        "raw_weather",
        "session_key int, meeting_key int, date timestamp, air_temperature double, track_temperature double, "
        "humidity int, pressure double, rainfall int, wind_speed double, wind_direction int",
        "session_key, date",
    ),
    silver_race_control=_silver(
        "raw_race_control",
        "session_key int, meeting_key int, date timestamp, category varchar, flag varchar, lap_number int, "
        "message varchar, scope varchar, sector int, driver_number int",
    ),
    silver_team_radio=_silver(
        "raw_team_radio",
        "session_key int, meeting_key int, driver_number int, date timestamp, recording_url varchar",
    ),
    silver_intervals=_silver(
        "raw_intervals",
        "session_key int, meeting_key int, driver_number int, date timestamp, gap_to_leader double, interval double",
    ),
    silver_overtakes=_silver(
        "raw_overtakes",
        "session_key int, meeting_key int, overtaking_driver_number int, overtaken_driver_number int, "
        "date timestamp, position int",
    ),
    raw_session_result="""
select session_key, driver_number, row_number() over (partition by session_key order by n desc, best, driver_number)
  as position
from (select session_key, driver_number, count(*) as n, min(lap_duration) as best
      from silver_laps where lap_duration is not null group by all)""",
    raw_starting_grid="""
select session_key, driver_number, row_number() over (partition by session_key order by best, driver_number) as position
from (select session_key, driver_number, min(lap_duration) as best
      from silver_laps where lap_duration is not null  group by all)""",
    silver_session_result=_silver(
        "raw_session_result", "session_key int, meeting_key int, driver_number int, position int"
    ),
    silver_starting_grid=_silver(
        "raw_starting_grid", "session_key int, meeting_key int, driver_number int, position int"
    ),
)

CTE.update(
    gold_driver_performance=f"""
select l.session_key, l.driver_number, d.full_name, d.team_name, total_laps, fastest_lap_time, avg_lap_time,
  lap_time_consistency, max_speed_i1, max_speed_i2, max_speed_st, coalesce(pit_stop_count, 0) as pit_stop_count,
  avg_pit_duration, fastest_pit_stop
from (
  select session_key, driver_number, count(*) as total_laps, min(lap_duration) as fastest_lap_time,
    {mean('lap_duration')} as avg_lap_time, {spread('lap_duration')} as lap_time_consistency,
    max(i1_speed) as max_speed_i1, max(i2_speed) as max_speed_i2, max(st_speed) as max_speed_st
  from silver_laps where is_pit_out_lap = false and lap_duration is not null group by session_key, driver_number) l
left join silver_drivers d on d.session_key = l.session_key and d.driver_number = l.driver_number
left join (
  select session_key, driver_number, count(*) as pit_stop_count, {mean('pit_duration')} as avg_pit_duration,
    min(pit_duration) as fastest_pit_stop
  from silver_pit group by session_key, driver_number) p
  on p.session_key = l.session_key and p.driver_number = l.driver_number""",
    gold_race_summary=f"""
select s.session_key, s.meeting_key, s.session_name, s.location, s.date_start, s.date_end, total_laps, fastest_lap,
  total_pit_stops, coalesce(yellow_flags, 0) as yellow_flags, coalesce(red_flags, 0) as red_flags,
  coalesce(safety_cars, 0) as safety_cars, avg_air_temp, avg_track_temp, rainfall_detected
from silver_sessions s
left join (
  select session_key, max(lap_number) as total_laps, min(lap_duration) as fastest_lap,
    count(case when is_pit_out_lap then 1 end) as total_pit_stops
  from silver_laps where lap_duration is not null group by session_key) l on l.session_key = s.session_key
left join (
  select session_key, count(case when flag = 'YELLOW' then 1 end) as yellow_flags,
    count(case when flag = 'RED' then 1 end) as red_flags,
    count(case when category = 'SafetyCar' then 1 end) as safety_cars
  from silver_race_control group by session_key) r on r.session_key = s.session_key
left join (
  select session_key, {mean('air_temperature')} as avg_air_temp, {mean('track_temperature')} as avg_track_temp,
    max(rainfall) as rainfall_detected
  from silver_weather group by session_key) w on w.session_key = s.session_key
where s.session_type in ('Race', 'Sprint')""",
    gold_team_performance=f"""
select session_key, team_name, count(driver_number) as drivers_count, min(fastest_lap_time) as team_fastest_lap,
  {mean('avg_lap_time')} as team_avg_lap_time, cast(sum(pit_stop_count) as bigint) as total_team_pit_stops,
  {mean('avg_pit_duration')} as team_avg_pit_duration, max(max_speed_st) as team_max_speed
from gold_driver_performance group by session_key, team_name""",
    gold_tyre_strategy=f"""
select t.session_key, t.driver_number, d.full_name, d.team_name, t.stint_number, t.compound, t.stint_laps,
  t.tyre_age_at_start, avg_lap_time_on_compound, best_lap_time_on_compound
from (
  select s.session_key, s.driver_number, s.stint_number, s.compound, s.lap_end - s.lap_start + 1 as stint_laps,
    s.tyre_age_at_start, {mean('l.lap_duration')} as avg_lap_time_on_compound,
    min(l.lap_duration) as best_lap_time_on_compound
  from silver_stints s join silver_laps l on l.session_key = s.session_key and l.driver_number = s.driver_number
    and l.lap_number >= s.lap_start and l.lap_number <= s.lap_end
  group by all) t
left join silver_drivers d on d.session_key = t.session_key and d.driver_number = t.driver_number""",
    gold_fastest_laps="""
select f.session_key, s.session_name, s.location, s.date_start,
  cast(row_number() over (partition by f.session_key order by f.lap_duration, f.driver_number) as int) as rank,
  f.driver_number, d.full_name, d.team_name, f.lap_number, f.lap_duration as fastest_lap_time
from (
  select *, row_number() over (partition by session_key, driver_number order by lap_duration, lap_number) as nth
  from silver_laps where lap_duration is not null and is_pit_out_lap = false) f
left join silver_drivers d on d.session_key = f.session_key and d.driver_number = f.driver_number
left join silver_sessions s on s.session_key = f.session_key
where f.nth = 1""",
    gold_overtakes_analysis="""
select o.session_key, o.overtaking_driver_number as driver_number, d.full_name, d.team_name, o.overtakes_made
from (select session_key, meeting_key, overtaking_driver_number, count(*) as overtakes_made
      from silver_overtakes group by all) o
left join silver_drivers d on d.session_key = o.session_key and d.meeting_key = o.meeting_key
  and d.driver_number = o.overtaking_driver_number""",
)

RECENT = f"s.date_start >= {AS_OF} - interval '90' day"
RACES = "s.session_type in ('Race', 'Sprint')"
NAMED = "join silver_drivers d on d.session_key = {0}.session_key and d.driver_number = {0}.driver_number"

Q: dict[str, str] = {}

# Gold and silver tables as they stand.
for _name in (
    "driver_performance race_summary team_performance tyre_strategy fastest_laps overtakes_analysis"
).split():
    Q[f"gold_{_name}"] = f"select * from gold_{_name}"
for _name in (
    "sessions drivers pit stints car_data position weather race_control team_radio intervals overtakes "
    "session_result starting_grid"
).split():
    Q[f"silver_{_name}"] = f"select * from silver_{_name}"
Q["silver_meetings"] = "select * from clean_dirty_meetings"
Q["silver_laps"] = "select * from clean_dirty_laps"

# Raw tables after landing as text lines and streaming back: times are text there.
def _iso(column: str, suffix: str = "") -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'){suffix} as {column}"


for _name, _view in VIEWS.items():
    if "dirty" in _name or "keyless" in _name:
        continue
    _cols = []
    for _c in _view.columns:
        if _c == "date" or (_c == "date_start" and _name == "laps"):
            _cols.append(_iso(_c))
        elif _c in ("date_start", "date_end"):
            _cols.append(_iso(_c, " || 'Z'"))
        else:
            _cols.append(f'"{_c}"')
    if _name in ("weather", "race_control"):
        _cols.append("cast(null as int) as meeting_key")  # hinted, but in no record
    Q[f"bronze_{_name}"] = f"select {', '.join(_cols)} from raw_{_name}"
Q["bronze_stints"] = "select * from raw_stints"
Q["bronze_session_result"] = "select * from raw_session_result"
Q["bronze_starting_grid"] = "select * from raw_starting_grid"

# Dashboard.
Q["dash_recent_sessions"] = """
select s.session_name, s.location, s.country_name, s.date_start, s.session_type, m.meeting_name,
  count(distinct d.driver_number) as drivers_count
from silver_sessions s join silver_meetings m on m.meeting_key = s.meeting_key
left join silver_drivers d on d.session_key = s.session_key
group by all
order by date_start desc nulls last, session_name, location, country_name, session_type, meeting_name limit 20"""
Q["dash_fastest_laps"] = f"""
select s.rank, s.full_name as driver, s.team_name as team, s.session_name, s.location, s.lap_number,
  {rnd('s.fastest_lap_time', 3)} as lap_time_seconds, s.date_start
from gold_fastest_laps s where {RECENT} order by s.date_start desc, s.rank, s.session_key limit 50"""
Q["dash_driver_comparison"] = f"""
select s.location, s.session_name, g.full_name as driver, g.team_name as team, g.total_laps,
  {rnd('g.fastest_lap_time', 3)} as fastest_lap, {rnd('g.avg_lap_time', 3)} as avg_lap_time,
  {rnd('g.lap_time_consistency', 3)} as consistency_std, g.pit_stop_count,
  {rnd('g.avg_pit_duration', 2)} as avg_pit_duration, g.max_speed_st as max_speed_kmh
from gold_driver_performance g join silver_sessions s on s.session_key = g.session_key where {RACES} and {RECENT}"""
Q["dash_team_rankings"] = f"""
select s.location, s.session_name, g.team_name, {rnd('g.team_fastest_lap', 3)} as fastest_lap,
  {rnd('g.team_avg_lap_time', 3)} as avg_lap_time, g.total_team_pit_stops,
  {rnd('g.team_avg_pit_duration', 2)} as avg_pit_duration, g.team_max_speed
from gold_team_performance g join silver_sessions s on s.session_key = g.session_key where {RACES} and {RECENT}"""
Q["dash_tyre_strategy"] = f"""
select s.location, s.session_name, g.full_name as driver, g.team_name, g.stint_number, g.compound, g.stint_laps,
  g.tyre_age_at_start, {rnd('g.avg_lap_time_on_compound', 3)} as avg_lap_time,
  {rnd('g.best_lap_time_on_compound', 3)} as best_lap_time
from gold_tyre_strategy g join silver_sessions s on s.session_key = g.session_key where {RACES} and {RECENT}"""
Q["dash_weather_impact"] = f"""
select s.location, s.session_name, s.date_start, {rnd(mean('w.air_temperature'), 1)} as avg_air_temp_c,
  {rnd(mean('w.track_temperature'), 1)} as avg_track_temp_c, {rnd(mean('w.humidity'), 0)} as avg_humidity_pct,
  max(w.rainfall) as rain_detected, {rnd(mean('w.wind_speed'), 1)} as avg_wind_speed_ms,
  {rnd('min(l.lap_duration)', 3)} as fastest_lap_in_conditions
from silver_weather w join silver_sessions s on s.session_key = w.session_key
left join silver_laps l on l.session_key = w.session_key where {RECENT}
group by s.location, s.session_name, s.date_start"""
Q["dash_incidents"] = f"""
select s.location, s.session_name, r.date, r.category, r.flag, r.message, r.lap_number, d.full_name as driver_affected
from silver_race_control r join silver_sessions s on s.session_key = r.session_key
left join silver_drivers d on d.session_key = r.session_key and d.driver_number = r.driver_number
where {RECENT} and r.flag in ('YELLOW', 'RED', 'BLUE')
order by r.date desc nulls last, r.session_key nulls last, r.driver_number nulls last, r.category nulls last,
  r.flag nulls last, r.message nulls last, r.lap_number nulls last limit 100"""
Q["dash_pit_stops"] = f"""
select s.location, s.session_name, d.full_name as driver, d.team_name, p.lap_number,
  {rnd('p.pit_duration', 2)} as pit_duration_seconds, p.date as pit_time
from silver_pit p join silver_sessions s on s.session_key = p.session_key {NAMED.format('p')}
where {RACES} and {RECENT} and p.pit_duration is not null
order by p.pit_duration, p.date, p.session_key, p.driver_number limit 50"""
Q["dash_speed_trap"] = f"""
select s.location, s.session_name, d.full_name as driver, d.team_name, max(c.speed) as max_speed_kmh,
  max(c.rpm) as max_rpm, {mean('c.speed')} as avg_speed_kmh
from silver_car_data c join silver_sessions s on s.session_key = c.session_key {NAMED.format('c')}
where {RECENT} group by all
order by max_speed_kmh desc nulls last, s.location, s.session_name, driver, d.team_name limit 50"""
Q["dash_overtakes"] = f"""
select s.location, s.session_name, g.full_name as driver, g.team_name, g.overtakes_made
from gold_overtakes_analysis g join silver_sessions s on s.session_key = g.session_key where {RACES} and {RECENT}
order by g.overtakes_made desc, s.date_start desc, g.session_key, g.driver_number, g.full_name nulls last,
  g.team_name nulls last limit 30"""
Q["dash_race_summary"] = f"""
select session_name, location, date_start, total_laps, {rnd('fastest_lap', 3)} as fastest_lap_time, total_pit_stops,
  yellow_flags, red_flags, safety_cars, {rnd('avg_air_temp', 1)} as avg_air_temp_c,
  {rnd('avg_track_temp', 1)} as avg_track_temp_c, case when rainfall_detected > 0 then 'Yes' else 'No' end as rain
from gold_race_summary order by date_start desc, session_key limit 20"""
Q["dash_championship"] = f"""
select full_name as driver, team_name, count(distinct session_key) as races_entered,
  cast(sum(case position when 1 then 25 when 2 then 18 when 3 then 15 when 4 then 12 when 5 then 10 when 6 then 8
    when 7 then 6 when 8 then 4 when 9 then 2 when 10 then 1 else 0 end) as bigint) as total_points,
  count_if(position = 1) as wins, count_if(position <= 3) as podiums
from (
  select s.session_key, d.full_name, d.team_name, p.position
  from silver_sessions s join silver_drivers d on d.session_key = s.session_key
  join silver_position p on p.session_key = s.session_key and p.driver_number = d.driver_number
  where s.session_type = 'Race' and s.date_start >= {AS_OF} - interval '365' day
  qualify row_number() over (partition by s.session_key, d.driver_number order by p.date desc, p.position) = 1)
group by all"""

# Exploration.
Q["explore_counts"] = """
select 'bronze_meetings' as table_name, count(*) as records from raw_meetings
union all select 'bronze_sessions', count(*) from raw_sessions"""
Q["explore_session_types"] = """
select session_type, count(*) as "count", min(date_start) as first_session, max(date_start) as last_session
from silver_sessions group by session_type"""
Q["explore_driver_sessions"] = """
select full_name, name_acronym, team_name, country_code, count(distinct session_key) as sessions_count
from silver_drivers group by all"""
Q["explore_top_drivers"] = f"""
select full_name, team_name, {mean('fastest_lap_time')} as avg_fastest_lap, min(fastest_lap_time) as best_lap_ever,
  {mean('pit_stop_count')} as avg_pit_stops, max(max_speed_st) as top_speed, count(distinct session_key) as races
from gold_driver_performance group by full_name, team_name
order by avg_fastest_lap nulls first, full_name nulls last, team_name nulls last limit 15"""
Q["explore_driver_trend"] = """
select s.date_start, s.location, g.full_name, g.team_name, g.fastest_lap_time, g.pit_stop_count
from gold_driver_performance g join silver_sessions s on s.session_key = g.session_key where s.session_type = 'Race'"""
Q["explore_team_comparison"] = f"""
select team_name, {mean('team_fastest_lap')} as avg_fastest_lap, min(team_fastest_lap) as best_team_lap,
  {mean('team_avg_pit_duration')} as avg_pit_duration, {mean('total_team_pit_stops')} as avg_team_pit_stops,
  max(team_max_speed) as max_speed, count(distinct session_key) as races
from gold_team_performance group by team_name"""
Q["explore_race_summary"] = """
select session_name, location, date_start, total_laps, fastest_lap, total_pit_stops, yellow_flags, red_flags,
  safety_cars, avg_air_temp, avg_track_temp, case when rainfall_detected > 0 then 'Yes' else 'No' end as rain
from gold_race_summary"""
Q["explore_tyre_performance"] = f"""
select compound, count(*) as usage_count, {mean('avg_lap_time_on_compound')} as avg_lap_time,
  min(best_lap_time_on_compound) as best_lap_time, {mean('stint_laps')} as avg_stint_length
from gold_tyre_strategy where compound is not null group by compound"""
Q["explore_team_tyres"] = f"""
select team_name, compound, count(*) as times_used, {mean('avg_lap_time_on_compound')} as avg_performance,
  {mean('stint_laps')} as avg_stint_length
from gold_tyre_strategy where compound is not null group by team_name, compound"""
Q["explore_weather_bands"] = f"""
select case when avg_track_temp < 30 then 'Cold (<30°C)' when avg_track_temp <= 40 then 'Moderate (30-40°C)'
    when avg_track_temp <= 50 then 'Warm (40-50°C)' else 'Hot (>50°C)' end as track_temp_category,
  count(*) as races, {mean('fastest_lap')} as avg_fastest_lap, {mean('total_pit_stops')} as avg_pit_stops,
  {mean('safety_cars')} as avg_safety_cars
from gold_race_summary where avg_track_temp is not null group by 1"""
Q["explore_lap_distribution"] = f"""
select s.location, s.circuit_short_name, count(l.lap_number) as total_laps, min(l.lap_duration) as fastest_lap,
  {mean('l.lap_duration')} as avg_lap, quantile_cont(l.lap_duration, 0.5) as median_lap,
  {spread('l.lap_duration')} as lap_consistency
from silver_laps l join silver_sessions s on s.session_key = l.session_key
where l.lap_duration is not null and l.is_pit_out_lap = false and s.session_type = 'Race'
group by s.location, s.circuit_short_name"""
Q["explore_overtakes"] = """
select full_name, team_name, cast(sum(overtakes_made) as bigint) as total_overtakes,
  count(distinct session_key) as races,
  cast(round(cast(sum(overtakes_made) * 1.0 / count(distinct session_key) as decimal(28,10)), 2) as double)
    as overtakes_per_race
from gold_overtakes_analysis group by full_name, team_name having sum(overtakes_made) > 0"""
Q["explore_leaderboard"] = """
select rank, full_name, team_name, location, lap_number, fastest_lap_time, date_start
from gold_fastest_laps where rank <= 20"""
Q["explore_data_quality"] = """
select 'drivers' as table_name, count(*) as total_records, count(distinct driver_number) as unique_drivers,
  count_if(full_name is null) as missing_names from silver_drivers
union all
select 'laps', count(*), count(distinct session_key), count_if(lap_duration is null) from silver_laps
union all
select 'car_data', count(*), count(distinct driver_number), count_if(speed is null) from silver_car_data"""

# Season view.
LISTED = "select distinct session_key, session_name, location, date_start, session_type from silver_sessions"
DRIVEN = (
    "gold_driver_performance g join silver_sessions s on s.session_key = g.session_key "
    "join silver_drivers d on d.session_key = g.session_key and d.driver_number = g.driver_number"
)
STINTS = DRIVEN.replace("gold_driver_performance", "gold_tyre_strategy")
Q["app_sessions"] = f"{LISTED} where year = {YEAR}"
Q["app_race_sessions"] = f"{LISTED} where year = {YEAR} and session_type = 'Race'"
Q["app_race_list"] = f"{LISTED} where year = {YEAR} and session_type in ('Race', 'Sprint')"
Q["app_session_labels"] = f"""
select session_key, location || ' - ' || session_type || ' (' || strftime(date_start, '%Y-%m-%d %H:%M:%S') || ')'
  as label from silver_sessions where year = {YEAR}"""
Q["app_metrics"] = f"""
select count(distinct meeting_key) as total_races, count(distinct session_key) as total_sessions
from silver_sessions where year = {YEAR}"""
Q["app_driver_count"] = f"""
select count(distinct d.driver_number) as total_drivers
from silver_drivers d join silver_sessions s on s.session_key = d.session_key where s.year = {YEAR}"""
Q["app_recent_races"] = f"""
select s.session_name, s.location, s.country_name, s.date_start, s.session_type,
  count(distinct d.team_name) as teams_count,
  coalesce(string_agg(distinct d.team_name, ', ' order by d.team_name), '') as teams
from silver_sessions s left join silver_drivers d on d.session_key = s.session_key where s.year = {YEAR}
group by s.session_name, s.location, s.country_name, s.date_start, s.session_type
order by s.date_start desc, s.session_name, s.location, s.country_name, s.session_type limit 10"""
_FASTEST = """select f.full_name as driver, f.team_name, f.location, f.fastest_lap_time as lap_time
from gold_fastest_laps f {0} where f.rank <= 10 {1}
order by f.fastest_lap_time, f.session_key, f.driver_number limit 10"""
Q["app_fastest_laps"] = _FASTEST.format("", "")
Q["app_fastest_laps_of_year"] = _FASTEST.format(
    "join silver_sessions s on s.session_key = f.session_key", f"and s.year = {YEAR}"
)
Q["app_driver_list"] = f"""
select distinct d.full_name, d.driver_number from silver_drivers d
join silver_sessions s on s.session_key = d.session_key where s.year = {YEAR}"""
Q["app_driver_stats"] = f"""
select d.full_name as driver, d.team_name, count(distinct g.session_key) as sessions_count,
  {mean('g.fastest_lap_time')} as avg_fastest_lap, min(g.fastest_lap_time) as best_lap,
  {mean('g.pit_stop_count')} as avg_pit_stops, max(g.max_speed_st) as top_speed
from {DRIVEN} where g.driver_number in ({DRIVERS}) and s.year = {YEAR} group by d.full_name, d.team_name"""
Q["app_driver_cards"] = f"""
select driver, team_name, cast(sessions_count as varchar) as sessions,
  cast(cast(cast(avg_fastest_lap as decimal(28,10)) as decimal(28,3)) as varchar) || 's' as avg_best_lap,
  cast(cast(cast(best_lap as decimal(28,10)) as decimal(28,3)) as varchar) || 's' as fastest_lap,
  cast(cast(cast(avg_pit_stops as decimal(28,10)) as decimal(28,1)) as varchar) as avg_pit_stops,
  cast(top_speed as varchar) || ' km/h' as top_speed
from ({Q['app_driver_stats'].replace(f"g.driver_number in ({DRIVERS}) and ", "")})"""
Q["app_lap_progression"] = f"""
select d.full_name as driver, s.location, s.date_start, g.fastest_lap_time, g.avg_lap_time
from {DRIVEN} where g.driver_number in ({DRIVERS}) and s.year = {YEAR}"""
_TEAM_STATS = f"""
select d.team_name, count(distinct s.session_key) as race_count, {mean('g.fastest_lap_time')} as avg_fastest_lap,
  min(g.fastest_lap_time) as best_lap, {mean('g.max_speed_st')} as avg_max_speed, max(g.max_speed_st) as top_speed,
  {mean('g.pit_stop_count')} as avg_pit_stops
from {DRIVEN} where s.year = {YEAR} and s.session_type = 'Race' group by d.team_name"""
_TEAM_PITS = f"""
select d.team_name, {mean('p.pit_duration')} as avg_pit_duration, min(p.pit_duration) as fastest_pit_stop,
  count(*) as total_pit_stops
from silver_pit p join silver_sessions s on s.session_key = p.session_key {NAMED.format('p')}
where s.year = {YEAR} and s.session_type = 'Race' group by d.team_name"""
_MERGED = f"""
select a.*, b.avg_pit_duration, b.fastest_pit_stop, b.total_pit_stops
from ({_TEAM_STATS}) a left join ({_TEAM_PITS}) b on a.team_name is not distinct from b.team_name"""
Q["app_team_stats"] = _TEAM_STATS
Q["app_team_pits"] = _TEAM_PITS
Q["app_team_merged"] = _MERGED
Q["app_team_leaders"] = f"""
select count(*) as total_teams,
  arg_min(team_name, row(avg_fastest_lap, avg_fastest_lap, team_name)) filter (avg_fastest_lap is not null)
    as fastest_team,
  arg_min(team_name, row(avg_pit_duration, avg_fastest_lap, team_name)) filter (avg_pit_duration is not null)
    as fastest_pit_team
from ({_MERGED})"""


def _race(one: str, every: str, sql: str) -> None:
    """An answer for one race, and the same for all, with the key in front."""
    Q[one] = sql.format(key="", by="", where=f"where x.session_key = {RACE}")
    Q[every] = sql.format(key="x.session_key, ", by="x.session_key, ", where="")


_OVERVIEW = f"""
select {{key}}count(distinct x.driver_number) as total_drivers, {mean('x.fastest_lap_time')} as avg_fastest_lap,
  min(x.fastest_lap_time) as fastest_lap, max(x.max_speed_st) as top_speed, {mean('x.max_speed_st')} as avg_speed,
  cast(sum(x.pit_stop_count) as bigint) as total_pit_stops
from gold_driver_performance x {{where}}"""
Q["app_race_overview"] = _OVERVIEW.format(key="", where=f"where x.session_key = {RACE}")
Q["app_races_overview"] = _OVERVIEW.format(key="x.session_key, ", where="group by x.session_key")
Q["app_race_cards"] = f"""
select session_key, cast(total_drivers as varchar) as total_drivers,
  cast(cast(cast(fastest_lap as decimal(28,10)) as decimal(28,3)) as varchar) || 's' as fastest_lap,
  cast(cast(cast(avg_fastest_lap as decimal(28,10)) as decimal(28,3)) as varchar) || 's' as avg_lap_time,
  cast(top_speed as varchar) || ' km/h' as top_speed, cast(total_pit_stops as varchar) as total_pit_stops
from ({Q['app_races_overview']})"""
_race(
    "app_race_drivers",
    "app_races_drivers",
    'select {key}d.full_name as "Driver", d.team_name as "Team", x.fastest_lap_time as fastest_lap, x.avg_lap_time, '
    "x.max_speed_st as max_speed, x.pit_stop_count from gold_driver_performance x " + NAMED.format("x") + " {where}",
)
Q["app_race_drivers_top"] = f"""
select d.full_name as "Driver", d.team_name as "Team", x.fastest_lap_time as fastest_lap, x.avg_lap_time,
  x.max_speed_st as max_speed, x.pit_stop_count
from gold_driver_performance x {NAMED.format('x')} where x.session_key = {RACE}
order by x.fastest_lap_time, x.driver_number limit 10"""
_race(
    "app_race_pits",
    "app_races_pits",
    "select {key}d.full_name as driver, d.team_name, x.lap_number, x.pit_duration, x.date as pit_time "
    "from silver_pit x " + NAMED.format("x") + " {where}",
)
_PIT_MEANS = (
    f"select {{key}}d.full_name as driver, d.team_name, {mean('x.pit_duration')} as pit_duration from silver_pit x "
    + NAMED.format("x")
    + " where d.full_name is not null and d.team_name is not null {where} group by {key}d.full_name, d.team_name"
)
Q["app_race_pit_means"] = _PIT_MEANS.format(key="", where=f"and x.session_key = {RACE}")
Q["app_races_pit_means"] = _PIT_MEANS.format(key="x.session_key, ", where="")
_race(
    "app_positions",
    "app_positions_all",
    "select {key}d.full_name as driver, d.team_name, x.date, x.position from silver_position x "
    + NAMED.format("x")
    + " {where}",
)
Q["app_positions_spread"] = Q["app_positions_all"]
_race(
    "app_race_teams",
    "app_races_teams",
    f"select {{key}}d.team_name, count(distinct d.driver_number) as drivers, {mean('x.fastest_lap_time')} as avg_lap, "
    f"min(x.fastest_lap_time) as best_lap, {mean('x.max_speed_st')} as avg_speed, "
    "cast(sum(x.pit_stop_count) as bigint) as total_pits from gold_driver_performance x "
    + NAMED.format("x")
    + " {where} group by {by}d.team_name",
)
Q["app_team_list"] = f"""
select distinct d.team_name from silver_drivers d join silver_sessions s on s.session_key = d.session_key
where s.year = {YEAR} and s.session_type = 'Race'"""
USAGE = f"""{mean('g.avg_lap_time_on_compound')} as avg_lap_time, {mean('g.stint_laps')} as avg_stint_length,
  count(*) as usage_count"""
_BY_TEAM = f"""
select g.compound, d.team_name, {USAGE}
from {STINTS} where s.year = {YEAR} and s.session_type = 'Race' group by g.compound, d.team_name"""
_SUMMARY = f"""
select g.compound, {USAGE}, count(distinct d.team_name) as teams_used
from {STINTS} where s.year = {YEAR} and s.session_type = 'Race' group by g.compound"""
Q["app_tyres_by_team"] = _BY_TEAM
Q["app_tyres_of_teams"] = _BY_TEAM.replace("group by", "and d.team_name in ('Team 1', 'Team 3') group by")
Q["app_compound_summary"] = _SUMMARY
Q["app_compound_share"] = f"""
select compound, usage_count, usage_count / cast(sum(usage_count) over () as double) as usage_share
from ({_SUMMARY})"""
_QUARTILES = """min(avg_stint_length) as "min", quantile_cont(avg_stint_length, 0.25) as q1,
  quantile_cont(avg_stint_length, 0.5) as "median", quantile_cont(avg_stint_length, 0.75) as q3,
  max(avg_stint_length) as "max" """
Q["app_stint_quartiles"] = f"select compound, team_name, {_QUARTILES} from ({_BY_TEAM}) group by all"
Q["app_stint_quartiles_by_compound"] = f"select compound, {_QUARTILES} from ({_BY_TEAM}) group by all"
Q["app_usage_pivot"] = f"""
select team_name, {', '.join(
    f"cast(coalesce(sum(case when compound = '{c}' then usage_count end), 0) as bigint) as {c}"
    for c in ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"))}
from ({_BY_TEAM}) where team_name is not null group by team_name"""


def _audit(names: str) -> str:
    return " union all ".join(
        f"select '{n}' as table_name, true as \"exists\", count(*) as records from {n}" for n in names.split()
    )


Q["app_table_audit"] = _audit("silver_sessions silver_drivers gold_driver_performance gold_fastest_laps")
Q["expected_tables_audit"] = _audit(
    "silver_meetings silver_sessions silver_drivers silver_laps silver_pit silver_stints silver_car_data "
    "silver_position silver_weather silver_race_control silver_team_radio silver_intervals silver_overtakes "
    "silver_session_result silver_starting_grid gold_driver_performance gold_race_summary gold_team_performance "
    "gold_tyre_strategy gold_fastest_laps gold_overtakes_analysis"
)
Q["landed_counts"] = " union all ".join(
    f"select '{n}' as table_name, count(*) as records from raw_{n}" for n in "meetings sessions car_data laps".split()
)
Q["ingest_ledger"] = " union all ".join(
    f"select '{n}' as endpoint, count(*) as records, cast(0 as bigint) as malformed, "
    f"count(distinct {'meeting_key' if n == 'meetings' else 'session_key'} % 4) as files from raw_{n}"
    for n in (
        "meetings sessions drivers laps pit stints car_data position weather race_control team_radio intervals "
        "overtakes session_result starting_grid"
    ).split()
)
Q["rule_report"] = " union all ".join(
    f"select '{table}' as table_name, '{rule}' as rule, '{action}' as action, "
    f"count_if(coalesce({test}, false)) as passed, count_if(not coalesce({test}, false)) as failed from {source}"
    for table, rule, action, test, source in (
        ("silver_meetings", "valid_meeting_key", "drop", "meeting_key is not null", "unruled_dirty_meetings"),
        ("silver_meetings", "valid_year", "drop", "year >= 2018 and year <= 2030", "unruled_dirty_meetings"),
        ("silver_sessions", "valid_session_key", "drop", "session_key is not null", "silver_sessions"),
        ("silver_sessions", "valid_meeting_key", "drop", "meeting_key is not null", "silver_sessions"),
        ("silver_drivers", "valid_driver_number", "drop", "driver_number is not null", "silver_drivers"),
        ("silver_laps", "valid_lap", "drop", "lap_number is not null and lap_number > 0", "unruled_dirty_laps"),
        ("silver_laps", "valid_duration", "drop", "lap_duration is null or lap_duration > 0", "unruled_dirty_laps"),
        ("silver_car_data", "valid_speed", "warn", "speed >= 0 and speed <= 400", "silver_car_data"),
        ("silver_car_data", "valid_rpm", "warn", "rpm >= 0 and rpm <= 15000", "silver_car_data"),
    )
)

# Telemetry.
_PAIRS = """
select d.session_key, d.driver_number, c.n is not null as seen, coalesce(c.fast, 0) > 0 as seen_fast
from {0} d left join (select session_key, driver_number, count(*) as n, count_if(speed >= 50) as fast
  from silver_car_data group by all) c on c.session_key = d.session_key and c.driver_number = d.driver_number"""
_FIRST = """(select * from silver_drivers
  qualify row_number() over (partition by session_key order by driver_number) <= 5)"""
Q["telemetry_coverage"] = f"""
select session_key, count(*) as expected, count_if(seen) as available, count_if(not seen) as missing,
  count_if(seen_fast) as available_fast, count_if(seen and not seen_fast) as lost_to_speed
from ({_PAIRS.format('silver_drivers')}) group by session_key"""
Q["telemetry_totals"] = f"""
select count(*) as total_fetches, count_if(seen_fast) as successful,
  cast(count_if(seen_fast) as varchar) || '/' || cast(count(*) as varchar) || ' fetches successful' as summary
from ({_PAIRS.format('silver_drivers')})"""
Q["telemetry_missing"] = f"""
select session_key, driver_number from ({_PAIRS.format('silver_drivers')}) where not seen"""
Q["telemetry_sample"] = f"""
select c.* from silver_car_data c where c.speed >= 50
  and (c.session_key, c.driver_number) in (select (session_key, driver_number) from {_FIRST})"""
Q["telemetry_span"] = """
select * from silver_car_data where speed >= 50 and date between timestamp '2024-01-05' and timestamp '2024-01-20'"""

# Landed files.
Q["ingest_two_drops"] = """
select session_key, driver_number, lap_number, case when lap_number % 2 = 0 then floor(pit_duration) else pit_duration end
    as pit_duration, case when lap_number % 2 = 1 then 'crew ' || driver_number end as crew from raw_pit"""
Q["ingest_named_batches"] = """
select 'session_key_' || session_key || '_driver_number_' || driver_number as batch, count(*) as records
from raw_pit group by session_key, driver_number"""
Q["ingest_replaced"] = """
select session_key, count(*) as records, cast(sum(rainfall) as bigint) as rain from raw_weather where rainfall = 0
group by session_key"""
Q["cascade_counts"] = _audit(
    "silver_sessions silver_drivers silver_laps silver_pit gold_driver_performance gold_fastest_laps"
).replace('true as "exists", ', "")

Q["cascade_refreshed"] = _audit("silver_sessions silver_drivers silver_laps silver_pit gold_driver_performance").replace(
    'true as "exists", ', ""
) + "".join(f" union all select 'bronze_{n}', count(*) from raw_{n}" for n in "sessions drivers laps pit".split())
Q["ingest_data_files"] = "select distinct 'session_key_' || session_key as batch, cast(1 as bigint) as files from raw_pit"
Q["ingest_widened"] = """
select session_key, driver_number, position, case position when 1 then 25.0 when 2 then 12.5 end :: double as points,
  case position when 1 then '1' when 2 then 'pit lane' end as grid
from raw_session_result where position <= 3"""
# All laps at once, early, late and corrected, cleaned and aggregated by the same statements as above.
CTE["raw_more_laps"] = """
select * from raw_laps
union all select * replace (lap_duration - 1 as lap_duration) from raw_laps where lap_number % 7 = 3"""
CTE["corrected_laps"] = CTE["silver_laps"].replace("raw_laps", "raw_more_laps")
for _name in ("driver_performance", "fastest_laps", "team_performance", "race_summary"):
    _sql = CTE[f"gold_{_name}"].replace("silver_laps", "corrected_laps")
    CTE[f"corrected_{_name}"] = _sql.replace("gold_driver_performance", "corrected_driver_performance")
Q["cascade_corrected"] = """
select p.*, f.rank, f.lap_number, t.drivers_count, t.team_fastest_lap, t.team_avg_lap_time, r.total_laps as race_laps,
  r.fastest_lap, r.total_pit_stops, r.yellow_flags, r.avg_track_temp, o.overtakes_made
from corrected_driver_performance p
join corrected_fastest_laps f on f.session_key = p.session_key and f.driver_number = p.driver_number
join corrected_team_performance t on t.session_key = p.session_key and t.team_name = p.team_name
left join corrected_race_summary r on r.session_key = p.session_key
left join (select session_key, driver_number, cast(sum(overtakes_made) as bigint) as overtakes_made
  from gold_overtakes_analysis group by all) o on o.session_key = p.session_key and o.driver_number = p.driver_number"""

_RULES = {
    "meetings": (("valid_meeting_key", "meeting_key is not null"), ("valid_year", "year >= 2018 and year <= 2030")),
    "laps": (("valid_lap", "lap_number is not null and lap_number > 0"), ("valid_duration", "lap_duration is null or lap_duration > 0")),
}
_PART = {"meetings": "coalesce(try_cast(meeting_key as int), 0) % 2", "laps": "driver_number % 2"}
_KEY = {
    "meetings": "coalesce(cast(meeting_key as varchar), '-')",
    "laps": "concat_ws('/', coalesce(cast(session_key as varchar), '-'), coalesce(cast(driver_number as varchar), '-'), "
    "coalesce(cast(lap_number as varchar), '-'))",
}
Q["quarantine"] = " union all ".join(
    f"select 'silver_{n}' as table_name, concat_ws(',', "
    + ", ".join(f"case when not coalesce({test}, false) then '{rule}' end" for rule, test in _RULES[n])
    + f") as rules, {_KEY[n]} as key from unruled_dirty_{n} where not coalesce("
    + " and ".join(f"({test})" for _, test in _RULES[n]) + ", false)"
    for n in _RULES
)
Q["rule_history"] = " union all ".join(
    f"select cast({run} as bigint) as run, 'silver_{n}' as table_name, '{rule}' as rule, 'drop' as action, "
    f"count_if(coalesce({test}, false)) as passed, count_if(not coalesce({test}, false)) as failed "
    f"from unruled_dirty_{n}" + (f" where {_PART[n]} = 0" if run == 1 else "")
    for run in (1, 2) for n in _RULES for rule, test in _RULES[n]
) + "".join(
    f" union all select 1, 'silver_{n}', '{rule}', '{action}', 0, 0"
    for n, rule, action in (
        ("sessions", "valid_session_key", "drop"), ("sessions", "valid_meeting_key", "drop"),
        ("drivers", "valid_driver_number", "drop"), ("car_data", "valid_speed", "warn"), ("car_data", "valid_rpm", "warn"),
    )
)
Q["saved_answer"] = """
select session_key, driver_number, total_laps, fastest_lap_time from gold_driver_performance
order by session_key, driver_number limit 10"""
# From tables in buckets: the same rows.
for _name in ("driver_performance", "fastest_laps", "race_summary", "team_performance"):
    Q[f"colocated_{_name}"] = Q[f"gold_{_name}"]
Q["colocated_driver_comparison"] = Q["dash_driver_comparison"]
Q["app_driver_numbers"] = f"""
select distinct d.driver_number from silver_drivers d join silver_sessions s on s.session_key = d.session_key
where s.year = {YEAR} and d.full_name in ('Driver 3', 'Driver 12', 'Nobody')"""

# Season questions.
Q["ask_pole_positions"] = """
select d.full_name, d.team_name, count(*) as poles from silver_starting_grid g
left join silver_drivers d on d.session_key = g.session_key and d.driver_number = g.driver_number
where g.position = 1 group by all"""
Q["ask_grid_to_finish"] = """
select count(*) as entries,
  (count(*) * cast(sum(g.position * r.position) as double) - cast(sum(g.position) as double) * cast(sum(r.position) as double))
  / nullif(sqrt(
    (count(*) * cast(sum(g.position * g.position) as double) - cast(sum(g.position) as double) * cast(sum(g.position) as double))
    * (count(*) * cast(sum(r.position * r.position) as double) - cast(sum(r.position) as double) * cast(sum(r.position) as double))
  ), 0) as correlation
from silver_starting_grid g join silver_session_result r
  on r.session_key = g.session_key and r.driver_number = g.driver_number"""
Q["ask_longest_pit_stop"] = """
select s.session_name, s.location, d.full_name, d.team_name, p.lap_number, p.pit_duration from silver_pit p
left join silver_drivers d on d.session_key = p.session_key and d.driver_number = p.driver_number
left join silver_sessions s on s.session_key = p.session_key
where p.pit_duration is not null order by p.pit_duration desc, p.date, p.session_key, p.driver_number limit 1"""
Q["ask_overtakes_by_circuit"] = """
select s.location, s.circuit_short_name, count(*) as overtakes
from silver_overtakes o join silver_sessions s on s.session_key = o.session_key group by all"""
Q["ask_tyre_changes"] = """
select d.full_name, d.team_name, cast(sum(t.changes) as bigint) as tyre_changes
from (select session_key, driver_number, max(stint_number) - 1 as changes from silver_stints group by all) t
left join silver_drivers d on d.session_key = t.session_key and d.driver_number = t.driver_number group by all"""
Q["ask_safety_car_races"] = """
select session_name, location, date_start, safety_cars from gold_race_summary where safety_cars > 0"""
Q["ask_team_gaps"] = """
select session_key, team_name, team_avg_lap_time,
  team_avg_lap_time - min(team_avg_lap_time) over (partition by session_key) as gap_to_fastest
from gold_team_performance"""

_NAME = re.compile(r"\b(?:%s)\b" % "|".join(sorted(CTE, key=len, reverse=True)))


def with_views(sql: str) -> str:
    """Put the views that a statement uses, directly or not, in front of it."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(re.sub(r"'[^']*'", "''", text))):
            if name not in ordered:
                need(CTE[name])
                ordered.append(name)

    need(sql)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{n} as ({CTE[n].strip()})" for n in ordered) + "\n" + sql.strip()


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in Q.items()}

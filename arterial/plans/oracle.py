"""DuckDB SQL with the same result as the registered queries."""

from __future__ import annotations

from arterial.operators.alerts import TEXTS
from arterial.plans.views import CTE, with_views

SQL: dict[str, str] = {}


def haversine(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = 6371.0) -> str:
    a = (
        f"(power(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* power(sin(radians(({lon2}) - ({lon1})) / 2), 2))"
    )
    return f"({2 * radius} * atan2(sqrt({a}), sqrt(1 - {a})))"


def severity(ratio: str) -> str:
    return (
        f"case when ({ratio}) < 0.3 then 'severe' when ({ratio}) < 0.5 then 'high' when ({ratio}) < 0.7 then 'medium' "
        f"when ({ratio}) < 1.0 then 'low' else 'none' end"
    )


RATIO = "speed / (speed_limit + 1e-6)"


def rank(name: str) -> str:
    return f"(case {name} when 'severe' then 4 when 'high' then 3 when 'medium' then 2 when 'low' then 1 else 0 end)"


FLAGS = f"""flags as (
  select *, {RATIO} as speed_ratio, coalesce(cast({RATIO} < 0.5 as int), 0) as congested_by_speed,
    coalesce(cast(occupancy > 80 as int), 0) as congested_by_occupancy,
    cast({RATIO} < 0.5 or coalesce(occupancy > 80, false) as int) as is_congested,
    {severity(RATIO)} as congestion_severity
  from readings)"""

SERIES = "partition by sensor_id order by timestamp, event_id"


# -- aggregates and congestion ---------------------------------------------------------------------

_WINDOW_COLUMNS = """sensor_id as location_id, round(avg(speed), 6) as avg_speed,
  cast(sum(vehicle_count) as bigint) as total_vehicles, round(avg(occupancy), 6) as avg_occupancy, count(*) as record_count"""

SQL["agg1_sliding"] = with_views("readings", more="""steps as (
  select *, date_trunc('minute', timestamp) - to_minutes(i) as window_start
  from readings, (select unnest([0, 1, 2, 3, 4]) as i))""") + f"""
select window_start, window_start + interval 5 minutes as window_end, {_WINDOW_COLUMNS}
from steps group by window_start, sensor_id"""
SQL["agg1_rollup"] = with_views("readings", more="h as (select *, date_trunc('hour', timestamp) as hour from readings)") + """
select sensor_type, sensor_id, hour, cast(grouping(sensor_type, sensor_id, hour) as bigint) as grouping_id, round(avg(speed), 9) as avg_speed,
  cast(sum(vehicle_count) as bigint) as total_vehicles, round(avg(occupancy), 9) as avg_occupancy, count(*) as record_count
from h group by rollup (sensor_type, sensor_id, hour)"""
SQL["agg1_tumbling"] = with_views("readings") + f"""
select date_trunc('hour', timestamp) as window_start, date_trunc('hour', timestamp) + interval 1 hour as window_end, {_WINDOW_COLUMNS}
from readings group by 1, 2, sensor_id"""
SQL["agg2_hourly"] = with_views("readings") + """
select cast(hour(timestamp) as int) as hour, round(avg(speed), 6) as mean_speed from readings group by 1"""
SQL["cng1_flags"] = with_views("readings", more=FLAGS) + """
select event_id, round(speed_ratio, 6) as speed_ratio, congested_by_speed, congested_by_occupancy, is_congested, congestion_severity
from flags"""

FLOW = f"""flow as (
  select *, coalesce(vehicle_count / ((epoch_us(timestamp) - epoch_us(lag(timestamp) over ({SERIES}))) / 1e6 / 3600 + 1e-6), 0) as flow_rate
  from readings)"""
SQL["cng1_density"] = with_views("readings", more=FLOW) + f"""
, d as (select *, coalesce(flow_rate / (speed + 1e-6), 0) as density from flow)
select event_id, round(speed / 50.0, 6) as speed_ratio, cast(speed / 50.0 < 0.5 as int) as congested_by_speed,
  cast(density > 50 as int) as congested_by_density,
  cast(speed / 50.0 < 0.5 or coalesce(occupancy > 80, false) or density > 50 as int) as is_congested,
  {severity('speed / 50.0')} as congestion_severity
from d"""
SQL["top1_hotspots"] = with_views("readings", more=FLAGS) + f"""
select sensor_id as location_id, round(latitude, 6) as latitude, round(longitude, 6) as longitude, congestion_severity as severity,
  speed, speed_limit, occupancy
from flags where is_congested = 1
order by {rank('congestion_severity')} desc, speed_ratio, sensor_id, flags.latitude, flags.longitude, flags.speed, flags.speed_limit,
  flags.occupancy nulls first
limit 10"""
SQL["agg6_summary"] = with_views("readings", more=FLAGS) + """
select count(*) as total_locations, count(*) filter (is_congested = 1) as congested_count,
  count(*) filter (congestion_severity = 'severe') as severe_count from flags"""
_PREDICTED = """latest as (
  select * from readings qualify row_number() over (partition by sensor_id order by timestamp desc, event_id desc) = 1),
p as (select sensor_id, avg(speed) as predicted_speed from readings group by sensor_id),
j as (select sensor_id as location_id, predicted_speed, speed_limit, predicted_speed / speed_limit as speed_ratio
      from latest join p using (sensor_id))"""
SQL["cng2_predicted"] = with_views("readings", more=_PREDICTED) + f"""
select location_id, round(predicted_speed, 6) as predicted_speed, speed_limit, round(speed_ratio, 6) as speed_ratio,
  speed_ratio < 0.5 as is_congested, {severity('speed_ratio')} as severity from j"""
SQL["cng2_summary"] = with_views("readings", more=_PREDICTED) + """
select count(*) as total_locations, count(*) filter (speed_ratio < 0.5) as congested_count,
  count(*) filter (speed_ratio < 0.3) as severe_count from j"""
SQL["geo5_select"] = with_views("readings", more=FLAGS) + """
select event_id, sensor_id as location_id, congestion_severity from flags
where cast(substr(sensor_id, 2) as bigint) between 1 and 89 and cast(substr(sensor_id, 2) as bigint) % 2 = 1
  and latitude between 40.72 and 40.78 and longitude between -74.02 and -73.96"""

# -- scalar features -------------------------------------------------------------------------------


def _cycle(name: str, value: str, period: int) -> str:
    return (
        f"round(sin(2 * pi() * {value} / {period}.0), 6) as {name}_sin, round(cos(2 * pi() * {value} / {period}.0), 6) as {name}_cos"
    )


_CALENDAR = f"""
  cast(hour(timestamp) as int) as hour, cast(isodow(timestamp) - 1 as int) as day_of_week, cast(day(timestamp) as int) as day_of_month,
  cast(month(timestamp) as int) as month, cast(quarter(timestamp) as int) as quarter, cast(year(timestamp) as int) as year,
  {_cycle('hour', 'hour(timestamp)', 24)}, {_cycle('day_of_week', '(isodow(timestamp) - 1)', 7)}, {_cycle('month', 'month(timestamp)', 12)},
  cast(isodow(timestamp) >= 6 as int) as is_weekend, cast(isodow(timestamp) < 6 as int) as is_weekday,
  cast(hour(timestamp) between 6 and 11 as int) as is_morning, cast(hour(timestamp) between 12 and 17 as int) as is_afternoon,
  cast(hour(timestamp) between 18 and 21 as int) as is_evening, cast(hour(timestamp) >= 22 or hour(timestamp) < 6 as int) as is_night,
  cast(hour(timestamp) between 7 and 9 as int) as is_rush_hour_morning, cast(hour(timestamp) between 17 and 19 as int) as is_rush_hour_evening,
  cast(hour(timestamp) in (7, 8, 9, 17, 18, 19) as int) as is_rush_hour"""
SQL["dt8_temporal"] = with_views("readings") + f"select event_id, {_CALENDAR} from readings"
SQL["dt9_batch"] = with_views("readings") + """
select event_id, timestamp, cast(hour(timestamp) as int) as hour, cast(dayofweek(timestamp) + 1 as int) as day_of_week_sun1,
  cast(dayofweek(timestamp) in (0, 6) as int) as is_weekend from readings"""
SQL["geo3_center"] = with_views("readings") + f"""
select event_id, 'unknown' as road_type, 2 as num_lanes, cast(50.0 as double) as speed_limit,
  round({haversine('latitude', 'longitude', '40.7128', '-74.0060')}, 6) as distance_from_center from readings"""
SQL["geo2_meters"] = with_views("readings") + f"""
select event_id, round({haversine('latitude', 'longitude', '40.75', '-73.99', 6371000.0)}, 3) as meters from readings"""
SQL["geo4_bbox"] = with_views("readings") + """
select event_id, latitude, longitude from readings
where latitude >= 40.72 and latitude <= 40.76 and longitude >= -74.0 and longitude <= -73.96"""
SQL["trf_levels"] = with_views("readings", more=f"r as (select *, {RATIO} as ratio from readings)") + f"""
select event_id, round(ratio, 6) as speed_ratio,
  case when ratio <= 0 then null when ratio <= 0.3 then 'severe' when ratio <= 0.5 then 'high' when ratio <= 0.7 then 'medium'
       when ratio <= 1.0 then 'low' else 'none' end as level,
  {severity('ratio')} as severity, {rank(severity('ratio'))} as severity_rank,
  round(occupancy / 100, 6) as occupancy_normalized, coalesce(cast(occupancy > 80 as int), 0) as is_high_occupancy,
  round(vehicle_count * 60.0 / (speed + 1e-6), 6) as density,
  round(case when speed - 20 > 0 then 2.5 / (speed - 20) * 60 else 0 end, 6) as minutes
from r"""

# -- cleaning, validation, profile -----------------------------------------------------------------

SQL["cln1_travel"] = with_views("travel_times_raw") + """
select l_orderkey, l_linenumber, cast(datetime as timestamp) as timestamp, try_cast(travel_time as double) as travel_time,
  try_cast(distance as double) as distance, try_cast(speed as double) as speed
from travel_times_raw where datetime is not null"""
SQL["cln2_sensor"] = with_views("city_sensor_raw") + """
select event_id, try_cast(created_date as timestamp) as timestamp, try_cast(speed as double) as speed,
  try_cast(occupancy as double) as occupancy
from city_sensor_raw where created_date is not null"""
SQL["src12_city"] = SQL["cln2_sensor"]
SQL["prj1_aliases"] = with_views("readings") + """
select event_id, round(latitude, 6) as latitude, round(longitude, 6) as longitude, timestamp from readings"""
SQL["prj5_json"] = with_views("readings", more="r as (select *, event_id % 19 = 0 as broken from readings)") + """
select case when not broken then sensor_id end as sensor_id,
  case when not broken then date_trunc('millisecond', timestamp) end as timestamp,
  case when not broken then round(latitude, 6) end as latitude, case when not broken then round(longitude, 6) end as longitude,
  case when not broken then round(speed, 6) end as speed, case when not broken then vehicle_count end as vehicle_count,
  case when not broken then occupancy end as occupancy, cast(null as double) as flow_rate,
  case when broken then '{broken ' || event_id end as payload
from r"""
SQL["prj5_quarantine"] = """
select case when event_id % 19 = 0 then 'bad' else 'good' end as part, count(*) as n from events group by 1"""
_DUBIOUS = """dubious as (
  select event_id, case when event_id % 31 = 0 then 'soon' else created_date end as timestamp, speed,
    cast(occupancy as double) as occupancy from city_sensor_raw)"""
SQL["val1_checks"] = with_views("city_sensor_raw", more=_DUBIOUS) + """
, counts as (
  select cast(count(*) = 0 as bigint) as empty, 1::bigint as required_columns, 0::bigint as timestamp_column,
    count(*) filter (timestamp is not null and try_cast(timestamp as timestamp) is null) as timestamp_format,
    count(*) filter (timestamp is null) as timestamp_missing, 1::bigint as speed_numeric, 0::bigint as occupancy_numeric
  from dubious),
long as (unpivot counts on columns(*) into name check_name value n_bad)
select check_name, n_bad = 0 as passed, n_bad from long"""


def _checks(conditions: dict[str, str]) -> str:
    parts = [
        f"select '{name}' as check_name, count(*) filter ({c}) = 0 as passed, count(*) filter ({c}) as n_bad from readings"
        for name, c in conditions.items()
    ]
    return with_views("readings") + "\nunion all\n".join(parts)


SQL["val2_range"] = _checks({
    "before_minimum": "timestamp < timestamp '2024-01-05'",
    "after_maximum": "timestamp > timestamp '2024-01-25'",
    "in_future": "timestamp > timestamp '2024-01-20 01:00:00'",
})
SQL["val3_geo"] = _checks({
    "latitude_bounds": "latitude < 40.71 or latitude > 40.79",
    "longitude_bounds": "longitude < -74.01 or longitude > -73.95",
})
SQL["val4_quarantine"] = with_views("readings") + """
select event_id, concat_ws(',',
  case when timestamp < timestamp '2024-01-05' then 'before_minimum' end,
  case when timestamp > timestamp '2024-01-25' then 'after_maximum' end,
  case when timestamp > timestamp '2024-01-20 01:00:00' then 'in_future' end,
  case when event_id % 37 = 0 then 'latitude_bounds' end) as errors
from readings"""


SQL["val4_stream"] = SQL["val4_quarantine"]
SQL["out1_sketch"] = with_views("readings", more="""d as (select * from readings where cast(timestamp as date) between date '2024-01-05' and date '2024-01-25'),
c as (select 'speed' as name, count(speed) as n from d union all select 'occupancy', count(occupancy) from d)""") + """
select name, cast(rank as double) as rank, n, true as within from c, (select unnest([0.25, 0.5, 0.75]) as rank)"""


def _quartiles(column: str) -> str:
    return f"quantile_cont({column}, 0.25) as {column}_q1, quantile_cont({column}, 0.75) as {column}_q3"


def _outside(column: str) -> str:
    spread = f"1.5 * ({column}_q3 - {column}_q1)"
    return f"coalesce({column} < {column}_q1 - {spread} or {column} > {column}_q3 + {spread}, false)"


_UNCAPPED = "u as (select event_id, value, cast((event_id * 37) % 101 as double) as occupancy from events)"
_QUARTILES = f"q as (select {_quartiles('value')}, {_quartiles('occupancy')} from u)"
SQL["out1_iqr"] = f"with {_UNCAPPED}, {_QUARTILES} select event_id, {_outside('value')} or {_outside('occupancy')} as is_outlier from u, q"
SQL["out2_zscore"] = f"""with {_UNCAPPED}, m as (
  select avg(value) as vm, stddev_samp(value) as vs, avg(occupancy) as om, stddev_samp(occupancy) as os from u)
select event_id, coalesce(abs(value - vm) / vs > 3, false) or coalesce(abs(occupancy - om) / os > 3, false) as is_outlier from u, m"""
SQL["out3_removed"] = f"with {_UNCAPPED}, {_QUARTILES} select event_id, value from u, q where not {_outside('value')}"
SQL["qlt1_missing"] = with_views("readings") + """
select 'occupancy' as column_name, count(*) filter (occupancy is null) as missing,
  round(count(*) filter (occupancy is null) / count(*) * 100, 6) as percentage from readings"""
SQL["qlt2_types"] = """
select column_name, data_type, (select count(*) from events) as total_records, 11 as total_columns
from (values ('event_id', 'bigint'), ('sensor_id', 'string'), ('timestamp', 'timestamp'), ('latitude', 'double'),
  ('longitude', 'double'), ('speed', 'double'), ('vehicle_count', 'int'), ('occupancy', 'double'), ('speed_limit', 'double'),
  ('lane', 'int'), ('sensor_type', 'string')) as t(column_name, data_type)"""
SQL["qlt3_profile"] = with_views("readings") + "\nunion all\n".join(
    f"select '{c}' as column_name, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, cast(round(min({c}), 6) as double) as min, "
    f"cast(round(max({c}), 6) as double) as max, round(quantile_cont({c}, 0.5), 6) as median from readings"
    for c in ("speed", "occupancy", "vehicle_count", "latitude")
)
SQL["qlt4_extent"] = with_views("readings") + """
select min(timestamp) as earliest, max(timestamp) as latest,
  round((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 3.6e9, 6) as span_hours from readings"""
SQL["set1_union"] = with_views("readings") + """
select event_id, sensor_id, case when sensor_type <> 'camera' then round(speed, 6) end as speed,
  case when sensor_type = 'loop_detector' then occupancy end as occupancy, case when sensor_type = 'loop_detector' then lane end as lane,
  sensor_type, case when sensor_type = 'camera' then vehicle_count end as vehicle_count,
  case when sensor_type = 'camera' then round(latitude, 6) end as latitude,
  case when sensor_type = 'camera' then round(longitude, 6) end as longitude
from readings"""
SQL["flt1_range"] = with_views("readings") + """
select event_id, timestamp from readings where timestamp between timestamp '2024-01-10' and timestamp '2024-01-12'"""
SQL["cln3_filled"] = with_views("readings") + """
select event_id, coalesce(occupancy, 0) as occupancy, cast(vehicle_count as double) as vehicle_count from readings"""

# -- windows ---------------------------------------------------------------------------------------

SQL["win1_flow"] = with_views("readings", more=FLOW) + "select event_id, round(flow_rate, 3) as flow_rate from flow"


def rolled(column: str, series: str = SERIES, digits: int = 6, last: int = 0, only: tuple[str, ...] = ("mean_5", "std_5", "mean_10")) -> str:
    end = "current row" if last == 0 else "1 preceding"
    frames = {"mean_5": ("avg", 4 - last), "std_5": ("stddev_samp", 4 - last), "mean_10": ("avg", 9 - last)}
    return ", ".join(
        f"round({frames[o][0]}({column}) over ({series} rows between {frames[o][1]} preceding and {end}), {digits}) as {column}_rolling_{o}"
        for o in only
    )


SQL["win2_rolling"] = with_views("readings") + f"select event_id, {rolled('speed')}, {rolled('occupancy')} from readings"
SQL["win2_training"] = with_views("readings") + f"select event_id, {rolled('speed', last=-1)} from readings"
SQL["win4_traffic"] = with_views("readings", more=FLOW) + f"""
select event_id, round(flow_rate, 3) as flow_rate, round(flow_rate / (speed + 1e-6), 3) as density, round({RATIO}, 6) as speed_ratio,
  cast({RATIO} < 0.5 as int) as is_congested,
  case when {RATIO} <= 0 then null when {RATIO} <= 0.3 then 'severe' when {RATIO} <= 0.5 then 'high' when {RATIO} <= 0.7 then 'medium'
       when {RATIO} <= 1.0 then 'low' else 'none' end as congestion_level,
  round(occupancy / 100, 6) as occupancy_normalized, coalesce(cast(occupancy > 80 as int), 0) as is_high_occupancy,
  {rolled('speed', only=('mean_5',))}, {rolled('vehicle_count', only=('mean_10',))}, {rolled('flow_rate', digits=3, only=('mean_5',))},
  {rolled('occupancy', only=('std_5',))}
from flow"""
SQL["win4_global"] = with_views("readings", more=FLOW.replace(SERIES, "order by timestamp, event_id")) + f"""
select event_id, round(flow_rate, 3) as flow_rate, {rolled('speed', series='order by timestamp, event_id', only=('mean_5', 'mean_10'))} from flow"""
SQL["win5_lags"] = with_views("readings") + "select event_id, " + ", ".join(
    f"lag({c}, {k}) over ({SERIES}) as {c}_lag_{k}" for c in ("speed", "vehicle_count") for k in (1, 2, 3, 5, 10)
) + " from readings"

TRIP = "partition by vehicle_id order by timestamp, event_id"


def _gps(align: str) -> str:
    leg = haversine("latitude", "longitude", "next_lat", "next_lon", 6371000.0)
    elapsed = "next_us - us" if align == "leg" else "us - prev_us"
    return f"""steps as (
  select *, epoch_us(timestamp) as us, lead(latitude) over ({TRIP}) as next_lat, lead(longitude) over ({TRIP}) as next_lon,
    epoch_us(lead(timestamp) over ({TRIP})) as next_us, epoch_us(lag(timestamp) over ({TRIP})) as prev_us
  from gps_points),
legs as (select *, coalesce({leg}, 0) as distance_meters from steps),
speeds as (
  select *, coalesce(distance_meters / nullif(({elapsed}) / 1e6, 0) * 3.6, 0) as speed_kmh from legs)"""


for _name, _align in (("win7_speed", "leg"), ("win7_speed_reference", "reference")):
    SQL[_name] = with_views("gps_points", more=_gps(_align)) + """
select event_id, round(distance_meters, 4) as distance_meters, round(speed_kmh, 4) as speed_kmh from speeds"""
SQL["win8_accel"] = with_views("gps_points", more=_gps("leg")) + f"""
select event_id, round(coalesce((speed_kmh - lag(speed_kmh) over ({TRIP})) / nullif((us - prev_us) / 1e6, 0), 0), 4) as acceleration
from speeds"""


def _stops(align: str, length: str) -> str:
    return with_views("gps_points", more=_gps(align) + f""",
states as (select *, speed_kmh < 5 as is_stopped from speeds),
changes as (select *, cast(is_stopped is distinct from lag(is_stopped) over ({TRIP}) as int) as changed from states),
runs as (select *, sum(changed) over ({TRIP}) as run from changes),
lengths as (
  select vehicle_id, run, (max(us) - min(us)) / 1e6 as seconds, (count(*) - 1) * 60.0 as minutes
  from runs group by vehicle_id, run)""") + f"""
select event_id, is_stopped, round(case when is_stopped then {length} else 0 end, 4) as stop_duration,
  is_stopped and {length} >= 60 as is_significant_stop
from runs join lengths using (vehicle_id, run)"""


SQL["win9_stops"] = _stops("leg", "seconds")
SQL["win9_stops_rows"] = _stops("reference", "minutes")
SQL["win10_sequences"] = with_views("readings", more=f"""s as (
  select event_id, speed as y, list(cast(round(speed * 100) as bigint)) over ({SERIES} rows between 10 preceding and 1 preceding) as x
  from readings)""") + "select event_id, y, array_to_string(x, ',') as x from s where len(x) = 10"
SQL["win10_blocks"] = SQL["win10_sequences"]
SQL["win11_blocks"] = with_views("readings", more=f"""n as (
  select sensor_id, speed, row_number() over ({SERIES}) as rn from readings)""") + """
select sensor_id, cast((rn - 1) // 10 as bigint) as block, arg_min(speed, rn) as y,
  array_to_string(list(cast(round(speed * 100) as bigint) order by rn), ',') as x
from n group by 1, 2 having count(*) = 10"""
SQL["win12_split"] = with_views("readings") + """
select event_id, case when row_number() over (order by timestamp, event_id) <= count(*) over () - ceil(0.2 * count(*) over ())
  then 'train' else 'validation' end as split from readings"""
SQL["srt1_index"] = with_views("readings") + """
select event_id, row_number() over (order by timestamp, event_id) as row_index from readings"""
SQL["win12_by_key"] = with_views("readings") + f"""
select event_id, case when row_number() over ({SERIES})
  <= count(*) over (partition by sensor_id) - ceil(0.2 * count(*) over (partition by sensor_id))
  then 'train' else 'validation' end as split from readings"""
HOURLY = """means as (
  select sensor_id, date_trunc('hour', timestamp) as timestamp, avg(speed) as speed, avg(occupancy) as occupancy
  from readings group by 1, 2),
grid as (
  select sensor_id, unnest(generate_series(min(timestamp), max(timestamp), interval 1 hour)) as timestamp from means group by 1),
hourly as (select grid.sensor_id, grid.timestamp, speed, occupancy from grid left join means using (sensor_id, timestamp))"""
SQL["rsm1_resample"] = with_views("readings", more=HOURLY) + """
select sensor_id, timestamp, round(speed, 6) as speed, round(occupancy, 6) as occupancy from hourly"""
SQL["rsm2_fill"] = with_views("readings", more=HOURLY + """,
ends as (
  select *, last_value(speed ignore nulls) over (p rows between unbounded preceding and current row) as v0,
    last_value(case when speed is not null then timestamp end ignore nulls) over (p rows between unbounded preceding and current row) as t0,
    first_value(speed ignore nulls) over (p rows between current row and unbounded following) as v1,
    first_value(case when speed is not null then timestamp end ignore nulls) over (p rows between current row and unbounded following) as t1
  from hourly window p as (partition by sensor_id order by timestamp))""") + """
select sensor_id, timestamp, round(coalesce(speed, v0 + (v1 - v0) * (epoch(timestamp) - epoch(t0)) / nullif(epoch(t1) - epoch(t0), 0), v0), 9) as speed
from ends"""
SQL["rsm2_forward"] = with_views("readings") + """
select event_id, last_value(occupancy ignore nulls) over
  (partition by sensor_id order by timestamp rows between unbounded preceding and current row) as occupancy from readings"""
SQL["rsm2_backward"] = with_views("readings") + """
select event_id, first_value(occupancy ignore nulls) over
  (partition by sensor_id order by timestamp rows between current row and unbounded following) as occupancy from readings"""
SQL["rsm2_drop"] = with_views("readings") + "select event_id, occupancy from readings where occupancy is not null"

# -- normalisation and metrics ---------------------------------------------------------------------

_SCALED = ("speed", "occupancy", "vehicle_count")
_CENTERS = {
    "min_max": ("min({0})", "max({0}) - min({0})"),
    "standard": ("avg({0})", "stddev_samp({0})"),
    "robust": ("quantile_cont({0}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"),
}


def _normalized(method: str, fitted_on: str = "true") -> str:
    center, scale = _CENTERS[method]
    stats = ", ".join(f"{center.format(c)} as {c}_c, {scale.format(c)} as {c}_s" for c in _SCALED)
    scaled = ", ".join(f"round(({c} - {c}_c) / {c}_s, 6) as {c}" for c in _SCALED)
    return with_views("readings", more=f"s as (select {stats} from readings where {fitted_on})") + f"select event_id, {scaled} from readings, s"


SQL["nrm1_minmax"] = _normalized("min_max")
SQL["nrm2_standard"] = _normalized("standard")
SQL["nrm3_robust"] = _normalized("robust")
SQL["nrm6_transform"] = _normalized("standard", "sensor_type = 'loop_detector'")
SQL["agg3_fit"] = with_views("readings") + "\nunion all\n".join(
    f"select '{c}' as feature, '{m}' as method, cast(round({center.format(c)}, 6) as double) as center, cast(round({scale.format(c)}, 6) as double) as scale from readings"
    for m, (center, scale) in _CENTERS.items() for c in _SCALED
)
SQL["nrm4_constant"] = "select event_id, cast(0.0 as double) as fitted, cast(7.0 as double) as transformed from events"
SQL["nrm5_defaults"] = with_views("readings", more="""t as (
  select event_id, cast(hour(timestamp) as int) as hour, cast(month(timestamp) as int) as month, speed,
    sin(2 * pi() * hour(timestamp) / 24.0) as hour_sin from readings)""") + """
select cast(event_id as varchar) as id, round((event_id - min(event_id) over ()) / (max(event_id) over () - min(event_id) over ()), 6) as event_id,
  hour, month, round((speed - min(speed) over ()) / (max(speed) over () - min(speed) over ()), 6) as speed,
  round((hour_sin - min(hour_sin) over ()) / (max(hour_sin) over () - min(hour_sin) over ()), 6) as hour_sin
from t"""
_ERRORS = """avg(abs(y_true - y_pred)) as mae, sqrt(avg(power(y_true - y_pred, 2))) as rmse,
  avg(case when y_true <> 0 then abs((y_true - y_pred) / y_true) end) * 100 as mape,
  1 - sum(power(y_true - y_pred, 2)) / (var_pop(y_true) * count(*)) as r2, avg(power(y_true - y_pred, 2)) as mse"""
_METRICS = ("mae", "rmse", "mape", "r2", "mse")
_ROUNDED = ", ".join(f"round({m}, 4) as {m}" for m in _METRICS)
SQL["agg4_metrics"] = with_views("forecasts", more=f"e as (select {_ERRORS} from forecasts)") + f"select {_ROUNDED} from e"
SQL["agg4_by_sensor"] = with_views("forecasts", more=f"e as (select sensor_id, {_ERRORS} from forecasts group by 1)") + f"select sensor_id, {_ROUNDED} from e"
_HISTORY = f"""e as (select sensor_id, {_ERRORS} from forecasts group by 1),
long as (unpivot e on mae, rmse, mape, r2, mse into name metric value value)"""
SQL["agg5_history"] = with_views("forecasts", more=_HISTORY) + """
select 'run' as run_id, metric, 'average' as kind, round(avg(value), 4) as value from long group by metric
union all
select 'run', metric, 'latest', round(arg_max(value, sensor_id), 4) from long group by metric"""
SQL["agg5_store"] = with_views("forecasts", more=_HISTORY) + """
select 'run-0' as run_id, metric, 'average' as kind, round(avg(value), 4) as value, cast(3 as bigint) as updates from long group by metric
union all select 'run-0', metric, 'latest', round(value, 4), 3 from long where sensor_id = 'R'
union all select 'run-1', metric, 'average', round(value, 4), 1 from long where sensor_id = 'A'"""
SQL["str3_summary"] = with_views("forecasts", more=_HISTORY) + """
, m as (select metric, avg(value) as v, list_position(['mae', 'rmse', 'mape', 'r2', 'mse'], metric) as o from long group by metric)
select 'run' as run_id, 'Metrics Summary:' || chr(10) || repeat('-', 50) || chr(10) || string_agg(
  case when metric = 'mape' then printf('%s: %.2f%%', upper(metric), v) else printf('%s: %.4f', upper(metric), v) end, chr(10) order by o) as summary
from m"""

# -- alerts and signals ----------------------------------------------------------------------------


def _text(severity_column: str, position: int) -> str:
    cases = " ".join(f"when '{s}' then '{TEXTS[s][position]}'" for s in ("severe", "high", "medium", "low", "none"))
    return f"(case {severity_column} {cases} else '{TEXTS['unknown'][position]}' end)"


SQL["alr1_alerts"] = with_views("readings", more=FLAGS) + f"""
select 'congestion' as type, congestion_severity as severity, sensor_id || '/' || event_id as location_id, round(latitude, 6) as latitude,
  round(longitude, 6) as longitude, replace({_text('congestion_severity', 0)}, '%s', sensor_id || '/' || event_id) as message,
  timestamp '2024-02-01' as timestamp, {_text('congestion_severity', 1)} as recommendation
from flags where congestion_severity in ('high', 'severe')"""
SQL["alr1_threshold"] = with_views("readings", more=FLAGS) + """
select congestion_severity as severity, count(*) as n from flags where congestion_severity in ('medium', 'high', 'severe') group by 1"""
SQL["alr2_recommend"] = with_views("readings", more=FLAGS) + """
select event_id, concat_ws(',', case when congestion_severity in ('high', 'severe') then 'alternative_route:high' end,
  case when event_id % 3 <> 0 then 'route_optimization:medium' end) as recommendations from flags"""
SQL["alr3_advisory"] = with_views("readings", "weather", more=FLAGS) + """
select cast(event_id as varchar) as route_id, round(speed, 6) as travel_time_minutes, round(speed / 2, 6) as distance_km,
  'unknown' as traffic_conditions,
  concat_ws(';', case when congestion_severity in ('high', 'severe') then 'Expect heavy traffic on the way' end,
    case when precipitation > 0 then 'Rain: drive slower, keep more distance' end,
    case when visibility < 5 then 'Poor visibility: drive carefully' end) as alerts,
  case when speed > 60 then 'planning' else '' end as recommendations
from flags left join weather using (event_id)"""
_TIMING = """greens as (
  select *, sum(flow) over w as total, cast(greatest(10, least(120, floor(90 * flow / nullif(sum(flow) over w, 0)))) as int) as green,
    count(*) over w as n from intersection_flow window w as (partition by intersection_id)),
cycles as (select *, cast(sum(green) over (partition by intersection_id) + 3 * n as int) as cycle from greens),
defaults as (select unnest(['north', 'south', 'east', 'west']) as approach),
timing as (
  select intersection_id, approach, cycle as cycle_time, green, 3 as yellow, cycle - green - 3 as red, false as idle from cycles where total <> 0
  union all
  select i.intersection_id, d.approach, 90, 30, 3, 57, true
  from (select distinct intersection_id from cycles where total = 0) i, defaults d)"""
SQL["sig1_timing"] = with_views("intersection_flow", more=_TIMING) + """
select intersection_id, approach, cycle_time, green, yellow, red,
  case when idle then 'maintain' when intersection_id % 2 = 0 then 'optimize' else 'implement' end as recommendation from timing"""
SQL["sig2_default"] = with_views("intersection_flow", more=_TIMING) + """
select intersection_id, approach, cycle_time, green, yellow, red, 'maintain' as recommendation from timing where idle"""
SQL["sig3_maps"] = with_views("intersection_flow", more=_TIMING) + """
select intersection_id, min(cycle_time) as cycle_time, case when bool_or(idle) then 'maintain' else 'implement' end as recommendation,
  max(case when approach = 'north' then green end) as north_green, cast(count(*) as int) as approaches
from timing group by intersection_id"""


def _patched(sql: str, flow: str) -> str:
    """The same query over flows with holes; ``flow`` is what counts at an approach that has a name."""
    plain = f"intersection_flow as ({CTE['intersection_flow']})"
    holes = f"select intersection_id, approach, cast({flow} as double) as flow from all_flow where not (intersection_id % 11 = 0 and approach = 'south')"
    return sql.replace(plain, f"all_{plain.removeprefix('intersection_')},\nintersection_flow as ({holes})")


_HOLES = "intersection_id % 7 = 0 and approach = 'north'"
SQL["sig1_missing"] = _patched(SQL["sig1_timing"], f"case when {_HOLES} then 0 else flow end")
SQL["sig3_missing"] = _patched(
    with_views("intersection_flow", more=_TIMING), f"case when ({_HOLES}) or intersection_id % 13 = 0 or intersection_id % 17 = 0 then 0 else flow end"
) + """
select intersection_id, approach, cycle_time, green, yellow, red, case when idle then 'maintain' else 'implement' end as recommendation from timing"""
SQL["sig4_delay"] = with_views("intersection_flow", more=_TIMING + """,
c as (select intersection_id, cast(80 + intersection_id % 41 as double) as now, cast(min(cycle_time) as double) as new from timing group by 1)""") + """
select intersection_id, now as current_cycle_time, new as optimized_cycle_time, now - new as cycle_reduction_seconds,
  round((now - new) / now * 100, 6) as cycle_reduction_percent, now / 2 as current_avg_delay, new / 2 as optimized_avg_delay,
  now / 2 - new / 2 as delay_reduction_seconds, round((now / 2 - new / 2) / (now / 2) * 100, 6) as delay_reduction_percent
from c"""
SQL["agg7_flows"] = with_views("intersection_flow") + """
select intersection_id, round(sum(flow), 6) as total_flow from intersection_flow group by 1"""

# -- space and graphs ------------------------------------------------------------------------------

SQL["jon3_nearest"] = with_views("readings", "road_nodes", more="""places as (select distinct latitude, longitude from readings),
d as (select p.latitude, p.longitude, n.id, """ + haversine("p.latitude", "p.longitude", "n.latitude", "n.longitude", 6371000.0) + """ as m
      from places p, road_nodes n),
best as (select latitude, longitude, arg_min(id, (round(m, 3), id)) as node_id, min(round(m, 3)) as distance_m from d group by 1, 2)""") + """
select event_id, node_id, distance_m from readings join best using (latitude, longitude)"""
SQL["jon4_knn"] = with_views("road_nodes", more="""d as (
  select a.id as src, b.id as dst, """ + haversine("a.latitude", "a.longitude", "b.latitude", "b.longitude", 6371000.0) + """ as m
  from road_nodes a join road_nodes b on a.id <> b.id and abs(a.latitude - b.latitude) < 0.01 and abs(a.longitude - b.longitude) < 0.013)""") + """
select src, dst, round(m, 3) as distance_m, cast(1.0 as double) as connection_type from d where m <= 1000
qualify row_number() over (partition by src order by round(m, 3), dst) <= 5"""
_KNOWN = "known as (select src, dst, weight from road_edges where (src + dst) % 7 <> 0)"
SQL["grf1_build"] = with_views("road_edges", more=_KNOWN) + "select * from known"
SQL["agg8_counts"] = with_views("road_edges", more=_KNOWN) + """
select (select count(*) from customer) as nodes, (select count(*) from known) as edges"""
# two rows on is two segments of at most 5 each, so no cheapest way costs more than 10
_WALKS = """walk(source, node, cost) as (
  select c_custkey, c_custkey, cast(0.0 as double) from customer
  union
  select w.source, e.dst, w.cost + e.weight from walk w join road_edges e on e.src = w.node where w.cost + e.weight <= 10),
cheapest as (select source, node, min(cost) as cost from walk group by 1, 2)"""
SQL["grf2_paths"] = with_views("road_edges", more=_WALKS, recursive=True) + """
select c_custkey as src, c_custkey + 100 as dst, cost is not null as success, cost
from customer left join cheapest on source = c_custkey and node = c_custkey + 100"""
SQL["grf2_directed"] = SQL["grf2_landmarks"] = SQL["grf2_paths"]
SQL["grf5_negative"] = with_views("road_edges", more=_WALKS, recursive=True) + """
select c_custkey as src, c_custkey + 100 as dst, cost is not null as success,
  cost + ((c_custkey + 100) * 13) % 7 - (c_custkey * 13) % 7 as cost, false as negative_cycle
from customer left join cheapest on source = c_custkey and node = c_custkey + 100"""
SQL["grf5_cycle_routes"] = """
with n as (select cast(n_nationkey * 10 as bigint) as base, n_nationkey % 2 = 0 as bad from nation)
select base as src, base + 4 as dst, not bad as success, case when not bad then 4.0 end as cost, cast(case when not bad then 3 end as int) as num_segments,
  bad as negative_cycle from n
union all select base, base + 5, true, 1.0, 1, false from n
union all select base + 4, base, false, null, null, false from n"""
SQL["grf5_cycles"] = """
select cast(n_nationkey * 10 + 1 as bigint) as cycle, concat_ws(',', n_nationkey * 10 + 1, n_nationkey * 10 + 2, n_nationkey * 10 + 3) as nodes,
  3 as num_segments, cast(-1.0 as double) as cost from nation where n_nationkey % 2 = 0"""
SQL["grf3_walks"] = with_views("road_edges", more=_WALKS, recursive=True) + """
select c_custkey as src, c_custkey + 100 as dst, cost is not null as success, cost as path_cost
from customer left join cheapest on source = c_custkey and node = c_custkey + 100"""


def _nearest(end: str) -> str:
    d = haversine(f"r.{end}_lat", f"r.{end}_lon", "n.latitude", "n.longitude", 6371000.0)
    return f"(select request_id, arg_min(id, (round({d}, 3), id)) as node from requests r, road_nodes n group by 1)"


SQL["grf4_routes"] = with_views("road_edges", "road_nodes", "requests", more=_WALKS + f""",
ends as (select o.request_id, o.node as src, d.node as dst from {_nearest('origin')} o join {_nearest('dest')} d using (request_id))""", recursive=True) + """
select request_id, cost is not null as success, 'astar' as algorithm, case when cost is not null then src end as src,
  case when cost is not null then dst end as dst, cost, case when cost is not null then true end as complete,
  case when cost is not null then round(a.latitude, 6) end as from_latitude, case when cost is not null then round(b.longitude, 6) end as to_longitude,
  case when cost is not null then true end as measured
from ends left join cheapest on source = src and node = dst left join road_nodes a on a.id = src left join road_nodes b on b.id = dst"""
SQL["agg9_distance"] = with_views("road_nodes", more="legs as (select a.id as src, " + " + ".join(
    haversine(f"n{i}.latitude", f"n{i}.longitude", f"n{i + 1}.latitude", f"n{i + 1}.longitude") for i in range(3)
) + """ as km from road_nodes a join road_nodes n0 on n0.id = a.id join road_nodes n1 on n1.id = a.id + 50
  join road_nodes n2 on n2.id = a.id + 100 join road_nodes n3 on n3.id = a.id + 150)""") + """
select src, round(km, 6) as distance_km, 3 as num_segments from legs"""
SQL["grf5_traffic"] = with_views("readings", "road_nodes", "road_edges", more="""s as (
  select cast(substr(sensor_id, 2) as bigint) as id, avg(speed) as v from readings group by 1)""") + f"""
select src, dst, round({haversine('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')}
  / case when v > 0 then v else 50 end * 60, 6) as weight
from road_edges join road_nodes a on a.id = src join road_nodes b on b.id = dst left join s on s.id = src"""


def _propagated(hops: int) -> str:
    steps = [
        "arcs as (select src, dst from road_edges union all select c_custkey, c_custkey from customer)",
        "deg as (select dst as id, count(*) as d from arcs group by 1)",
        "w as (select src, arcs.dst, 1 / sqrt(a.d * b.d) as w from arcs join deg a on a.id = src join deg b on b.id = arcs.dst)",
        "h0 as (select c_custkey as id, c_acctbal from customer)",
    ]
    for i in range(hops):
        steps.append(f"h{i + 1} as (select dst as id, sum(c_acctbal * w) as c_acctbal from w join h{i} on h{i}.id = src group by 1)")
    return ",\n".join(steps)


SQL["grf6_propagate"] = with_views("road_edges", more=_propagated(2)) + "select id, round(c_acctbal, 4) as c_acctbal from h2"
SQL["grf6_pool"] = with_views("road_edges", more=_propagated(1)) + """
select c_nationkey, round(avg(h1.c_acctbal), 4) as c_acctbal from h1 join customer on c_custkey = id group by 1"""
SQL["grf7_traveltime"] = with_views("requests", more=f"""d as (
  select *, {haversine('origin_lat', 'origin_lon', 'dest_lat', 'dest_lon')} as km from requests)""") + """
select request_id, round(km, 6) as distance_km, round(km / predicted_speed_kmh * 60, 6) as travel_time_minutes from d"""
SQL["jon9_asof"] = with_views("readings", "weather") + """
select r.event_id, w.timestamp as timestamp_right, round(precipitation, 6) as precipitation, visibility
from readings r asof left join weather w on r.timestamp >= w.timestamp"""
SQL["jon9_asof_by"] = with_views("readings", more="seen as (select * from readings where occupancy is not null)") + """
select r.event_id, s.occupancy, s.timestamp as timestamp_right
from readings r asof left join seen s on r.sensor_type = s.sensor_type and r.timestamp >= s.timestamp"""
SQL["jon9_holiday"] = with_views("readings", more="""days as (
  select distinct day(o_orderdate) as d from orders where day(o_orderdate) % 3 = 0)""") + """
select event_id, cast(exists(select 1 from days where d = day(timestamp) and month(timestamp) = 1 and year(timestamp) = 2024) as int) as is_holiday
from readings"""

# -- forecasting -----------------------------------------------------------------------------------

_HOUR, _DOW, _MONTH = "hour(timestamp)", "(isodow(timestamp) - 1)", "month(timestamp)"
_CALENDAR = {
    "hour": _HOUR, "day_of_week": _DOW, "day_of_month": "day(timestamp)", "month": _MONTH, "quarter": "quarter(timestamp)", "year": "year(timestamp)",
    **{f"{name}_{f}": f"{f}(2 * pi() * {value} / {period}.0)" for name, value, period in (("hour", _HOUR, 24), ("day_of_week", _DOW, 7), ("month", _MONTH, 12))
       for f in ("sin", "cos")},
    **{name: f"cast({condition} as int)" for name, condition in (
        ("is_weekend", f"{_DOW} >= 5"), ("is_weekday", f"{_DOW} < 5"), ("is_morning", f"{_HOUR} between 6 and 11"),
        ("is_afternoon", f"{_HOUR} between 12 and 17"), ("is_evening", f"{_HOUR} between 18 and 21"), ("is_night", f"{_HOUR} >= 22 or {_HOUR} < 6"),
        ("is_rush_hour_morning", f"{_HOUR} in (7, 8, 9)"), ("is_rush_hour_evening", f"{_HOUR} in (17, 18, 19)"),
        ("is_rush_hour", f"{_HOUR} in (7, 8, 9, 17, 18, 19)"),
    )},
}
_FIVE, _TEN = (f"over ({SERIES} rows between {n} preceding and 1 preceding)" for n in (5, 10))
_FEATURES = {
    "latitude": "latitude", "longitude": "longitude", "vehicle_count": "vehicle_count", "occupancy": "occupancy", **_CALENDAR,
    "num_lanes": "2", "speed_limit": "50", "distance_from_center": haversine("latitude", "longitude", "40.7128", "-74.0060"),
    "flow_rate": "flow_rate", "occupancy_normalized": "occupancy / 100", "is_high_occupancy": "coalesce(cast(occupancy > 80 as int), 0)",
    **{f"{c}_rolling_{name}": f"{call}({c}) {frame}" for c in ("speed", "vehicle_count", "flow_rate", "occupancy")
       for name, call, frame in (("mean_5", "avg", _FIVE), ("std_5", "stddev_samp", _FIVE), ("mean_10", "avg", _TEN))},
}
_TRAINING = f"""flow as (
  select *, coalesce(vehicle_count / ((epoch_us(timestamp) - epoch_us(lag(timestamp) over ({SERIES}))) / 1e6 / 3600 + 1e-6), 0) as flow_rate
  from readings),
f as (
  select event_id, speed as target, {', '.join(f"{e} as {n}" for n, e in _FEATURES.items())}
  from flow)"""
SQL["ml1_training_set"] = with_views("readings", more=_TRAINING) + "select event_id, round(target, 6) as speed, " + ", ".join(
    f"round(coalesce(({c} - min({c}) over ()) / nullif(max({c}) over () - min({c}) over (), 0), 0), 6) as {c}" for c in _FEATURES
) + " from f"
SQL["ml3_ensemble"] = with_views("forecasts") + """
select l_orderkey, l_linenumber, round(case when l_linenumber <> 3 then (y_pred * 0.9 * 0.3 + y_pred * 0.5 + y_pred * 1.1 * 0.2) / 1.0
  else (y_pred * 0.9 * 0.3 + y_pred * 1.1 * 0.2) / 0.5 end, 8) as prediction from forecasts"""
SQL["ml6_targets"] = with_views("readings", more="""b as (
  select sensor_id, time_bucket(interval 15 minutes, timestamp) as timestamp, avg(speed) as speed from readings group by 1, 2)""") + """
select b.sensor_id, b.timestamp, round(b.speed, 6) as speed, round(b15.speed, 6) as speed_in_15, round(b30.speed, 6) as speed_in_30,
  round(b60.speed, 6) as speed_in_60
from b left join b b15 on b15.sensor_id = b.sensor_id and b15.timestamp = b.timestamp + interval 15 minutes
  left join b b30 on b30.sensor_id = b.sensor_id and b30.timestamp = b.timestamp + interval 30 minutes
  left join b b60 on b60.sensor_id = b.sensor_id and b60.timestamp = b.timestamp + interval 60 minutes"""
_VOTES = f"votes as (select event_id, {severity(RATIO)} as a, {severity('(' + RATIO + ') * 1.3')} as b, {severity('occupancy / 100')} as c from readings)"
SQL["ml8_vote"] = with_views("readings", more=_VOTES) + "select event_id, case when b = c then b else a end as vote from votes"
SQL["ml8_accuracy"] = with_views("readings", more=_VOTES) + "select round(avg(cast(a = b as double)), 6) as accuracy from votes"
SQL["ml8_folds"] = with_views("readings", more="""n as (
  select event_id, row_number() over (order by timestamp, event_id) - 1 as i, count(*) over () as n from readings)""") + """
select event_id, cast((i >= 1 * n // 5)::int + (i >= 2 * n // 5)::int + (i >= 3 * n // 5)::int + (i >= 4 * n // 5)::int as int) as fold from n"""

_SIMPLE = """n as (
  select event_id, timestamp, sensor_type, speed, occupancy, row_number() over (order by timestamp, event_id) - 1 as i, count(*) over () as n
  from readings where speed is not null and occupancy is not null),
fit as (
  select regr_slope(speed, occupancy) as b, regr_intercept(speed, occupancy) as a from n where i < n - ceil(0.2 * n)),
told as (select n.*, a + b * occupancy as prediction from n, fit where i >= n - ceil(0.2 * n))"""
SQL["ml5_predict"] = with_views("readings", more=_SIMPLE) + """
select event_id, round(speed, 4) as speed, round(prediction, 4) as prediction from told"""
SQL["ml4_evaluate"] = with_views("readings", more=_SIMPLE) + """
select sensor_type, round(avg(abs(speed - prediction)), 4) as mae, round(sqrt(avg((speed - prediction) ** 2)), 4) as rmse,
  round(1 - sum((speed - prediction) ** 2) / (var_pop(speed) * count(*)), 4) as r2 from told group by sensor_type"""
SQL["ml2_forecasters"] = with_views("readings", more="""s as (
  select event_id, 50 + 10 * sin(2 * pi() * hour(timestamp) / 24.0) - 0.2 * occupancy as speed,
    row_number() over (order by timestamp, event_id) as i, count(*) over () as n
  from readings where occupancy is not null)""") + """
select event_id, round(speed, 4) as speed, true as linear_near, true as linear_better, true as gbt_halves from s where i > n - ceil(0.2 * n)"""
SQL["ml5_outside"] = with_views("readings") + "select event_id, round(speed, 6) as speed, vehicle_count, round(2 * speed - vehicle_count, 6) as prediction from readings"
SQL["prj4_processing_time"] = with_views("readings") + "select event_id, true as fresh, timestamp from readings"
SQL["ml6_horizons"] = with_views("readings", more="""b as (
  select sensor_id, time_bucket(interval 15 minutes, timestamp) as timestamp, avg(speed) as speed from readings group by 1, 2 having avg(speed) is not null),
t as (
  select b.sensor_id, b.timestamp, b.speed, b15.speed as s15, b30.speed as s30, b60.speed as s60,
    row_number() over (order by b.timestamp, b.sensor_id) - 1 as i, count(*) over () as n
  from b left join b b15 on b15.sensor_id = b.sensor_id and b15.timestamp = b.timestamp + interval 15 minutes
    left join b b30 on b30.sensor_id = b.sensor_id and b30.timestamp = b.timestamp + interval 30 minutes
    left join b b60 on b60.sensor_id = b.sensor_id and b60.timestamp = b.timestamp + interval 60 minutes),
fit as (
  select regr_slope(s15, speed) as b15, regr_intercept(s15, speed) as a15, regr_slope(s30, speed) as b30, regr_intercept(s30, speed) as a30,
    regr_slope(s60, speed) as b60, regr_intercept(s60, speed) as a60 from t where i < n - ceil(0.2 * n))""") + """
select sensor_id, timestamp, round(a15 + b15 * speed, 4) as predicted_in_15, round(a30 + b30 * speed, 4) as predicted_in_30,
  round(a60 + b60 * speed, 4) as predicted_in_60 from t, fit where i >= n - ceil(0.2 * n)"""
SQL["ml8_cross_validation"] = with_views("readings", more=_SIMPLE + """,
f as (
  select *, (i >= 1 * n // 5)::int + (i >= 2 * n // 5)::int + (i >= 3 * n // 5)::int + (i >= 4 * n // 5)::int as fold from n),
models as (
  select k.fold, regr_slope(speed, occupancy) as b, regr_intercept(speed, occupancy) as a
  from f, (values (0), (1), (2), (3), (4)) as k(fold) where f.fold <> k.fold group by k.fold),
errors as (
  select fold, sqrt(avg((speed - a - b * occupancy) ** 2)) as rmse from f join models using (fold) group by fold),
plain as (select k.fold, avg(speed) as m from f, (values (0), (1), (2), (3), (4)) as k(fold) where f.fold <> k.fold group by k.fold),
strong as (select fold, sqrt(avg((speed - m) ** 2)) as rmse from f join plain using (fold) group by fold),
tried as (
  select cast(0.0 as double) as regularization, avg(rmse) as rmse from errors union all select cast(1000.0 as double), avg(rmse) from strong)""") + """
select cast((select count(*) from f) as bigint) as n, cast((select count(distinct fold) from f) as int) as folds, regularization,
  round(rmse, 2) as rmse, true as chosen_by_error from tried"""

# -- large keys and tables ---------------------------------------------------------------------------

_CROWDED = "select * replace (case when event_id % 3 = 0 then 'HOT' when event_id % 101 <> 0 then sensor_id end as sensor_id) from all_readings"


def _crowded(sql: str) -> str:
    """The same query with a third of the readings at one sensor and some without a sensor."""
    plain = f"readings as ({CTE['readings']})"
    sql = sql.replace(plain, f"all_{plain},\nreadings as ({_CROWDED})")
    return sql.replace(
        "grid left join means using (sensor_id, timestamp)",
        "grid left join means on grid.sensor_id is not distinct from means.sensor_id and grid.timestamp = means.timestamp",
    )


SQL |= {f"far_{name}": _crowded(SQL[near]) for name, near in (
    ("traffic", "win4_traffic"), ("lags", "win5_lags"), ("sequences", "win10_sequences"), ("fill", "rsm2_fill"),
)}
SQL |= {f"far_{name}": SQL[near] for name, near in (
    ("global", "win4_global"), ("index", "srt1_index"), ("asof", "jon9_asof"), ("knn", "jon4_knn"),
)}
SQL["far_quartiles"] = with_views("readings") + "\nunion all\n".join(
    f"select '{c}' as name, round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as q2, round(quantile_cont({c}, 0.75), 6) as q3 from readings"
    for c in ("speed", "occupancy", "vehicle_count")
)
SQL["far_stops"] = SQL["win9_stops"].replace(
    "concat('V', cast(user_id as varchar)) as vehicle_id", "case when event_id % 3 = 0 then 'HOT' else concat('V', cast(user_id as varchar)) end as vehicle_id"
)
SQL["far_salted"] = _crowded(with_views("readings")) + """
select a.sensor_id, count(*) as n, round(sum(a.speed - b.speed), 2) as gap
from readings a join readings b on a.sensor_id = b.sensor_id and b.timestamp < timestamp '2024-01-03' group by 1"""

# -- sources and sinks -----------------------------------------------------------------------------

SQL["src5_loop_detector"] = with_views("readings") + """
select timestamp, sensor_id, vehicle_count, round(speed, 6) as average_speed, occupancy, lane,
  case when event_id % 2 <> 0 then 'a, b' end as note from readings
where sensor_type is not null and timestamp between timestamp '2024-01-10' and timestamp '2024-01-12'"""
SQL["src6_camera"] = with_views("readings") + """
select timestamp, sensor_id as camera_id, vehicle_count, 'low' as congestion_level, round(latitude, 6) as latitude,
  round(longitude, 6) as longitude, case when event_id % 2 <> 0 then 'a, b' end as note from readings"""
SQL["src7_radar"] = with_views("readings") + """
select timestamp, sensor_id as radar_id, round(speed, 6) as speed, 'N' as direction, case when event_id % 2 = 0 then 'car' end as vehicle_type,
  case when event_id % 2 <> 0 then 'a, b' end as note from readings"""
SQL["src8_all_sensors"] = with_views("readings") + """
select t.sensor_type, sensor_id, count(*) as n, case when t.sensor_type <> 'camera' then round(sum(speed), 2) end as speed,
  case when t.sensor_type <> 'radar' then cast(sum(vehicle_count) as bigint) end as vehicles
from readings, (values ('loop_detector'), ('camera'), ('radar')) as t(sensor_type) group by 1, 2"""
SQL["src9_travel_files"] = with_views("travel_times_raw") + """
select cast(cast(datetime as timestamp) as date) as day, count(*) as n, round(sum(try_cast(travel_time as double)), 2) as travel_time
from travel_times_raw where datetime >= '1996' group by 1"""
SQL["src10_gpx"] = with_views("gps_points") + """
select timestamp, round(latitude, 6) as latitude, longitude, cast(event_id as double) as elevation from gps_points"""
SQL["src11_trajectory"] = with_views("gps_points") + """
select event_id, round(latitude, 6) as latitude, longitude, timestamp from gps_points"""
SQL["src13_incidents"] = with_views("readings") + """
select event_id, timestamp as created_date from readings where timestamp >= timestamp '2024-01-18 12:00:00'"""
SQL["src14_roads"] = with_views("road_nodes", "road_edges", more="""ends as (
  select src as id from road_edges union select dst from road_edges),
d as (select src, count(*) as degree, sum(weight) as weight from road_edges group by 1)""") + """
select id, round(latitude, 6) as latitude, round(longitude, 6) as longitude, degree, weight
from ends join road_nodes using (id) left join d on src = id"""
SQL["src12_city_csv"], SQL["src13_incidents_csv"], SQL["src14_roads_csv"] = SQL["src12_city"], SQL["src13_incidents"], SQL["src14_roads"]
SQL["top2_limit"] = "select 'some' as asked, least(count(*), 100) as n from events union all select 'all', count(*) from events"
SQL["src15_range"] = with_views("readings") + """
select event_id, speed, cast(timestamp as date) as date from readings where cast(timestamp as date) between date '2024-01-10' and date '2024-01-19'"""
SQL["src16_latest"] = SQL["cln1_travel"]
SQL["snk6_batch"] = with_views("readings") + """
select event_id, speed, cast(hour(timestamp) as int) as hour, cast(dayofweek(timestamp) + 1 as int) as day_of_week_sun1,
  cast(dayofweek(timestamp) in (0, 6) as int) as is_weekend, cast(timestamp as date) as date from readings"""

# -- streaming -------------------------------------------------------------------------------------

SQL["stm2_sliding"] = SQL["agg1_sliding"]
SQL["stm3_tumbling"] = SQL["agg1_tumbling"]
SQL["stm1_json"] = SQL["agg1_tumbling"]
SQL["stm8_alert_feed"] = with_views("readings", more="""w as (
  select date_trunc('hour', timestamp) + interval 1 hour as window_end, sensor_id as location_id, avg(speed) / 50.0 as ratio
  from readings group by 1, 2)""") + f"""
, s as (select *, {severity('ratio')} as severity from w)
select location_id, window_end, severity, replace({_text('severity', 0)}, '%s', location_id) as message, {_text('severity', 1)} as recommendation
from s where severity in ('high', 'severe')"""
SQL["cng1_stream"] = with_views("readings", more=FLAGS) + "select event_id, is_congested, congestion_severity from flags"

SQL["stm9_live_stops"] = with_views("readings", more="""mark as (select epoch_us(max(timestamp)) // 1000 - 600000 as ms from readings),
due as (
  select sensor_id, event_id, epoch_us(timestamp) as us, speed < 12 as slow, ms from readings, mark where epoch_us(timestamp) // 1000 <= ms),
steps as (
  select *, cast(slow is distinct from lag(slow) over p or us - lag(us) over p > 864000e6 as int) as changed
  from due window p as (partition by sensor_id order by us, event_id)),
runs as (select *, sum(changed) over (partition by sensor_id order by us, event_id) as run, max(us) over (partition by sensor_id) as final from steps),
ended as (
  select sensor_id, min(us) as a, max(us) as b, count(*) as fixes, any_value(final) as final, any_value(ms) as ms
  from runs where slow group by sensor_id, run)""") + """
select sensor_id as vehicle_id, make_timestamp(a) as stop_start, make_timestamp(b) as stop_end, fixes,
  round((b - a) / 1e6, 6) as stop_duration, (b - a) / 1e6 >= 60 as is_significant_stop
from ended where b < final or (b + 864000e6 <= ms * 1000
  and not exists (select 1 from readings r, mark where r.sensor_id = ended.sensor_id and epoch_us(r.timestamp) // 1000 > mark.ms))"""
SQL["stm6_restart"] = with_views("readings") + "select event_id, speed from readings"
SQL["stm6_updates"] = SQL["agg1_tumbling"]
SQL["stm5_late"] = SQL["agg1_tumbling"].replace(
    "from readings", "from readings where not (event_id % 50 = 0 and timestamp < timestamp '2024-01-10')"
)
SQL["stm6_compacted"] = SQL["agg1_tumbling"]
SQL["snk4_memory"] = SQL["stm6_restart"]
SQL["snk2_records"] = with_views("readings") + "select sensor_id as key, event_id, speed, timestamp from readings"

"""DuckDB SQL for every registered query: the independent cross-check.

Each statement starts from the shared tables (``events``, ``orders``) through
the fixture views, so it computes the same thing from scratch in another engine.

Rounding: Spark rounds a double HALF_UP on its decimal text, DuckDB on the
binary value, so a plain ``round`` differs at .xx5 boundaries. :func:`rnd`
rounds the decimal text in DuckDB too.
"""

from __future__ import annotations

from pulsegrid import schemas as S
from pulsegrid.catalog import FILTER_LEVELS, FILTER_WEATHER, FILTER_ZONES
from pulsegrid.operators.matrix import HOURS, hour_column
from pulsegrid.sources.fixtures import ICU_SQL_DUCKDB, TRAFFIC_SQL


def rnd(expr: str, digits: int) -> str:
    return f"cast(round(cast(cast(({expr}) as varchar) as decimal(38,20)), {digits}) as double)"


def _lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _band(expr: str, edges, labels) -> str:
    arms = " ".join(
        f"when {expr} > {lo!r}e0 and {expr} <= {hi!r}e0 then '{label}'"
        for lo, hi, label in zip(edges[:-1], edges[1:], labels)
    )
    return f"case {arms} end"


_TRAFFIC = f"traffic as ({TRAFFIC_SQL})"
_ICU = f"icu as ({ICU_SQL_DUCKDB})"
_PREPARED = f"""prepared as (
  select *, cast(hour(timestamp) as int) as hour, cast(timestamp as date) as date,
         coalesce(ai_anomaly_score >= 0.78e0, false) as is_anomaly,
         coalesce(congestion_level in ('High', 'Critical'), false) as is_high_congestion
  from traffic)"""
_RISK_RAW = (
    "traffic_density / 100 * 0.32e0 + (110 - average_speed) / 110 * 0.22e0"
    " + signal_wait_time / 180 * 0.18e0 + accident_probability * 0.18e0 + ai_anomaly_score * 0.1e0"
)
_TYPED = f"""typed0 as (
  select *, timestamp as event_timestamp, cast(hour(timestamp) as int) as event_hour,
         cast(case congestion_level when 'Critical' then 4 when 'High' then 3 when 'Moderate' then 2 else 1 end as int)
           as congestion_weight,
         {rnd(_RISK_RAW, 4)} as risk_index
  from traffic),
typed as (
  select *, (risk_index >= 0.72e0) or (ai_anomaly_score >= 0.82e0)
            or (average_speed <= 15 and traffic_density >= 80) as severe_event
  from typed0)"""
_CURATED = f"""curated as (
  select *, {rnd('avg(traffic_density) over w', 2)} as rolling_density_6_event,
         {rnd('avg(average_speed) over w - average_speed', 2)} as speed_drop_from_zone_avg
  from typed
  window w as (partition by city_zone order by event_timestamp, vehicle_id
               rows between 5 preceding and current row))"""
_SUMMARY = f"""summary as (
  select city_zone, weather_condition, congestion_level,
         count(vehicle_id) as vehicle_events,
         {rnd('avg(traffic_density)', 2)} as avg_density,
         {rnd('avg(average_speed)', 2)} as avg_speed,
         {rnd('avg(risk_index)', 4)} as avg_risk_index,
         {rnd('avg(ai_anomaly_score)', 4)} as avg_ai_anomaly_score,
         cast(sum(cast(severe_event as int)) as bigint) as severe_events,
         {rnd('cast(sum(cast(severe_event as int)) as double) / nullif(count(vehicle_id), 0) * 100', 2)}
           as severe_event_rate
  from typed group by city_zone, weather_condition, congestion_level)"""
_TOP_RISK = f"""top_risk as (
  select {', '.join(S.PIPELINE_ANOMALY_COLUMNS)} from curated
  order by risk_index desc nulls last, ai_anomaly_score desc nulls last, event_timestamp, vehicle_id
  limit 100)"""
_FILTERED = f"""filtered as (
  select * from prepared
  where city_zone in ({_lst(FILTER_ZONES)}) and weather_condition in ({_lst(FILTER_WEATHER)})
    and congestion_level in ({_lst(FILTER_LEVELS)}))"""
_TREND = """trend as (
  select * from (
    select date_trunc('hour', timestamp) as timestamp_hour,
           avg(traffic_density) as traffic_density,
           avg(ai_anomaly_score) as ai_anomaly_score,
           avg(accident_probability) as accident_probability
    from traffic where timestamp is not null group by 1) t
  where traffic_density is not null and ai_anomaly_score is not null and accident_probability is not null)"""
_ICU_PRE_BASE = f"""icu_x as (
  select *, cast(hour(admission_timestamp) as int) as admission_hour,
         heart_rate / nullif(systolic_bp, 0) as shock_index,
         100 - oxygen_saturation as oxygen_gap,
         {_band('mortality_risk', [-0.01, 0.33, 0.66, 1.01], ['Stable', 'Watchlist', 'Critical'])} as icu_severity_band
  from icu),
icu_pre as (
  select *, coalesce(shock_index >= 0.9e0, false) or coalesce(oxygen_saturation <= 88, false)
            or coalesce(lactate_mmol_l >= 4, false) or coalesce(critical_event, false) as batch_alert
  from icu_x)"""
_ICU_BASE_COLS = ", ".join(S.ICU_COLUMNS)
_ICU_DERIVED = "admission_hour, shock_index, oxygen_gap, icu_severity_band, batch_alert"
_ICU_SLICED = f"""icu_sliced as (
  select {_ICU_BASE_COLS},
         cast(ntile(8) over (order by admission_timestamp, patient_id) as int) as partition_id,
         {_ICU_DERIVED}
  from icu_pre)"""
_RATES = """rates as (
  select icu_unit, avg(cast(batch_alert as double)) as alert_rate
  from icu_pre where icu_unit is not null group by icu_unit)"""
# fixed values, stated here again so that a wrong constant in the library shows
_ZONES = {
    "Metro Central": 14, "Quantum Square": 11, "Aurora Industrial": 9, "Cyber Harbor": 8,
    "Neon North": 7, "Hyperloop West": 6, "Skyline East": 5, "Solaris South": 3,
}
_WEATHER = {"Storm": 18, "Rain": 11, "Fog": 9, "Heatwave": 6}
_ROADS = {"Smooth": 0.02, "Wet": 0.08, "Under Repair": 0.11, "Potholes": 0.13, "Low Visibility": 0.15}
_DIMS = (
    "zp(city_zone, zone_pressure) as (values "
    + ", ".join(f"('{k}', {v})" for k, v in _ZONES.items())
    + "), wp(weather_condition, weather_pressure) as (values "
    + ", ".join(f"('{k}', {v})" for k, v in _WEATHER.items())
    + "), rr(road_condition, road_risk) as (values "
    + ", ".join(f"('{k}', {v!r}e0)" for k, v in _ROADS.items())
    + ")"
)
_PREPARED_COLS = ", ".join(S.PREPARED_SCHEMA.fieldNames())
_CURATED_COLS = ", ".join(S.CURATED_SCHEMA.fieldNames())
_TYPED_COLS = ", ".join(S.CURATED_SCHEMA.fieldNames()[: len(S.TRAFFIC_COLUMNS) + 5])
_SEVERITY_RAW = (
    "(heart_rate - 60) / 130 * 0.18e0 + (130 - systolic_bp) / 90 * 0.22e0"
    " + (100 - oxygen_saturation) / 45 * 0.26e0 + lactate_mmol_l / 14 * 0.22e0 + respiratory_rate / 48 * 0.12e0"
)


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


_forecast_pts = ", ".join(
    f"max(case when rn = {i} then traffic_density end) as x{i}" for i in range(1, S.FORECAST_WINDOW + 2)
)
# newest-first left-to-right sum, the same association order as the Spark side
_forecast_base = "(" * (S.FORECAST_WINDOW - 1) + "x1" + "".join(
    f") + coalesce(x{i}, 0e0)" for i in range(2, S.FORECAST_WINDOW + 1)
)
_forecast_prev = "case k " + " ".join(f"when {i} then x{i + 1}" for i in range(1, S.FORECAST_WINDOW + 1)) + " end"

ORACLE_SQL: dict[str, str] = {
    "telemetry_prepare": _with(_TRAFFIC, _PREPARED) + f"select {_PREPARED_COLS} from prepared",
    "telemetry_filter": _with(_TRAFFIC, _PREPARED, _FILTERED) + f"select {_PREPARED_COLS} from filtered",
    "filter_options": _with(_TRAFFIC)
    + """select 'city_zone' as dimension, city_zone as option from traffic where city_zone is not null
union select 'weather_condition', weather_condition from traffic where weather_condition is not null
union select 'vehicle_type', vehicle_type from traffic where vehicle_type is not null""",
    "kpi_summary": _with(_TRAFFIC, _PREPARED)
    + """select coalesce(cast(count(*) as double), 0e0) as total_vehicles,
       coalesce(avg(cast(is_high_congestion as double)) * 100, 0e0) as congestion_percentage,
       coalesce(avg(ai_anomaly_score), 0e0) as average_anomaly_score,
       coalesce(avg(accident_probability) * 100, 0e0) as average_accident_probability,
       coalesce(avg(average_speed), 0e0) as average_speed
from prepared""",
    "accident_hotspots": _with(_TRAFFIC, _PREPARED)
    + f"""select * from (
  select city_zone, avg(accident_probability) as accident_probability,
         avg(ai_anomaly_score) as ai_anomaly_score,
         cast(sum(cast(is_high_congestion as bigint)) as bigint) as is_high_congestion
  from prepared where city_zone is not null group by city_zone) z
order by accident_probability desc nulls last, ai_anomaly_score desc nulls last, city_zone
limit 8""",
    "zone_summary": _with(_TRAFFIC, _PREPARED)
    + """select city_zone, avg(traffic_density) as traffic_density, avg(average_speed) as average_speed,
       avg(signal_wait_time) as signal_wait_time, avg(accident_probability) as accident_probability,
       avg(ai_anomaly_score) as ai_anomaly_score, count(vehicle_id) as vehicle_count
from prepared where city_zone is not null group by city_zone""",
    "top_anomaly_zones": _with(_TRAFFIC, _PREPARED)
    + f"""select * from (
  select city_zone, avg(traffic_density) as traffic_density, avg(average_speed) as average_speed,
         avg(signal_wait_time) as signal_wait_time, avg(accident_probability) as accident_probability,
         avg(ai_anomaly_score) as ai_anomaly_score, count(vehicle_id) as vehicle_count
  from prepared where city_zone is not null group by city_zone) z
order by ai_anomaly_score desc nulls last, city_zone limit 8""",
    "congestion_trend_hourly": _with(_TRAFFIC, _TREND) + "select * from trend",
    "congestion_trend_scaled": _with(_TRAFFIC, _TREND)
    + "select timestamp_hour, traffic_density, ai_anomaly_score * 100 as ai_anomaly_x100 from trend",
    "traffic_forecast": _with(
        _TRAFFIC,
        _TREND,
        f"""latest as (
  select timestamp_hour, traffic_density, row_number() over (order by timestamp_hour desc) as rn
  from trend qualify rn <= {S.FORECAST_WINDOW + 1})""",
        f"""pts as (
  select max(timestamp_hour) as last_hour, count(*) as n, {_forecast_pts} from latest)""",
        f"""stats as (
  select last_hour, n, ({_forecast_base}) / least(n, {S.FORECAST_WINDOW}) as base,
         least(n - 1, {S.FORECAST_WINDOW}) as k, *
  from pts where n > 0)""",
        f"""stats2 as (
  select last_hour, base,
         case when k > 0 then (x1 - {_forecast_prev}) / k else 0e0 end as momentum
  from stats)""",
    )
    + f"""select last_hour + to_hours(step) as timestamp_hour,
       greatest(0e0, least(100e0, base + momentum * step)) as forecast_density
from stats2, range(1, {S.FORECAST_PERIODS + 1}) t(step)""",
    "top_anomalies": _with(_TRAFFIC)
    + f"""select {', '.join(S.DASHBOARD_ANOMALY_COLUMNS)} from traffic
order by ai_anomaly_score desc nulls last, timestamp, vehicle_id limit 20""",
    "vehicle_type_distribution": _with(
        _TRAFFIC,
        "counts as (select vehicle_type, count(*) as count from traffic where vehicle_type is not null group by 1)",
    )
    + """select vehicle_type, count,
       cast(count as double) / cast((select sum(count) from counts) as double) as share
from counts""",
    "congestion_heatmap": _with(_TRAFFIC, _PREPARED)
    + "select city_zone, "
    + ", ".join(
        f"coalesce(avg(traffic_density) filter (where hour = {h}), 0e0) as {hour_column(h)}" for h in HOURS
    )
    + "\nfrom prepared where city_zone is not null and hour is not null group by city_zone",
    "weather_impact": _with(_TRAFFIC)
    + """select weather_condition, avg(traffic_density) as traffic_density,
       avg(accident_probability) as accident_probability
from traffic where weather_condition is not null group by weather_condition""",
    "speed_histogram": _with(
        _TRAFFIC,
        f"""binned as (
  select congestion_level,
         cast(least(44, greatest(0,
              floor((average_speed - 3e0) / (107e0 / 45e0))))
              as int) as bin
  from traffic where average_speed is not null and congestion_level is not null)""",
    )
    + f"""select congestion_level, bin,
       3e0 + bin * (107e0 / 45e0) as bin_start,
       count(*) as n
from binned group by congestion_level, bin""",
    "tppp_typed": _with(_TRAFFIC, _TYPED) + f"select {_TYPED_COLS} from typed",
    "tppp_curated": _with(_TRAFFIC, _TYPED, _CURATED) + f"select {_CURATED_COLS} from curated",
    "tppp_zone_weather_summary": _with(_TRAFFIC, _TYPED, _SUMMARY) + "select * from summary",
    "tppp_top_anomalies": _with(_TRAFFIC, _TYPED, _CURATED, _TOP_RISK) + "select * from top_risk",
    "tppp_run_stats": _with(_TRAFFIC, _TYPED, _SUMMARY)
    + f"""select (select count(*) from traffic) as input_rows,
       (select count(*) from summary) as summary_rows,
       cast(least(100, (select count(*) from traffic)) as bigint) as anomaly_rows""",
    "icu_preprocessed": _with(_ICU, _ICU_PRE_BASE, _ICU_SLICED) + "select * from icu_sliced",
    "icu_unit_alert_rates": _with(_ICU, _ICU_PRE_BASE, _RATES) + "select * from rates",
    "icu_batch_summary": _with(_ICU, _ICU_PRE_BASE, _RATES)
    + """select count(*) as rows,
       coalesce(avg(cast(batch_alert as double)) * 100, 0e0) as alert_rate,
       coalesce(avg(mortality_risk), 0e0) as avg_mortality_risk,
       coalesce((select icu_unit from rates order by alert_rate desc, icu_unit limit 1), 'N/A') as top_unit
from icu_pre""",
    "icu_slice_profile": _with(_ICU)
    + """select cast(i as int) as partition_id, count(s.slice) as rows
from generate_series(1, 8) g(i) left join (
  select ntile(8) over (order by admission_timestamp, patient_id) as slice from icu) s on s.slice = g.i
group by i""",
    "icu_union_batches": _with(_ICU, _ICU_PRE_BASE) + f"select {_ICU_BASE_COLS}, {_ICU_DERIVED} from icu_pre",
    "congestion_band": _with(_TRAFFIC)
    + f"""select vehicle_id, timestamp, traffic_density,
       {_band('traffic_density', [-1.0, 35.0, 60.0, 80.0, 101.0], ['Low', 'Moderate', 'High', 'Critical'])} as congestion_band
from traffic""",
    "peak_hour_factor": _with(_TRAFFIC)
    + """select vehicle_id, timestamp, cast(hour(timestamp) as int) as event_hour,
       case when hour(timestamp) between 7 and 10 or hour(timestamp) between 17 and 20
            then 1.32e0 else 0.9e0 end as peak_multiplier
from traffic""",
    "condition_pressure_lookup": _with(_TRAFFIC, _DIMS)
    + """select t.vehicle_id, t.timestamp, cast(zp.zone_pressure as int) as zone_pressure,
       cast(coalesce(wp.weather_pressure, 0) as int) as weather_pressure, rr.road_risk
from traffic t
left join zp on t.city_zone = zp.city_zone
left join wp on t.weather_condition = wp.weather_condition
left join rr on t.road_condition = rr.road_condition""",
    "accident_risk_score": _with(_TRAFFIC, _DIMS)
    + f"""select t.vehicle_id, t.timestamp,
       {rnd('greatest(0e0, least(0.98e0, 0.03e0 + t.traffic_density / 260 + t.signal_wait_time / 750 + rr.road_risk))', 4)}
         as score
from traffic t left join rr on t.road_condition = rr.road_condition""",
    "anomaly_score": _with(_TRAFFIC)
    + f"""select vehicle_id, timestamp,
       {rnd('greatest(0e0, least(1e0, traffic_density / 100 * 0.35e0 + signal_wait_time / 180 * 0.25e0 + (1 - average_speed / 110) * 0.22e0 + accident_probability * 0.18e0))', 4)}
         as score
from traffic""",
    "icu_severity_score": _with(_ICU)
    + f"""select patient_id, greatest(0e0, least(1e0, {_SEVERITY_RAW})) as severity_score,
       greatest(0e0, least(1e0, {_SEVERITY_RAW})) >= 0.72e0 as is_critical
from icu""",
}
_NAN_AS_NULL = (
    "traffic as (select * replace ("
    + ", ".join(
        f"case when cast(substr(vehicle_id, 5) as bigint) % 97 = 0 then null else {c} end as {c}"
        for c in ("traffic_density", "average_speed", "accident_probability", "ai_anomaly_score")
    )
    + f") from ({TRAFFIC_SQL}) raw)"
)
for _name, _base in {
    "kpi_summary_nan": "kpi_summary", "congestion_trend_nan": "congestion_trend_hourly",
    "speed_histogram_nan": "speed_histogram", "top_anomalies_nan": "top_anomalies",
}.items():
    ORACLE_SQL[_name] = ORACLE_SQL[_base].replace(_TRAFFIC, _NAN_AS_NULL)
ORACLE_SQL["source_csv_traffic"] = ORACLE_SQL["telemetry_prepare"]
ORACLE_SQL["source_csv_icu"] = ORACLE_SQL["icu_union_batches"]
ORACLE_SQL["source_csv_corrupt_count"] = (
    "select count(*) filter (where event_id % 97 = 0) as corrupt_rows, count(*) as input_rows from events"
)
ORACLE_SQL["icu_slice_counts"] = ORACLE_SQL["icu_slice_profile"]
ORACLE_SQL["sink_csv_filtered"] = ORACLE_SQL["telemetry_filter"]
ORACLE_SQL["sink_csv_icu"] = ORACLE_SQL["icu_preprocessed"]
ORACLE_SQL["sink_csv_tppp_summary"] = ORACLE_SQL["tppp_zone_weather_summary"]
ORACLE_SQL["sink_csv_tppp_anomalies"] = ORACLE_SQL["tppp_top_anomalies"]
ORACLE_SQL["sink_parquet_curated"] = ORACLE_SQL["tppp_curated"]
ORACLE_SQL["tppp_curated_increments"] = ORACLE_SQL["tppp_curated"]
ORACLE_SQL["tppp_released_summary"] = ORACLE_SQL["tppp_zone_weather_summary"]


def _nice_histogram(by: str, value: str, bins: int = 45) -> str:
    """Bins as wide as the data ask for, over a CTE ``traffic``: of all widths 1, 2, 5 x 10^k the smallest with at most ``bins`` bins."""
    return f"""known as (select {by}, {value} as v from traffic where {value} is not null and {by} is not null),
ends as (select min(v) as lo, max(v) as hi from known),
widths as (select d * power(10e0, k) as w from (values (1e0), (2e0), (5e0)) digits(d), range(-9, 10) powers(k)),
best as (select case when max(hi) > max(lo) then min(w) filter (where floor(hi / w) - floor(lo / w) < {bins}) else 1e0 end as w from ends, widths)
select {by}, cast(floor(v / w) as bigint) as bin, cast(floor(v / w) as bigint) * w as bin_start, w as bin_width, count(*) as n
from known, best group by all"""


ORACLE_SQL["nice_histogram_speed"] = f"with {_TRAFFIC}, " + _nice_histogram("congestion_level", "average_speed")
ORACLE_SQL["nice_histogram_anomaly"] = f"with {_TRAFFIC}, " + _nice_histogram("weather_condition", "ai_anomaly_score")

_KEPT_TRAFFIC = (
    f"traffic as (select * from ({TRAFFIC_SQL}) raw where city_zone in ({_lst(FILTER_ZONES)})"
    f" and weather_condition in ({_lst(FILTER_WEATHER)}) and congestion_level in ({_lst(FILTER_LEVELS)}))"
)


def _to_nine_digits(sql: str, doubles: list[str], others: list[str]) -> str:
    return "select " + ", ".join([*others, *(f"{rnd(c, 9)} as {c}" for c in doubles)]) + f" from ({sql}) view"


for _name, _base, _doubles, _others in (
    ("kpis", "kpi_summary", ["total_vehicles", "congestion_percentage", "average_anomaly_score", "average_accident_probability", "average_speed"], []),
    ("zones", "zone_summary", ["traffic_density", "average_speed", "signal_wait_time", "accident_probability", "ai_anomaly_score"], ["city_zone", "vehicle_count"]),
    ("trend", "congestion_trend_hourly", ["traffic_density", "ai_anomaly_score", "accident_probability"], ["timestamp_hour"]),
    ("heatmap", "congestion_heatmap", [hour_column(h) for h in HOURS], ["city_zone"]),
):
    ORACLE_SQL[f"dashboard_{_name}"] = _to_nine_digits(ORACLE_SQL[_base].replace(_TRAFFIC, _KEPT_TRAFFIC), _doubles, _others)
ORACLE_SQL["dashboard_filter_options"] = ORACLE_SQL["filter_options"]
ORACLE_SQL["dashboard_speed_histogram"] = _to_nine_digits(
    f"with {_KEPT_TRAFFIC}, " + _nice_histogram("congestion_level", "average_speed"), ["bin_start", "bin_width"], ["congestion_level", "bin", "n"]
)

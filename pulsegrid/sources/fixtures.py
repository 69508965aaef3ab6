"""The ``traffic`` and ``icu`` inputs, derived from the shared parquet tables.

The test tables are TPC-H-like (``events``, ``orders``); these two views give
them the telemetry column names and domains. They are pure projections (integer
arithmetic plus one exact division), so they stream straight out of the parquet
scan: no shuffle, and only the needed source columns are read (the read schema
lists just those columns, so no schema inference job runs either).

Each view column is one SQL expression, used by Spark through ``selectExpr``
(one parse in the JVM instead of hundreds of Column calls). The DuckDB
cross-check (``TRAFFIC_SQL`` / ``ICU_SQL_DUCKDB``) shares the plain arithmetic and
writes ids and times in its own way.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulsegrid import schemas as S

# the source columns each view reads
EVENTS_READ_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)
ORDERS_READ_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """One of the shared test tables, read with an optional explicit schema."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _case(key_sql: str, labels: list[str]) -> str:
    arms = " ".join(f"when {i} then '{label}'" for i, label in enumerate(labels))
    return f"case {key_sql} {arms} end"


def _band_sql(x: str, edges: list[float], labels: list[str]) -> str:
    arms = " ".join(
        f"when {x} > {lo!r}e0 and {x} <= {hi!r}e0 then '{label}'"
        for lo, hi, label in zip(edges[:-1], edges[1:], labels)
    )
    return f"case {arms} end"


# an id is padded to seven digits and never cut (lpad alone would cut it)
def _padded_spark(x: str) -> str:
    return f"lpad(cast({x} as string), greatest(7, length(cast({x} as string))), '0')"


def _padded_duck(x: str) -> str:
    return f"repeat('0', cast(greatest(0, 7 - length(cast({x} as varchar))) as int)) || cast({x} as varchar)"


_TRAFFIC_VALUES = [
    ("timestamp", "ts"),
    ("city_zone", _case("user_id % 8", S.CITY_ZONES)),
    ("vehicle_type", _case("event_id % 6", S.VEHICLE_TYPES)),
    ("traffic_density", "least(100.0e0, greatest(5.0e0, value))"),
    ("average_speed", "cast((event_id*7919 + user_id*104729) % 10701 + 300 as double)/100"),
    ("weather_condition", _case("(event_id*7 + user_id) % 6", S.WEATHER_CONDITIONS)),
    ("road_condition", _case("(event_id*13 + user_id) % 5", S.ROAD_CONDITIONS)),
    ("signal_wait_time", "cast((event_id*6151) % 18001 as double)/100"),
    ("accident_probability", "cast((event_id*3571 + user_id) % 9801 as double)/10000"),
    ("ai_anomaly_score", "cast((event_id*2657 + user_id*31) % 10001 as double)/10000"),
]
_TRAFFIC_BASE = [("vehicle_id", f"'QTF-' || {_padded_spark('event_id')}"), *_TRAFFIC_VALUES]
_TRAFFIC_DUCK = [("vehicle_id", f"'QTF-' || {_padded_duck('event_id')}"), *_TRAFFIC_VALUES]
_TRAFFIC_LEVEL = _band_sql("traffic_density", S.CONGESTION_BAND_EDGES, S.CONGESTION_BAND_LABELS)


def _icu_base(patient_sql: str, admission_sql: str) -> list[tuple[str, str]]:
    return [
        ("patient_id", f"'ICU-' || {patient_sql}"),
        ("admission_timestamp", admission_sql),
        ("icu_unit", _case("o_custkey % 6", S.ICU_UNITS)),
        ("age", "cast(o_orderkey*31 % 96 + 1 as int)"),
        ("diagnosis", _case("(o_orderkey*5 + o_custkey) % 6", S.DIAGNOSES)),
        ("heart_rate", "cast(o_orderkey*7919 % 1581 + 320 as double)/10"),
        (
            "systolic_bp",
            "cast(case when o_orderkey % 997 = 0 then 0 else (o_orderkey*6151 + o_custkey) % 1751 + 550 end"
            " as double)/10",
        ),
        ("respiratory_rate", "cast(o_orderkey*3571 % 421 + 60 as double)/10"),
        ("oxygen_saturation", "cast((o_orderkey*2657 + o_custkey*31) % 451 + 550 as double)/10"),
        ("temperature_c", "cast(o_orderkey*1013 % 91 + 330 as double)/10"),
        ("glucose_mg_dl", "cast(o_orderkey*4409 % 3951 + 450 as double)/10"),
        ("lactate_mmol_l", "cast((o_orderkey*5087 + o_custkey) % 1371 + 30 as double)/100"),
        ("ventilation_status", _case("(o_orderkey*3 + o_custkey) % 4", S.VENTILATION_STATUS)),
        ("length_of_stay_hours", "cast(o_orderkey*8681 % 7161 + 40 as double)/10"),
        ("mortality_risk", "cast((o_orderkey*9973 + o_custkey*17) % 10001 as double)/10000"),
    ]


_ICU_SPARK = _icu_base(_padded_spark("(o_orderkey + 1)"), "o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 720 as int) * 2, 0)")
_ICU_DUCK = _icu_base(_padded_duck("(o_orderkey + 1)"), "o_orderdate + to_minutes(cast(o_orderkey % 720 as int)*2)")
_CRITICAL = f"mortality_risk >= {S.CRITICAL_RISK_THRESHOLD!r}e0"


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic telemetry (12 columns) derived from ``events``."""
    ev = table(spark, sf_dir, "events", EVENTS_READ_SCHEMA)
    base = ev.selectExpr(*[f"{expr} AS `{name}`" for name, expr in _TRAFFIC_BASE])
    return base.selectExpr(
        *[f"{_TRAFFIC_LEVEL} AS congestion_level" if c == "congestion_level" else f"`{c}`" for c in S.TRAFFIC_COLUMNS]
    )


def icu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICU monitoring records (16 columns) derived from ``orders``."""
    o = table(spark, sf_dir, "orders", ORDERS_READ_SCHEMA)
    base = o.selectExpr(*[f"{expr} AS `{name}`" for name, expr in _ICU_SPARK])
    return base.selectExpr("*", f"{_CRITICAL} AS critical_event")


def _select_sql(columns: list[tuple[str, str]]) -> str:
    return ",\n         ".join(f"{expr} as {name}" for name, expr in columns)


TRAFFIC_SQL = f"""
with b as (
  select {_select_sql(_TRAFFIC_DUCK)}
  from events)
select {', '.join(c if c != 'congestion_level' else _TRAFFIC_LEVEL + ' as congestion_level' for c in S.TRAFFIC_COLUMNS)}
from b
"""

ICU_SQL_DUCKDB = f"""
with b as (
  select {_select_sql(_ICU_DUCK)}
  from orders)
select *, {_CRITICAL} as critical_event from b
"""

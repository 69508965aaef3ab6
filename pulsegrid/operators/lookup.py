"""Enrichment joins against the small fixed condition tables.

The dimension tables are built from the fixed lookup dictionaries in
:mod:`pulsegrid.schemas`; their size is bounded by those constants (8, 4 and 5
rows), so broadcasting them is safe at any data size and the fact side is never
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import accident_risk_score, anomaly_score, peak_multiplier_sql


def _values_table(spark: SparkSession, rows: dict, key: str, value: str, value_sql_type: str) -> DataFrame:
    """A small literal table (``VALUES``): a LocalRelation, planned in the JVM in one call."""
    literal = (lambda v: f"{float(v)!r}D") if value_sql_type == "double" else (lambda v: str(int(v)))
    body = ", ".join(f"('{k}', {literal(v)})" for k, v in rows.items())
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({key}, {value})").selectExpr(
        f"CAST({key} AS STRING) AS {key}", f"CAST({value} AS {value_sql_type}) AS {value}"
    )


def zone_pressure_dim(spark: SparkSession) -> DataFrame:
    return _values_table(spark, S.ZONE_PRESSURE, "city_zone", "zone_pressure", "int")


def weather_pressure_dim(spark: SparkSession) -> DataFrame:
    return _values_table(spark, S.WEATHER_PRESSURE, "weather_condition", "weather_pressure", "int")


def road_risk_dim(spark: SparkSession) -> DataFrame:
    return _values_table(spark, S.ROAD_RISK, "road_condition", "road_risk", "double")


def with_condition_pressure(df: DataFrame) -> DataFrame:
    """Left-join zone pressure, weather pressure (unknown -> 0) and road risk."""
    spark = df.sparkSession
    joined = (
        df.join(F.broadcast(zone_pressure_dim(spark)), on="city_zone", how="left")
        .join(F.broadcast(weather_pressure_dim(spark)), on="weather_condition", how="left")
        .join(F.broadcast(road_risk_dim(spark)), on="road_condition", how="left")
    )
    return joined.withColumn(
        "weather_pressure",
        F.coalesce(F.col("weather_pressure"), F.lit(S.DEFAULT_WEATHER_PRESSURE)),
    )


def condition_pressure_lookup(traffic: DataFrame) -> DataFrame:
    """Zone pressure, weather pressure and road risk per event."""
    return with_condition_pressure(traffic).select(
        "vehicle_id", "timestamp", "zone_pressure", "weather_pressure", "road_risk"
    )


def accident_risk_scores(traffic: DataFrame) -> DataFrame:
    """Noise-free accident probability from density, wait time and road risk."""
    enriched = with_condition_pressure(traffic)
    return enriched.select(
        "vehicle_id",
        "timestamp",
        accident_risk_score("traffic_density", "signal_wait_time", "road_risk").alias("score"),
    )


def anomaly_scores(traffic: DataFrame) -> DataFrame:
    """Noise-free composite anomaly score per event."""
    return traffic.select(
        "vehicle_id",
        "timestamp",
        anomaly_score("traffic_density", "signal_wait_time", "average_speed", "accident_probability").alias(
            "score"
        ),
    )


def peak_hour_factors(traffic: DataFrame) -> DataFrame:
    """Event hour and its peak-hour multiplier per event."""
    return traffic.selectExpr(
        "vehicle_id",
        "timestamp",
        "hour(`timestamp`) AS event_hour",
        f"{peak_multiplier_sql('hour(`timestamp`)')} AS peak_multiplier",
    )

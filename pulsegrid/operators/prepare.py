"""Row-level operators: derived columns and filters (narrow, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import columns as C


#: what :func:`prepare_telemetry` adds
PREPARED_COLUMNS = ("hour", "date", "is_anomaly", "is_high_congestion")


def prepare_telemetry(df: DataFrame) -> DataFrame:
    """hour, date, is_anomaly, is_high_congestion next to the 12 base columns; NaN counts as missing."""
    return C.clean_doubles(df).select(
        "*",
        F.expr("hour(`timestamp`)").alias("hour"),
        F.expr("to_date(`timestamp`)").alias("date"),
        C.is_anomaly("ai_anomaly_score").alias("is_anomaly"),
        C.is_high_congestion("congestion_level").alias("is_high_congestion"),
    )


def filter_telemetry(
    df: DataFrame,
    zones: Sequence[str] = (),
    weather: Sequence[str] = (),
    vehicle_types: Sequence[str] = (),
    congestion_levels: Sequence[str] = (),
) -> DataFrame:
    """Conjunctive membership filter; an empty list means no filter on that column.

    Built as plain ``isin`` predicates so Catalyst pushes them into the scan.
    """
    for column, values in (
        ("city_zone", zones),
        ("weather_condition", weather),
        ("vehicle_type", vehicle_types),
        ("congestion_level", congestion_levels),
    ):
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def type_traffic(df: DataFrame) -> DataFrame:
    """Typed batch-job columns: event time, hour, congestion weight, risk index, severe flag."""
    typed = C.clean_doubles(df).select(
        "*",
        F.col("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.hour("timestamp").alias("event_hour"),
        C.congestion_weight("congestion_level").alias("congestion_weight"),
        C.risk_index().alias("risk_index"),
    )
    return typed.withColumn("severe_event", C.severe_event())


def preprocess_icu(df: DataFrame) -> DataFrame:
    """ICU batch transform: admission hour, shock index, oxygen gap, severity band, alert."""
    out = C.clean_doubles(df).select(
        "*",
        F.hour("admission_timestamp").alias("admission_hour"),
        C.shock_index().alias("shock_index"),
        (F.lit(100) - F.col("oxygen_saturation")).alias("oxygen_gap"),
        C.severity_band("mortality_risk").alias("icu_severity_band"),
    )
    return out.withColumn("batch_alert", C.batch_alert())

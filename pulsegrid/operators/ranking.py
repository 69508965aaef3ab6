"""Top-k and distinct-value operators.

A sort followed by a small limit plans as TakeOrderedAndProject: every task
keeps its own k best rows and only those are merged, so no full sort or
shuffle of the input happens. Every ordering ends with unique tie-break keys so
the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import clean_doubles


def top_anomalies(prepared: DataFrame, limit: int = S.TOP_ANOMALY_LIMIT) -> DataFrame:
    """Highest anomaly scores (ties: earlier timestamp, then vehicle id)."""
    return (
        clean_doubles(prepared.select(*S.DASHBOARD_ANOMALY_COLUMNS))
        .orderBy(F.desc_nulls_last("ai_anomaly_score"), F.asc("timestamp"), F.asc("vehicle_id"))
        .limit(limit)
    )


def top_risk_events(
    curated: DataFrame,
    limit: int = S.PIPELINE_ANOMALY_LIMIT,
    columns: Sequence[str] = tuple(S.PIPELINE_ANOMALY_COLUMNS),
) -> DataFrame:
    """Highest risk index, then anomaly score (ties: event time, vehicle id)."""
    keys = ["risk_index", "ai_anomaly_score", "event_timestamp", "vehicle_id"]
    return (
        curated.select(*dict.fromkeys([*columns, *keys]))
        .orderBy(
            F.desc_nulls_last("risk_index"),
            F.desc_nulls_last("ai_anomaly_score"),
            F.asc("event_timestamp"),
            F.asc("vehicle_id"),
        )
        .limit(limit)
        .select(*columns)
    )


def filter_options(
    df: DataFrame,
    dimensions: Sequence[str] = ("city_zone", "weather_condition", "vehicle_type"),
) -> DataFrame:
    """Sorted distinct values of several columns as (dimension, option) rows.

    One scan: the columns are stacked into rows and de-duplicated together
    (map-side partial distinct, so each task ships at most the distinct values
    it saw).
    """
    args = ", ".join(f"'{d}', cast(`{d}` as string)" for d in dimensions)
    stacked = df.selectExpr(f"stack({len(dimensions)}, {args}) as (dimension, option)")
    return (
        stacked.filter(F.col("option").isNotNull())
        .distinct()
        .orderBy("dimension", "option")
    )

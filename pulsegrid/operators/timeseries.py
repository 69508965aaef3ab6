"""Hourly trend and the short rolling forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import clean_doubles, clamp, hour_floor


def hourly_trend(df: DataFrame) -> DataFrame:
    """Mean density, anomaly score and accident probability per clock hour.

    Equal to resampling by hour and dropping empty (or partly empty) hours: a
    group-by on the truncated hour only produces hours that have rows.
    """
    known = clean_doubles(df, ["traffic_density", "ai_anomaly_score", "accident_probability"])
    return (
        known.filter(F.col("timestamp").isNotNull())
        .groupBy(hour_floor("timestamp").alias("timestamp_hour"))
        .agg(
            F.avg("traffic_density").alias("traffic_density"),
            F.avg("ai_anomaly_score").alias("ai_anomaly_score"),
            F.avg("accident_probability").alias("accident_probability"),
        )
        .na.drop("any")
        .orderBy("timestamp_hour")
    )


def scaled_trend(df: DataFrame) -> DataFrame:
    """Trend with the anomaly score rescaled x100 to share the density axis."""
    return hourly_trend(df).select(
        "timestamp_hour",
        "traffic_density",
        (F.col("ai_anomaly_score") * F.lit(100)).alias("ai_anomaly_x100"),
    )


def forecast(
    trend: DataFrame,
    periods: int = S.FORECAST_PERIODS,
    window: int = S.FORECAST_WINDOW,
) -> DataFrame:
    """Project density ``periods`` hours past the last observed hour.

    base = mean density of the last ``window`` hourly rows; momentum = mean of
    the last ``window`` first differences, which telescopes to
    (x_n - x_{n-k}) / k with k = min(window, n-1) (0 when n = 1). The value at
    step s is clamp(base + momentum * s, 0, 100).

    Only the ``window + 1`` latest rows (at most the 24 that the forecast looks back) of the (already aggregated, one row per
    hour) trend are used: a TakeOrderedAndProject, then a one-row aggregate
    whose list holds at most ``window + 1`` points. The steps are generated
    with ``explode(sequence)``, not a join.
    """
    latest = trend.select("timestamp_hour", "traffic_density").orderBy(
        F.desc("timestamp_hour")
    ).limit(min(window + 1, S.FORECAST_RECENT_ROWS))
    pts = latest.agg(
        F.sort_array(F.collect_list(F.struct("timestamp_hour", "traffic_density")), asc=False).alias("pts")
    )
    n = F.size("pts")
    k = F.least(n - F.lit(1), F.lit(window))
    head = F.slice("pts", 1, window)
    base = F.aggregate(head, F.lit(0.0), lambda acc, p: acc + p["traffic_density"]) / F.size(head)
    newest = F.element_at("pts", 1)
    momentum = F.when(
        k > 0,
        (newest["traffic_density"] - F.element_at("pts", k + 1)["traffic_density"]) / k,
    ).otherwise(F.lit(0.0))
    stats = pts.filter(n > 0).select(
        newest["timestamp_hour"].alias("last_hour"), base.alias("base"), momentum.alias("momentum")
    )
    steps = stats.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"))
    return steps.select(
        (F.col("last_hour") + F.make_dt_interval(F.lit(0), F.col("step"))).alias("timestamp_hour"),
        clamp(F.col("base") + F.col("momentum") * F.col("step"), S.FORECAST_MIN, S.FORECAST_MAX).alias(
            "forecast_density"
        ),
    )

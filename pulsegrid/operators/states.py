"""Partial aggregates: one grouped pass from which all bounded views of a dashboard follow.

The pass is one aggregate over GROUPING SETS, one set for each kind of view. It keeps no means but what means are made of,
sums and counts, which add up: the states of a zone's hours are its zone's, those of all zones the total, and
the states of two tables merge by adding them. The result has a row a group (zones x 24 hours, clock hours,
weathers, vehicle types, levels x bins), whatever the number of rows, and is written once; a view
reads its own rows of it.

Rows may be marked as seen but not kept (a dashboard's filter): they have no part in any sum, but their
zones, weathers and vehicle types are options to choose.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import hour_floor
from pulsegrid.operators.matrix import HOURS, hour_column

#: the columns that views average
MEASURES = ("traffic_density", "average_speed", "signal_wait_time", "accident_probability", "ai_anomaly_score")
#: kind of state -> its keys
SETS = {
    "zone_hour": ["city_zone", "hour"], "clock_hour": ["timestamp_hour"], "weather": ["weather_condition"],
    "vehicle_type": ["vehicle_type"], "speed_bin": ["congestion_level", "bin"],
}
_KEYS = [key for keys in SETS.values() for key in keys]
OPTIONS = {"city_zone": "zone_hour", "weather_condition": "weather", "vehicle_type": "vehicle_type"}


def partial_states(rows: DataFrame, speed_width: Column, kept: str | None = None) -> DataFrame:
    """The states of prepared rows: ``kind``, its keys, ``n`` rows (``seen`` with those not kept), sums and counts.

    ``speed_width`` is the width of the speed bins. ``kept`` names a boolean column, by default all rows count; the
    other columns of a row that is not kept must be NULL, but for the options.
    """
    keep = F.col(kept) if kept else F.lit(True)
    slim = rows.select(
        "city_zone", "weather_condition", "vehicle_type", "congestion_level", "hour", hour_floor("timestamp").alias("timestamp_hour"),
        F.floor(F.col("average_speed") / speed_width).alias("bin"), keep.alias("_kept"), *MEASURES, "vehicle_id", "is_high_congestion",
    )
    states = [F.count_if("_kept").alias("n"), F.count(F.lit(1)).alias("seen"), F.count("vehicle_id").alias("vehicles")]
    states += [F.count_if(F.col("_kept") & F.col("is_high_congestion")).alias("congested")]
    states += [F.sum(m).alias(f"sum_{m}") for m in MEASURES] + [F.count(m).alias(f"count_{m}") for m in MEASURES]
    grouped = slim.groupingSets([[F.col(k) for k in keys] for keys in SETS.values()], *[F.col(k) for k in _KEYS]).agg(F.grouping_id().alias("_gid"), *states)
    kind = F.lit(None).cast("string")
    for name, keys in SETS.items():
        # a bit for every key that a set leaves out, the first key's is the highest
        gid = sum(1 << (len(_KEYS) - 1 - i) for i, key in enumerate(_KEYS) if key not in keys)
        kind = F.when(F.col("_gid") == gid, F.lit(name)).otherwise(kind)
    return grouped.select(kind.alias("kind"), *[c for c in grouped.columns if c != "_gid"])


def merge_states(parts: Sequence[DataFrame]) -> DataFrame:
    """The states of several tables as those of all their rows; their speed bins must be of one width."""
    both = parts[0]
    for more in parts[1:]:
        both = both.unionByName(more)
    added = [c for c in both.columns if c not in ("kind", *_KEYS)]
    return both.groupBy("kind", *_KEYS).agg(*[F.sum(c).alias(c) for c in added])


def _mean(measure: str, where: str = "true") -> Column:
    """The mean that the states of a group make, as ``avg`` over its rows: NULL without any value."""
    return F.expr(f"try_divide(sum(sum_{measure}) FILTER (WHERE {where}), sum(count_{measure}) FILTER (WHERE {where}))")


def _of(states: DataFrame, kind: str) -> DataFrame:
    return states.filter((F.col("kind") == kind) & (F.col("n") > 0))


def kpis(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.aggregates.kpi_summary`."""
    n = F.sum("n")
    row = _of(states, "zone_hour").agg(
        n.cast("double").alias("total_vehicles"),
        (F.try_divide(F.sum("congested").cast("double"), n) * 100).alias("congestion_percentage"),
        _mean("ai_anomaly_score").alias("average_anomaly_score"),
        (_mean("accident_probability") * 100).alias("average_accident_probability"),
        _mean("average_speed").alias("average_speed"),
    )
    return row.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in row.columns])


def zones(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.aggregates.zone_summary`."""
    known = _of(states, "zone_hour").filter(F.col("city_zone").isNotNull())
    measures = ("traffic_density", "average_speed", "signal_wait_time", "accident_probability", "ai_anomaly_score")
    found = known.groupBy("city_zone").agg(*[_mean(m).alias(m) for m in measures], F.sum("vehicles").alias("vehicle_count"))
    return found.orderBy(F.desc_nulls_last("ai_anomaly_score"), F.asc("city_zone"))


def hotspots(states: DataFrame, limit: int = S.HOTSPOT_LIMIT) -> DataFrame:
    """As :func:`pulsegrid.operators.aggregates.accident_hotspots`."""
    known = _of(states, "zone_hour").filter(F.col("city_zone").isNotNull())
    found = known.groupBy("city_zone").agg(
        _mean("accident_probability").alias("accident_probability"), _mean("ai_anomaly_score").alias("ai_anomaly_score"), F.sum("congested").alias("is_high_congestion")
    )
    return found.orderBy(F.desc_nulls_last("accident_probability"), F.desc_nulls_last("ai_anomaly_score"), F.asc("city_zone")).limit(limit)


def heatmap(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.matrix.congestion_heatmap`."""
    known = _of(states, "zone_hour").filter(F.col("city_zone").isNotNull() & F.col("hour").isNotNull())
    cells = [F.coalesce(_mean("traffic_density", f"hour = {h}"), F.lit(0.0)).alias(hour_column(h)) for h in HOURS]
    return known.groupBy("city_zone").agg(*cells).orderBy("city_zone")


def weather(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.aggregates.weather_impact`."""
    known = _of(states, "weather").filter(F.col("weather_condition").isNotNull())
    return known.groupBy("weather_condition").agg(*[_mean(m).alias(m) for m in ("traffic_density", "accident_probability")])


def vehicle_types(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.aggregates.vehicle_type_distribution`."""
    counts = _of(states, "vehicle_type").filter(F.col("vehicle_type").isNotNull()).groupBy("vehicle_type").agg(F.sum("n").alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("vehicle_type", "count", (F.col("count") / total).alias("share")).orderBy(F.desc("count"), F.asc("vehicle_type"))


def trend(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.timeseries.hourly_trend`."""
    known = _of(states, "clock_hour").filter(F.col("timestamp_hour").isNotNull())
    means = [_mean(m).alias(m) for m in ("traffic_density", "ai_anomaly_score", "accident_probability")]
    return known.groupBy("timestamp_hour").agg(*means).na.drop("any").orderBy("timestamp_hour")


def histogram(states: DataFrame, speed_width: Column) -> DataFrame:
    """As :func:`pulsegrid.operators.matrix.nice_histogram` of the speed."""
    known = _of(states, "speed_bin").filter(F.col("congestion_level").isNotNull() & F.col("bin").isNotNull())
    counts = known.groupBy("congestion_level", "bin").agg(F.sum("n").alias("n"))
    start = (F.col("bin") * speed_width).alias("bin_start")
    return counts.select("congestion_level", "bin", start, speed_width.alias("bin_width"), "n").orderBy("congestion_level", "bin")


def options(states: DataFrame) -> DataFrame:
    """As :func:`pulsegrid.operators.ranking.filter_options`: of all rows seen."""
    out = None
    for dimension, kind in OPTIONS.items():
        some = states.filter((F.col("kind") == kind) & F.col(dimension).isNotNull()).select(F.lit(dimension).alias("dimension"), F.col(dimension).alias("option"))
        out = some if out is None else out.union(some)
    return out.distinct().orderBy("dimension", "option")

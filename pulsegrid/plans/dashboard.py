"""The dashboard query set over one filtered telemetry table.

One pass over the source writes the prepared rows as Parquet under the shared checkpoint folder: rows that the
filter keeps as they are, the others with nothing but the values that filters can choose from. One pass
over that copy makes the partial aggregates of every bounded view (:mod:`pulsegrid.operators.states`), which are
written too; the views read that small table. Only the filtered rows themselves and the top
anomalies read the copy, when they are asked for. No cache to lose with an executor.

With ``materialize=False`` nothing is written: every view is a plan of its own over the source, into whose scan
Catalyst pushes the filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions.columns import q
from pulsegrid.operators import aggregates as A
from pulsegrid.operators import states as T
from pulsegrid.operators.matrix import congestion_heatmap, nice_histogram, nice_width
from pulsegrid.operators.prepare import PREPARED_COLUMNS, filter_telemetry, prepare_telemetry
from pulsegrid.operators.ranking import filter_options, top_anomalies
from pulsegrid.operators.timeseries import forecast, hourly_trend
from pulsegrid.session import observed, shared_scratch_path
from pulsegrid.sources import files

#: marks the rows of the copy that the filter keeps
KEPT = "_dashboard_kept"


def load_telemetry(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Read the telemetry CSV with its explicit schema and add the prepared columns.

    With ``keep_corrupt`` the raw line of each malformed row stays in ``_corrupt_record``;
    :func:`pulsegrid.sources.files.corrupt_rows` counts them.
    """
    return prepare_telemetry(files.read_csv(spark, path, S.TRAFFIC_SCHEMA, keep_corrupt=keep_corrupt))


def dashboard(
    traffic: DataFrame,
    zones: Sequence[str] = (),
    weather: Sequence[str] = (),
    vehicle_types: Sequence[str] = (),
    congestion_levels: Sequence[str] = (),
    materialize: bool = True,
) -> dict[str, DataFrame]:
    """All dashboard views over the filtered table, as lazy DataFrames keyed by view name.

    ``traffic`` may be the plain telemetry or what :func:`load_telemetry` returns.
    """
    prepared = traffic if set(PREPARED_COLUMNS) <= set(traffic.columns) else prepare_telemetry(traffic)
    if materialize:
        return _from_states(prepared, zones, weather, vehicle_types, congestion_levels)
    filtered = filter_telemetry(prepared, zones, weather, vehicle_types, congestion_levels)
    trend = hourly_trend(filtered)
    zones_df = A.zone_summary(filtered)
    return _named(
        filter_options(prepared), filtered, A.kpi_summary(filtered), trend, A.vehicle_type_distribution(filtered), congestion_heatmap(filtered),
        A.accident_hotspots(filtered), A.weather_impact(filtered), nice_histogram(filtered), zones_df,
    )


def _named(options, filtered, kpis, trend, vehicle_types, heatmap, hotspots, weather, histogram, zones) -> dict[str, DataFrame]:
    return {
        "filter_options": options, "filtered": filtered, "kpis": kpis, "trend": trend,
        "trend_scaled": trend.select("timestamp_hour", "traffic_density", (F.col("ai_anomaly_score") * 100).alias("ai_anomaly_x100")),
        "forecast": forecast(trend), "vehicle_types": vehicle_types, "heatmap": heatmap, "hotspots": hotspots, "weather": weather,
        "speed_histogram": histogram, "zones": zones, "top_anomalies": top_anomalies(filtered), "top_zones": zones.limit(S.TOP_ZONE_LIMIT),
    }


def _from_states(prepared: DataFrame, *filters: Sequence[str]) -> dict[str, DataFrame]:
    """The views from one pass over the rows and one over their copy."""
    spark = prepared.sparkSession
    kept = F.lit(True)
    for column, values in zip(("city_zone", "weather_condition", "vehicle_type", "congestion_level"), filters, strict=True):
        if values:
            kept = kept & F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    marked = prepared.withColumn(KEPT, kept)
    rest = [c if c in T.OPTIONS or c == KEPT else F.when(F.col(KEPT), F.col(q(c))).alias(c) for c in marked.columns]
    ends = Observation("speed_range")
    speed = F.when(F.col("congestion_level").isNotNull(), F.col("average_speed"))
    copied = marked.select(*rest).observe(ends, F.min(speed).alias("lo"), F.max(speed).alias("hi"))
    path, states_path = shared_scratch_path(spark, "dashboard"), shared_scratch_path(spark, "dashboard-states")
    files.write_parquet(copied, path)
    copy = files.read_parquet(spark, path, copied.schema)
    found = observed(ends, lambda: {"lo": None, "hi": None})
    width = nice_width(*[F.lit(found[c]).cast("double") for c in ("lo", "hi")])
    files.write_parquet(T.partial_states(copy, width, KEPT), states_path)
    states = files.read_parquet(spark, states_path)
    return _named(
        T.options(states), copy.filter(KEPT).drop(KEPT), T.kpis(states), T.trend(states), T.vehicle_types(states), T.heatmap(states),
        T.hotspots(states), T.weather(states), T.histogram(states, width), T.zones(states),
    )

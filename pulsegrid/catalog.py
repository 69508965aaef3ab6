"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the whole ``traffic`` / ``icu`` inputs (projections of the
shared ``events`` / ``orders`` tables); no row caps, id subsets or samples. The
only limits are the top-k features themselves.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import columns as C
from pulsegrid.operators import aggregates as A
from pulsegrid.operators import lookup as L
from pulsegrid.operators.matrix import congestion_heatmap, nice_histogram, speed_histogram
from pulsegrid.operators.prepare import filter_telemetry, prepare_telemetry, preprocess_icu, type_traffic
from pulsegrid.operators.ranking import filter_options, top_anomalies
from pulsegrid.operators.slices import split_by_values, union_batches
from pulsegrid.operators.timeseries import forecast, hourly_trend, scaled_trend
from pulsegrid.plans.dashboard import dashboard, load_telemetry
from pulsegrid.plans.icu_job import preprocess_icu_sliced
from pulsegrid.plans.incremental import curate_increment, read_curated
from pulsegrid.plans.traffic_job import curate_traffic, release_traffic_job, run_stats_frame, run_traffic_job, top_risk_report
from pulsegrid.session import shared_scratch_path
from pulsegrid.sources import files
from pulsegrid.sources.fixtures import icu, traffic
from pulsegrid.sources.releases import Releases

Query = Callable[[SparkSession, str], DataFrame]

# Fixed arguments of the filter query
FILTER_ZONES = ["Metro Central", "Neon North"]
FILTER_WEATHER = ["Rain", "Storm"]
FILTER_LEVELS = ["High", "Critical"]
# The batch used by the union query: these units form batch one, all others batch two
UNION_FIRST_UNITS = ["Cardiac ICU", "Neuro ICU", "Trauma ICU"]


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_telemetry(traffic(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_traffic(traffic(spark, sf_dir))


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_telemetry(
        _prepared(spark, sf_dir),
        zones=FILTER_ZONES,
        weather=FILTER_WEATHER,
        congestion_levels=FILTER_LEVELS,
    )


def _icu_preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess_icu_sliced(icu(spark, sf_dir))


def _icu_unsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ICU transform without slice ids: unit rates and KPIs do not depend on the
    slices, so these keys skip the ranking (and its materialisation) altogether."""
    return preprocess_icu(icu(spark, sf_dir))


def _icu_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = split_by_values(icu(spark, sf_dir), "icu_unit", UNION_FIRST_UNITS)
    return union_batches([preprocess_icu(first), preprocess_icu(second)])


def _round_trip_csv(df: DataFrame, schema, name: str) -> DataFrame:
    spark = df.sparkSession
    path = shared_scratch_path(spark, name)
    files.write_csv(df, path)
    return files.read_csv(spark, path, schema)


def _round_trip_parquet(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = shared_scratch_path(spark, name)
    files.write_parquet(df, path)
    return files.read_parquet(spark, path)


def _run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_scratch_path(spark, "traffic-job")
    stats = run_traffic_job(
        spark,
        traffic(spark, sf_dir),
        summary_path=os.path.join(root, "summary"),
        anomaly_path=os.path.join(root, "anomalies"),
        curated_dir=os.path.join(root, "curated"),
    )
    return run_stats_frame(spark, stats)


def _curated_in_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table from two increments: the days of the first half of the time that the input spans, then the others."""
    rows = traffic(spark, sf_dir)
    day = F.to_date("timestamp")
    middle = rows.agg(F.date_add(F.min(day), F.floor(F.date_diff(F.max(day), F.min(day)) / 2).cast("int"))).first()[0]
    root = shared_scratch_path(spark, "increments")
    later = F.coalesce(day > F.lit(middle), F.lit(False))
    for part in (rows.filter(~later), rows.filter(later)):
        curate_increment(part, f"{root}/curated", f"{root}/tails")
    return read_curated(spark, f"{root}/curated").drop("event_date")


def _released_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile that the current release of the traffic job holds."""
    root = shared_scratch_path(spark, "traffic-releases")
    release_traffic_job(spark, traffic(spark, sf_dir), root)
    return files.read_summary_csv(spark, Releases(spark, root).current()["outputs"]["summary"])


def _dashboard_view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the dashboard with the filters of ``telemetry_filter``, from the states of one pass; doubles to nine digits, as sums of sums differ in the last."""
    view = dashboard(traffic(spark, sf_dir), zones=FILTER_ZONES, weather=FILTER_WEATHER, congestion_levels=FILTER_LEVELS)[name]
    return view.select(*[F.round(c, 9).alias(c) if kind == "double" else F.col(c) for c, kind in view.dtypes])


def _through_csv(df: DataFrame, name: str) -> str:
    """Write ``df`` as CSV to a scratch folder and return its path."""
    path = shared_scratch_path(df.sparkSession, name)
    files.write_csv(df, path)
    return path


def _with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic input with NaN in every 97th row's measurements."""
    hit = F.substring("vehicle_id", 5, 20).cast("long") % 97 == 0
    columns = ["traffic_density", "average_speed", "accident_probability", "ai_anomaly_score"]
    return traffic(spark, sf_dir).withColumns({c: F.when(hit, F.lit(float("nan"))).otherwise(F.col(c)) for c in columns})


def _corrupt_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rows of the traffic input as CSV with every 97th speed unreadable."""
    text = traffic(spark, sf_dir)
    hit = F.substring("vehicle_id", 5, 20).cast("long") % 97 == 0
    text = text.withColumn("average_speed", F.when(hit, F.lit("fast?")).otherwise(F.col("average_speed").cast("string")))
    return files.corrupt_rows(load_telemetry(spark, _through_csv(text, "corrupt"), keep_corrupt=True))


def _slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per slice, counted from the slice ids of the ranked rows."""
    counts = _icu_preprocessed(spark, sf_dir).groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"))
    slices = spark.range(1, S.ICU_DEFAULT_SLICES + 1).select(F.col("id").cast("int").alias("partition_id"))
    return slices.join(counts, "partition_id", "left").select("partition_id", F.coalesce("n", F.lit(0)).cast("long").alias("rows"))


QUERIES: dict[str, Query] = {
    # dashboard operators
    "telemetry_prepare": _prepared,
    "telemetry_filter": _filtered,
    "filter_options": lambda s, d: filter_options(traffic(s, d)),
    "kpi_summary": lambda s, d: A.kpi_summary(_prepared(s, d)),
    "accident_hotspots": lambda s, d: A.accident_hotspots(_prepared(s, d)),
    "zone_summary": lambda s, d: A.zone_summary(_prepared(s, d)),
    "top_anomaly_zones": lambda s, d: A.top_anomaly_zones(_prepared(s, d)),
    "congestion_trend_hourly": lambda s, d: hourly_trend(traffic(s, d)),
    "congestion_trend_scaled": lambda s, d: scaled_trend(traffic(s, d)),
    "traffic_forecast": lambda s, d: forecast(hourly_trend(traffic(s, d))),
    "top_anomalies": lambda s, d: top_anomalies(_prepared(s, d)),
    "vehicle_type_distribution": lambda s, d: A.vehicle_type_distribution(_prepared(s, d)),
    "congestion_heatmap": lambda s, d: congestion_heatmap(_prepared(s, d)),
    "weather_impact": lambda s, d: A.weather_impact(_prepared(s, d)),
    "speed_histogram": lambda s, d: speed_histogram(_prepared(s, d)),
    "nice_histogram_speed": lambda s, d: nice_histogram(_prepared(s, d)),
    "nice_histogram_anomaly": lambda s, d: nice_histogram(_prepared(s, d), "ai_anomaly_score", "weather_condition"),
    # the dashboard from its partial aggregates, over the filtered rows
    **{f"dashboard_{name}": partial(_dashboard_view, name) for name in ("kpis", "zones", "trend", "heatmap", "filter_options", "speed_histogram")},
    # traffic batch job
    "tppp_typed": _typed,
    "tppp_curated": lambda s, d: curate_traffic(traffic(s, d)),
    "tppp_curated_increments": _curated_in_two,
    "tppp_released_summary": _released_summary,
    "tppp_zone_weather_summary": lambda s, d: A.zone_weather_profile(_typed(s, d)),
    "tppp_top_anomalies": lambda s, d: top_risk_report(traffic(s, d)),
    "tppp_run_stats": _run_stats,
    # ICU batch job
    "icu_preprocessed": _icu_preprocessed,
    "icu_unit_alert_rates": lambda s, d: A.icu_unit_alert_rates(_icu_unsliced(s, d)),
    "icu_batch_summary": lambda s, d: A.icu_batch_summary(_icu_unsliced(s, d)),
    "icu_slice_profile": lambda s, d: A.icu_slice_profile(icu(s, d)),
    "icu_union_batches": _icu_union,
    # scoring rules and the condition lookup
    "congestion_band": lambda s, d: traffic(s, d).select(
        "vehicle_id", "timestamp", "traffic_density", C.congestion_band().alias("congestion_band")
    ),
    "peak_hour_factor": lambda s, d: L.peak_hour_factors(traffic(s, d)),
    "condition_pressure_lookup": lambda s, d: L.condition_pressure_lookup(traffic(s, d)),
    "accident_risk_score": lambda s, d: L.accident_risk_scores(traffic(s, d)),
    "anomaly_score": lambda s, d: L.anomaly_scores(traffic(s, d)),
    "icu_severity_score": lambda s, d: icu(s, d).select(
        "patient_id",
        C.icu_severity_score().alias("severity_score"),
        (C.icu_severity_score() >= F.lit(S.CRITICAL_RISK_THRESHOLD)).alias("is_critical"),
    ),
    "icu_slice_counts": _slice_counts,
    # CSV sources: the input as CSV files, through the public readers
    "source_csv_traffic": lambda s, d: load_telemetry(s, _through_csv(traffic(s, d), "traffic-csv")),
    "source_csv_icu": lambda s, d: preprocess_icu(files.read_icu_csv(s, _through_csv(icu(s, d), "icu-csv"))),
    "source_csv_corrupt_count": _corrupt_count,
    # missing measurements that arrive as NaN
    "kpi_summary_nan": lambda s, d: A.kpi_summary(prepare_telemetry(_with_nan(s, d))),
    "congestion_trend_nan": lambda s, d: hourly_trend(_with_nan(s, d)),
    "speed_histogram_nan": lambda s, d: speed_histogram(_with_nan(s, d)),
    "top_anomalies_nan": lambda s, d: top_anomalies(_with_nan(s, d)),
    # sinks: write with Spark, read back with the explicit schema
    "sink_csv_filtered": lambda s, d: _round_trip_csv(_filtered(s, d), S.PREPARED_SCHEMA, "filtered"),
    "sink_csv_icu": lambda s, d: _round_trip_csv(_icu_preprocessed(s, d), S.ICU_PREPROCESSED_SCHEMA, "icu"),
    "sink_csv_tppp_summary": lambda s, d: _round_trip_csv(
        A.zone_weather_profile(_typed(s, d)), S.SUMMARY_SCHEMA, "summary"
    ),
    "sink_csv_tppp_anomalies": lambda s, d: _round_trip_csv(
        top_risk_report(traffic(s, d)), S.ANOMALIES_SCHEMA, "anomalies"
    ),
    "sink_parquet_curated": lambda s, d: _round_trip_parquet(curate_traffic(traffic(s, d)), "curated"),
}

"""The traffic batch job: typed columns, rolling zone features, profile, top-k, sinks.

Differences from a "cache, collect, write with pandas" job, all for scale:

* the caller owns the session; the input schema is explicit (no inference pass);
* the curated table is written once as Parquet (the only full pass over the
  input), and the zone/weather profile and the top-risk export are computed from
  that written table: they read only the columns they need, the window is never
  recomputed, and no cache block can be lost with an executor;
* every output is written by Spark writers; the two small reports go through
  one task each (their size is bounded by the group domain and by the limit);
* row counts come from ``DataFrame.observe`` on the passes that already run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.aggregates import zone_weather_profile
from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.ranking import top_risk_events
from pulsegrid.operators.rolling import rolling_zone_features, rows_for_targets
from pulsegrid.session import observed, remove_path, shared_scratch_path
from pulsegrid.sources import files
from pulsegrid.sources.releases import Releases

#: distinct vehicle ids to expect in a row group, at most
LOOKED_UP = 1_000_000


def curate_traffic(traffic: DataFrame, path: str | None = None) -> DataFrame:
    """Typed columns plus the rolling zone features (the curated table).

    Building it runs a job that writes the ordered rows to ``path`` (see :mod:`pulsegrid.operators.rolling`).
    """
    return rolling_zone_features(type_traffic(traffic), path=path)


def top_risk_report(traffic: DataFrame, limit: int = S.PIPELINE_ANOMALY_LIMIT, path: str | None = None) -> DataFrame:
    """The top-``limit`` risk events with their rolling zone features, without curating every row.

    The ranking keys (risk index, anomaly score, time, id) do not depend on the
    rolling features, so the top rows are picked first (TakeOrderedAndProject
    over the typed rows). Only the rows that their frames can reach are written and then put in
    order and rolled over, in as many ranges as they fill; the top-``limit`` of those is the
    global top-``limit``. Building the report runs these jobs; ``path`` is where the ordered rows go.
    """
    spark = traffic.sparkSession
    typed = type_traffic(traffic)
    candidates = top_risk_events(typed, limit, columns=["city_zone", "event_timestamp", "vehicle_id"])
    reached = rows_for_targets(typed, candidates)
    # the optimizer takes them for as many as all rows; their files say how many they are
    rows_path = shared_scratch_path(spark, "reached")
    files.write_parquet(reached, rows_path)
    return top_risk_events(rolling_zone_features(files.read_parquet(spark, rows_path, reached.schema), path=path), limit)


def run_traffic_job(
    spark: SparkSession,
    source: str | DataFrame,
    summary_path: str,
    anomaly_path: str,
    curated_dir: str,
    anomaly_limit: int = S.PIPELINE_ANOMALY_LIMIT,
    partition_curated_by: list[str] | None = None,
    keep_scratch: bool = False,
) -> dict[str, object]:
    """Run the job end to end; return row counts, output paths and a log.

    A CSV source (a path) is parsed once: read PERMISSIVE with its schema and
    staged as Parquet under the shared checkpoint folder, counting rows and
    malformed rows (``corrupt_rows``) in that same pass. Ordering the rows (a sample for the
    range bounds, then the shuffle) reads that copy. The staged copy and the ordered rows are
    removed once the curated table is written (unless ``keep_scratch``).

    The curated files are in order of zone and time within a file and have Bloom filters on the vehicle id, so filters on zone and
    time and look-ups of a vehicle skip row groups and pages.

    Each output replaces what stood at its path, one after the other; :func:`release_traffic_job` replaces all at once.
    """
    input_obs = Observation("traffic_input")
    staged_path = None
    if isinstance(source, str):
        raw = files.read_csv(spark, source, S.TRAFFIC_SCHEMA, keep_corrupt=True)
        counted = raw.observe(
            input_obs,
            F.count(F.lit(1)).alias("rows"),
            F.count(F.col(files.CORRUPT_COLUMN)).alias("corrupt"),
        ).drop(files.CORRUPT_COLUMN)
        staged_path = shared_scratch_path(spark, "traffic-staged")
        files.write_parquet(counted, staged_path)
        staged = files.read_parquet(spark, staged_path, S.TRAFFIC_SCHEMA)
        seen = observed(input_obs, lambda: {"rows": staged.count(), "corrupt": 0})
    else:
        staged, seen = source, None
    logs: list[str] = []

    ordered_path = shared_scratch_path(spark, "traffic-ordered")
    curated = curate_traffic(staged, path=ordered_path)
    # unpartitioned rows come in order of zone, range and time already
    files.write_parquet(
        curated, curated_dir, partition_by=partition_curated_by, spread_by=[F.to_date("event_timestamp")],
        sort_by=["city_zone", "event_timestamp"] if partition_curated_by else (), bloom={"vehicle_id": LOOKED_UP},
    )
    if seen is None:  # every input row is a curated row; Parquet knows their number from its footers
        seen = {"rows": files.read_parquet(spark, curated_dir).count()}
    input_rows, corrupt_rows = int(seen["rows"]), int(seen.get("corrupt", 0))
    for path in [] if keep_scratch else filter(None, [staged_path, ordered_path]):
        remove_path(spark, path)
    logs.append(f"read {input_rows:,} traffic records ({corrupt_rows:,} malformed) and wrote {curated_dir}")

    stored = files.read_parquet(spark, curated_dir)

    summary_obs = Observation("traffic_summary")
    summary = zone_weather_profile(stored).observe(summary_obs, F.count(F.lit(1)).alias("rows"))
    files.write_csv(summary, summary_path, single_file=True)
    logs.append(f"wrote the zone/weather profile to {summary_path}")

    anomaly_obs = Observation("traffic_anomalies")
    anomalies = top_risk_events(stored, anomaly_limit).observe(anomaly_obs, F.count(F.lit(1)).alias("rows"))
    files.write_csv(anomalies, anomaly_path, single_file=True)
    logs.append(f"wrote the top {anomaly_limit} risk events to {anomaly_path}")

    return {
        "input_rows": input_rows,
        "corrupt_rows": corrupt_rows,
        "summary_rows": int(observed(summary_obs, lambda: {"rows": load_summary(spark, summary_path).count()})["rows"]),
        "anomaly_rows": int(observed(anomaly_obs, lambda: {"rows": load_anomalies(spark, anomaly_path).count()})["rows"]),
        "summary_path": summary_path,
        "anomaly_path": anomaly_path,
        "curated_output_dir": curated_dir,
        "logs": logs,
    }


def release_traffic_job(spark: SparkSession, source: str | DataFrame, root: str, keep: int = 2, **options) -> dict[str, object]:
    """:func:`run_traffic_job` into a new version below ``root``, published when all outputs stand.

    Returns the job's stats and the release's ``number``. The last ``keep`` releases stay; if the job fails, all stay and none is
    added. ``options`` go to the job.
    """
    releases = Releases(spark, root)
    with releases.new() as version:
        paths = {"summary": f"{version}/summary", "anomalies": f"{version}/anomalies", "curated": f"{version}/curated"}
        stats = run_traffic_job(spark, source, paths["summary"], paths["anomalies"], paths["curated"], **options)
        noted = {k: stats[k] for k in ("input_rows", "corrupt_rows", "summary_rows", "anomaly_rows")}
        number = releases.publish(version, paths, **noted)
    releases.retire(keep)
    return stats | {"number": number}


def load_summary(spark: SparkSession, path: str) -> DataFrame:
    """Read a written zone/weather profile with its schema."""
    return files.read_summary_csv(spark, path)


def load_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """Read a written top-risk export with its schema."""
    return files.read_anomalies_csv(spark, path)


def run_stats_frame(spark: SparkSession, stats: dict[str, object]) -> DataFrame:
    """The job's three counts as a one-row DataFrame."""
    return spark.createDataFrame(
        [(stats["input_rows"], stats["summary_rows"], stats["anomaly_rows"])],
        "input_rows bigint, summary_rows bigint, anomaly_rows bigint",
    )

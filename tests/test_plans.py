"""Physical-plan checks: the plans we want at scale, not just the right rows."""

from __future__ import annotations

import os

import pytest

from pulsegrid.catalog import QUERIES
from pulsegrid.operators.prepare import filter_telemetry, prepare_telemetry
from pulsegrid.operators.aggregates import kpi_summary
from pulsegrid.plans.traffic_job import curate_traffic
from pulsegrid.sources import files
from pulsegrid.sources.fixtures import traffic
from support import SF_DIRS, fresh_dir

SF = SF_DIRS["0.001"]
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# these keys write files when built; their plans are checked through the source keys
SIDE_EFFECT_KEYS = {"tppp_run_stats"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECT_KEYS))
def test_no_python_evaluation_or_cross_join_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES), text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, text


@pytest.mark.parametrize("name", ["top_anomalies", "tppp_top_anomalies", "accident_hotspots", "top_anomaly_zones"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["condition_pressure_lookup", "accident_risk_score"])
def test_condition_lookup_is_broadcast(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def _parquet_traffic(spark):
    path = os.path.join(fresh_dir("pg-parquet-"), "traffic")
    files.write_parquet(traffic(spark, SF), path)
    return files.read_parquet(spark, path)


def test_filter_and_projection_reach_the_scan(spark):
    df = _parquet_traffic(spark)
    filtered = filter_telemetry(prepare_telemetry(df), zones=["Neon North"], congestion_levels=["High"])
    text = plan(filtered.select("vehicle_id", "hour"))
    assert "PushedFilters: [In(city_zone" in text or "PushedFilters: [IsNotNull(city_zone)" in text
    assert "city_zone" in text and "congestion_level" in text
    kpi_text = plan(kpi_summary(prepare_telemetry(df)))
    read_schema = kpi_text.split("ReadSchema: ")[1].split("\n")[0]
    for unused in ("vehicle_type", "weather_condition", "road_condition", "signal_wait_time"):
        assert unused not in read_schema, read_schema


def test_rolling_window_is_partitioned_by_zone_and_range(spark):
    text = plan(curate_traffic(traffic(spark, SF)))
    assert "hashpartitioning(_zk" in text and "_range" in text
    windows = [line for line in text.splitlines() if line.strip().startswith(("+- Window", "Window", ":- Window"))]
    assert windows, text
    # no window over the data rows partitioned by the zone alone
    assert "Window [avg(" not in text


def test_rolling_rows_are_shuffled_once(spark):
    """After the ordered write only the tails and the halo move: no exchange has a data column but theirs below it."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        lines = plan(curate_traffic(traffic(spark, SF))).splitlines()
    finally:
        spark.conf.set(threshold, before)
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    exchanges = [k for k, line in enumerate(lines) if "Exchange" in line]
    assert len(exchanges) == 2
    for k in exchanges:
        below = []
        for line in lines[k + 1 :]:
            if indent(line) <= indent(lines[k]):
                break
            below.append(line)
        # what is exchanged has passed the limit to the last rows of each range
        assert any("row_number() " in line and "Filter" not in line for line in below) and any("Filter (_rn" in line for line in below)
    assert sum("FileScan" in line and "Bucketed: true" in line for line in lines) == 2


def test_partitioned_curated_output_prunes_partitions(spark):
    from pyspark.sql import functions as F

    from pulsegrid.plans.traffic_job import run_traffic_job

    root = fresh_dir("pg-partitioned-")
    stats = run_traffic_job(
        spark,
        traffic(spark, SF),
        summary_path=os.path.join(root, "summary"),
        anomaly_path=os.path.join(root, "anomalies"),
        curated_dir=os.path.join(root, "curated"),
        partition_curated_by=["city_zone"],
    )
    assert sorted(p for p in os.listdir(stats["curated_output_dir"]) if p.startswith("city_zone="))
    one_zone = files.read_parquet(spark, stats["curated_output_dir"]).filter(F.col("city_zone") == "Neon North")
    text = plan(one_zone)
    assert "PartitionFilters: [isnotnull(city_zone" in text and "Neon North" in text.split("PartitionFilters")[1]
    assert one_zone.count() == traffic(spark, SF).filter(F.col("city_zone") == "Neon North").count()


def test_heatmap_has_one_shuffle_and_summary_no_expand(spark):
    heat = plan(QUERIES["congestion_heatmap"](spark, SF))
    assert heat.count("Exchange hashpartitioning") == 1
    assert "Expand" not in plan(QUERIES["icu_batch_summary"](spark, SF))

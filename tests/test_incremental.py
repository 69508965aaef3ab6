"""Increments equal one run, and leave what is curated alone; releases replace all outputs or none; curated files let scans skip."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.rolling import rolling_zone_features
from pulsegrid.plans import icu_job
from pulsegrid.plans.incremental import curate_increment, read_curated, read_tails
from pulsegrid.plans.traffic_job import curate_traffic, release_traffic_job
from pulsegrid.sources import files
from pulsegrid.sources.fixtures import icu, traffic
from pulsegrid.sources.releases import Releases
from support import SF_DIRS, fresh_dir


def _files(path):
    """Every data file below a folder, with its size and time."""
    return {f"{d}/{n}": (os.stat(f"{d}/{n}").st_size, os.stat(f"{d}/{n}").st_mtime_ns) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def _of_day(files_, days):
    return {k: v for k, v in files_.items() if any(f"event_date={d}" in k for d in days)}


def _same(got, want):
    got = got.select(*want.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_two_increments_equal_one_run(spark):
    rows = traffic(spark, SF_DIRS["0.01"])
    day = F.to_date("timestamp")
    days = [r[0] for r in rows.select(day).distinct().orderBy(day).collect()]
    one, two = days[:3], days[3:5]
    root = fresh_dir("pg-increments-")
    assert curate_increment(rows.filter(day.isin(one)), f"{root}/c", f"{root}/t") == one[-1]
    before, tails = _files(f"{root}/c"), _files(f"{root}/t")
    assert curate_increment(rows.filter(day.isin(two)), f"{root}/c", f"{root}/t") == two[-1]
    after = _files(f"{root}/c")
    assert _of_day(after, one) == before and tails.items() <= _files(f"{root}/t").items()
    whole = curate_traffic(rows.filter(day.isin(one + two)))
    assert _same(read_curated(spark, f"{root}/c").drop("event_date"), whole)
    # the second increment again: the same rows, and the first one still as it was
    assert curate_increment(rows.filter(day.isin(two)), f"{root}/c", f"{root}/t") == two[-1]
    assert _of_day(_files(f"{root}/c"), one) == before
    assert _same(read_curated(spark, f"{root}/c").drop("event_date"), whole)
    # days before or into what is curated are refused
    for bad in (one, one[-1:] + two[:1]):
        with pytest.raises(ValueError):
            curate_increment(rows.filter(day.isin(bad)), f"{root}/c", f"{root}/t")


TRAFFIC = (
    "vehicle_id string, timestamp timestamp_ntz, city_zone string, vehicle_type string, traffic_density double, average_speed double, weather_condition string,"
    " road_condition string, signal_wait_time double, accident_probability double, congestion_level string, ai_anomaly_score double"
)


def _rows(spark, items):
    """Rows from (id, time, zone, density)."""
    return spark.createDataFrame([(i, t, z, "Car", d, 40.0 if d is None else d / 2, "Clear", "Smooth", 30.0, 0.1, "High", 0.5) for i, t, z, d in items], TRAFFIC)


def test_zones_that_pause_and_rows_without_time_or_zone(spark):
    """A zone absent for an increment keeps its tail; NULL zones and times are as in one run."""
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    first = [(f"a{k}", at(1, k), "A", float(k)) for k in range(8)] + [(f"n{k}", None, "A", 50.0 + k) for k in range(2)] + [("b", at(1, 5), "B", 9.0), ("z", at(1, 2), None, 3.0)]
    second = [(f"c{k}", at(2, k), "B", None if k == 1 else float(k)) for k in range(3)]
    third = [(f"d{k}", at(3, k), "A", 10.0 + k) for k in range(3)] + [("z2", at(3, 2), None, 4.0), ("b2", at(3, 2), "B", 7.0)]
    root = fresh_dir("pg-increments-")
    for part in (first, second, third):
        curate_increment(_rows(spark, part), f"{root}/c", f"{root}/t")
    assert curate_increment(_rows(spark, []), f"{root}/c", f"{root}/t") is None
    whole = rolling_zone_features(type_traffic(_rows(spark, first + second + third)))
    assert _same(read_curated(spark, f"{root}/c").drop("event_date"), whole)
    sizes = {(r["through"], r["city_zone"]): r["count"] for r in read_tails(spark, f"{root}/t").groupBy("through", "city_zone").count().collect()}
    assert sizes[dt.date(2024, 1, 2), "A"] == 5 and sizes[dt.date(2024, 1, 2), "B"] == 4 and sizes[dt.date(2024, 1, 3), None] == 2
    with pytest.raises(ValueError):
        curate_increment(_rows(spark, [("late", None, "A", 1.0)]), f"{root}/c", f"{root}/t")


def _contents(spark, release):
    read = {"curated": files.read_parquet, "summary": files.read_summary_csv, "anomalies": files.read_anomalies_csv}
    return {name: sorted(map(str, read[name](spark, path).collect())) for name, path in release["outputs"].items()}


def test_a_failed_run_leaves_the_old_release(spark, monkeypatch):
    root = fresh_dir("pg-releases-") + "/r"
    rows = traffic(spark, SF_DIRS["0.001"])
    releases = Releases(spark, root)
    assert releases.current() is None
    assert release_traffic_job(spark, rows, root)["number"] == 1
    first = releases.current()
    old = _contents(spark, first)
    assert all(old.values()) and first["input_rows"] == rows.count()

    write, calls = files.write_csv, []

    def fails_at_the_second(*args, **options):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("disk full")
        return write(*args, **options)

    monkeypatch.setattr(files, "write_csv", fails_at_the_second)
    with pytest.raises(RuntimeError):
        release_traffic_job(spark, rows.limit(50), root)
    monkeypatch.undo()
    assert releases.current() == first and os.listdir(f"{root}/versions") == [first["version"]]
    again = _contents(spark, first)
    assert again == old

    assert release_traffic_job(spark, rows.limit(50), root)["number"] == 2
    assert releases.current()["input_rows"] == 50 and releases.read(1) == first
    assert release_traffic_job(spark, rows.limit(40), root, keep=2)["number"] == 3
    assert releases.numbers() == [2, 3] and len(os.listdir(f"{root}/versions")) == 2


def test_release_numbers_are_never_taken_twice(spark):
    root = fresh_dir("pg-releases-") + "/r"
    a, b = Releases(spark, root), Releases(spark, root)
    assert [a.publish(f"{root}/versions/x", {"t": f"{root}/versions/x/t"}), b.publish(f"{root}/versions/y", {"t": f"{root}/versions/y/t"})] == [1, 2]
    assert a.current() == b.current() and a.current()["outputs"] == {"t": f"{root}/versions/y/t"}


def test_icu_release(spark):
    root = fresh_dir("pg-releases-") + "/r"
    written, report = icu_job.release_icu_job(spark, icu(spark, SF_DIRS["0.001"]), root)
    current = Releases(spark, root).current()
    assert report["number"] == current["number"] == 1 and current["kpis"] == report["kpis"]
    assert files.read_icu_preprocessed_csv(spark, current["outputs"]["preprocessed"]).count() == written.count()


def _scanned(df):
    """(rows of the result, rows that left the scan) of a DataFrame."""
    counted = df.agg(F.count("traffic_density").alias("n"))
    n = counted.collect()[0]["n"]
    plan = counted._jdf.queryExecution().executedPlan()
    leaf = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    while "FileSourceScan" not in leaf.getClass().getSimpleName():
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf.collectLeaves().apply(0)
    return n, leaf.metrics().apply("numOutputRows").value()


def test_filters_skip_row_groups_of_the_curated_files(spark):
    path = fresh_dir("pg-skip-") + "/curated"
    curated = curate_traffic(traffic(spark, SF_DIRS["0.1"]))
    files.write_parquet(curated, path, bloom={"vehicle_id": 20_000}, row_group_bytes=1 << 18)
    table = files.read_parquet(spark, path)
    total = table.count()
    wanted, read = _scanned(table.filter(F.col("city_zone").isin("Neon North", "Solaris South")))
    assert wanted <= read < 1.3 * wanted < total
    one = table.filter(F.col("city_zone") == "Neon North").select(F.max("vehicle_id")).first()[0]
    wanted, read = _scanned(table.filter(F.col("vehicle_id") == one))
    assert wanted == 1 and read < total // 20


def test_a_hot_zone_is_several_files(spark):
    """Rebalanced rows of one zone and day are cut where there are many, and small ones share a file."""
    path = fresh_dir("pg-rebalance-") + "/t"
    rows = traffic(spark, SF_DIRS["0.1"]).withColumn("city_zone", F.when(F.crc32("vehicle_id") % 10 > 0, "hot").otherwise("cold")).repartition(8)
    files.write_parquet(rows, f"{path}-source")  # eight files: eight tasks to deal from
    rows = files.read_parquet(spark, f"{path}-source")
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.files.openCostInBytes": "64m"}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        files.write_parquet(rows, path, partition_by=["city_zone"], sort_by=["timestamp"])
    finally:
        for k in wanted:
            spark.conf.unset(k)
    hot, cold = (len([n for n in os.listdir(f"{path}/city_zone={z}") if n.endswith(".parquet")]) for z in ("hot", "cold"))
    assert hot > 3 and cold < hot and _same(files.read_parquet(spark, path), rows)

"""The scalable window operators equal their single-partition definitions."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid import session
from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.rolling import _ranged, rolling_means, rolling_zone_features, rows_for_targets
from pulsegrid.operators.slices import contiguous_slices, global_rank, slice_of_rank
from pulsegrid.sources.fixtures import icu, traffic
from pulsegrid.session import range_count
from support import SF_DIRS, direct_rolling_features, fresh_dir

CURATED_EXTRA = ["rolling_density_6_event", "speed_drop_from_zone_avg"]


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_ranged_rolling_is_bit_identical_to_direct_window(spark, ranges):
    typed = type_traffic(traffic(spark, SF_DIRS["0.01"]))
    fast = rolling_zone_features(typed, ranges=ranges).select("vehicle_id", *CURATED_EXTRA)
    slow = direct_rolling_features(typed).select("vehicle_id", *CURATED_EXTRA)
    diff = fast.exceptAll(slow).count() + slow.exceptAll(fast).count()
    assert diff == 0


def _edge_frame(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = []
    rng = np.random.default_rng(7)
    for i in range(120):
        zone = ["A", "B", None][i % 3]
        ts = None if i % 17 == 0 else base + dt.timedelta(minutes=int(rng.integers(0, 600)))
        d = None if i % 11 == 0 else float(rng.integers(0, 10_000)) / 100
        s = None if i % 13 == 0 else float(rng.integers(0, 5000)) / 100
        rows.append((f"V{i:04d}", zone, ts, d, s))
    # ties on the timestamp inside one zone
    rows += [(f"T{i}", "A", base + dt.timedelta(minutes=5), float(i), float(i)) for i in range(4)]
    return spark.createDataFrame(
        rows, "vehicle_id string, city_zone string, event_timestamp timestamp_ntz, d double, s double"
    )


@pytest.mark.parametrize("ranges", [1, 9, 60])
def test_rolling_handles_null_zone_time_and_values(spark, ranges):
    from pyspark.sql import Window

    df = _edge_frame(spark)
    fast = rolling_means(df, ["d", "s"], ranges=ranges)
    w = (
        Window.partitionBy("city_zone")
        .orderBy(F.col("event_timestamp").asc_nulls_first(), F.col("vehicle_id").asc_nulls_first())
        .rowsBetween(-5, 0)
    )
    slow = df.select("*", F.avg("d").over(w).alias("d_rolling_mean"), F.avg("s").over(w).alias("s_rolling_mean"))
    cols = ["vehicle_id", "d_rolling_mean", "s_rolling_mean"]
    assert fast.select(cols).exceptAll(slow.select(cols)).count() == 0
    assert slow.select(cols).exceptAll(fast.select(cols)).count() == 0


def test_rolling_window_keeps_rows_and_columns(spark):
    typed = type_traffic(traffic(spark, SF_DIRS["0.001"]))
    out = rolling_zone_features(typed)
    assert out.columns == typed.columns + CURATED_EXTRA
    assert out.count() == typed.count()


def _array_split_sizes(n, k):
    return [len(a) for a in np.array_split(np.arange(n), k)]


@pytest.mark.parametrize("n,k", [(11, 4), (3, 5), (8, 8), (1, 3), (59, 19), (40, 7)])
def test_slice_formula_matches_array_split(spark, n, k):
    ranks = spark.range(1, n + 1).select(F.col("id").alias("rank"), F.lit(n).cast("long").alias("n"))
    got = ranks.select(slice_of_rank(F.col("rank"), F.col("n"), k).alias("s")).groupBy("s").count()
    sizes = {r["s"]: r["count"] for r in got.collect()}
    expect = [size for size in _array_split_sizes(n, k)]
    assert [sizes.get(i, 0) for i in range(1, k + 1)] == expect


def test_global_rank_equals_row_number(spark):
    from pyspark.sql import Window

    df = icu(spark, SF_DIRS["0.01"]).select("patient_id", "admission_timestamp")
    ranked = global_rank(df, ["admission_timestamp", "patient_id"], ranges=5)
    direct = df.select(
        "patient_id",
        F.row_number().over(Window.orderBy("admission_timestamp", "patient_id")).cast("long").alias("_rank"),
    )
    assert ranked.select("patient_id", "_rank").exceptAll(direct).count() == 0
    assert ranked.select(F.max("_n")).first()[0] == df.count()


def test_contiguous_slices_equal_ntile(spark):
    from pyspark.sql import Window

    df = icu(spark, SF_DIRS["0.01"]).select("patient_id", "admission_timestamp")
    sliced = contiguous_slices(df, 8, ["admission_timestamp", "patient_id"], ranges=3)
    direct = df.select(
        "patient_id",
        "admission_timestamp",
        F.ntile(8).over(Window.orderBy("admission_timestamp", "patient_id")).alias("partition_id"),
    )
    assert sliced.exceptAll(direct).count() == 0
    assert sliced.count() == df.count()


@pytest.mark.parametrize("limit", [1, 20, 100, 5000])
def test_top_risk_report_equals_top_of_fully_curated_table(spark, limit):
    from pulsegrid.operators.ranking import top_risk_events
    from pulsegrid.plans.traffic_job import curate_traffic, top_risk_report

    t = traffic(spark, SF_DIRS["0.01"])
    fast = top_risk_report(t, limit)
    full = top_risk_events(curate_traffic(t), limit)
    assert fast.columns == full.columns
    assert fast.collect() == full.collect()


def test_rows_that_share_time_and_id(spark):
    """Equal (time, id) everywhere, at every border: one order by the values, whatever the input's partitions."""
    from pyspark.sql import Window

    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(3)
    rows = [("V", "A" if i % 3 else "B", base + dt.timedelta(minutes=int(i // 40)), float(rng.integers(0, 500)), float(rng.integers(0, 9))) for i in range(1500)]
    df = spark.createDataFrame(rows, "vehicle_id string, city_zone string, event_timestamp timestamp_ntz, d double, s double")
    w = Window.partitionBy("city_zone").orderBy("event_timestamp", "vehicle_id", "d", "s").rowsBetween(-5, 0)
    slow = df.select("*", F.avg("d").over(w).alias("d_rolling_mean"), F.avg("s").over(w).alias("s_rolling_mean"))
    for parts in (1, 7):
        fast = rolling_means(df.repartition(parts), ["d", "s"], ranges=40).select(*slow.columns)
        assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_one_hot_time_and_id_is_cut_into_even_ranges(spark):
    rows = [("V", "A", dt.datetime(2024, 1, 1), float(i), 1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "vehicle_id string, city_zone string, event_timestamp timestamp_ntz, d double, s double")
    sizes = [r["count"] for r in _ranged(df, "city_zone", "event_timestamp", "vehicle_id", ["d", "s"], 10, None).groupBy("_range").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 500


def test_targets_reach_their_frames_only(spark):
    typed = type_traffic(traffic(spark, SF_DIRS["0.01"]))
    targets = typed.orderBy("event_timestamp").limit(500).orderBy(F.desc("event_timestamp")).limit(3)
    kept = rows_for_targets(typed, targets)
    assert 0 < kept.count() < typed.count() // 10
    direct = direct_rolling_features(typed).join(targets.select("vehicle_id"), "vehicle_id").select("vehicle_id", *CURATED_EXTRA)
    some = rolling_zone_features(kept).join(targets.select("vehicle_id"), "vehicle_id").select("vehicle_id", *CURATED_EXTRA)
    assert sorted(some.collect()) == sorted(direct.collect())


def test_number_of_ranges_follows_the_input(spark):
    small, large = spark.range(1000), spark.range(10_000_000)
    assert range_count(small, 1 << 20) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_count(large, 1 << 20) == -(-80_000_000 // (1 << 20))


@contextmanager
def _small_partitions(spark, size="64k"):
    """Adaptive execution aims at partitions of ``size``."""
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": size, "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _numbers(ranged, column):
    return ranged.select(column).distinct().count()


def test_ranges_follow_the_rows_that_are_left(spark, monkeypatch):
    """The optimizer gives a filter the size of its input; the ranges are as many as its rows fill."""
    monkeypatch.setattr(session.range_count, "__defaults__", (1 << 14,))
    typed = type_traffic(traffic(spark, SF_DIRS["0.01"])).select("vehicle_id", "city_zone", "event_timestamp", "traffic_density", "average_speed")
    few = typed.filter(F.rand(4) < 0.03)
    assert range_count(few) == range_count(typed) > 20
    keys = ("city_zone", "event_timestamp", "vehicle_id", ["traffic_density", "average_speed"], None, None)
    with _small_partitions(spark):
        many, some = (_numbers(_ranged(x, *keys), "_range") for x in (typed, few))
        assert many >= 4 and some == 1
        paths = [fresh_dir("pg-rank-") + "/r" for _ in range(2)]
        for x, path in zip((typed, few), paths, strict=True):
            ranked = global_rank(x, ["event_timestamp", "vehicle_id"], path=path)
            assert ranked.select(F.max("_rank")).first()[0] == ranked.count()
        many, some = (_numbers(spark.read.parquet(path), "_pid") for path in paths)
        assert many >= 4 and some == 1
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_rows_of_one_time_and_id_keep_their_order_whatever_the_input(spark):
    """Rows that also share their values are told apart by their other columns, on every run alike."""
    rows = [("V", "A", dt.datetime(2024, 1, 1, i // 50), 1.0, float(i % 2), f"n{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "vehicle_id string, city_zone string, event_timestamp timestamp_ntz, d double, s double, note string")
    first, *others = (sorted(rolling_means(df.repartition(k), ["d", "s"], ranges=r).collect()) for k, r in ((1, 1), (6, 12), (3, None)))
    assert all(x == first for x in others)


def test_positions_beyond_the_id_bits(spark):
    """monotonically_increasing_id less the partition's first id is the row's position."""
    df = spark.range(100).repartition(3).select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"))
    found = df.select((F.col("m") - F.shiftleft(F.col("p").cast("long"), 33)).alias("x"), "p").groupBy("p").agg(F.max("x").alias("x"), F.count("x").alias("n"))
    assert all(r["x"] == r["n"] - 1 for r in found.collect())


@pytest.mark.parametrize("events", [1, 2, 10])
def test_other_frame_lengths_match_direct_window(spark, events):
    from pyspark.sql import Window

    df = _edge_frame(spark)
    fast = rolling_means(df, ["d"], events=events, ranges=12)
    w = (
        Window.partitionBy("city_zone")
        .orderBy(F.col("event_timestamp").asc_nulls_first(), F.col("vehicle_id").asc_nulls_first())
        .rowsBetween(-(events - 1), 0)
    )
    slow = df.select("vehicle_id", F.avg("d").over(w).alias("d_rolling_mean"))
    got = fast.select("vehicle_id", "d_rolling_mean")
    assert got.exceptAll(slow).count() == 0 and slow.exceptAll(got).count() == 0


def test_rolling_exact_in_a_non_ansi_session(spark):
    # non-ANSI sessions return -1 for size(NULL); the bucket numbers must still come out exact
    previous = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        typed = type_traffic(traffic(spark, SF_DIRS["0.01"]))
        cols = ["vehicle_id", *CURATED_EXTRA]
        fast = rolling_zone_features(typed, ranges=25).select(cols)
        slow = direct_rolling_features(typed).select(cols)
        assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)

"""Property-based checks of the scalar rules and the scalable window operators."""

from __future__ import annotations

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import columns as C
from pulsegrid.operators.rolling import rolling_means
from pulsegrid.operators.slices import slice_of_rank

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _band(x, edges, labels):
    if x is None:
        return None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        if lo < x <= hi:
            return label
    return None


@SLOW
@given(st.lists(st.one_of(st.none(), st.floats(-5, 110, allow_nan=False)), min_size=1, max_size=40))
def test_congestion_band_matches_interval_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "d double")
    got = [r[0] for r in df.select(C.congestion_band("d")).collect()]
    assert got == [_band(v, S.CONGESTION_BAND_EDGES, S.CONGESTION_BAND_LABELS) for v in values]


@SLOW
@given(st.integers(1, 300), st.integers(1, 40))
def test_slice_sizes_follow_array_split(spark, n, k):
    ranks = spark.range(1, n + 1).select(F.col("id").alias("rank"), F.lit(n).cast("long").alias("n"))
    got = ranks.groupBy(slice_of_rank(F.col("rank"), F.col("n"), k).alias("s")).count().collect()
    sizes = {r["s"]: r["count"] for r in got}
    expect = [len(a) for a in np.array_split(np.arange(n), k)]
    assert [sizes.get(i, 0) for i in range(1, k + 1)] == expect
    # contiguity: slice ids never decrease with the rank
    ordered = [r["s"] for r in ranks.select(slice_of_rank(F.col("rank"), F.col("n"), k).alias("s")).collect()]
    assert ordered == sorted(ordered)


row = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.one_of(st.none(), st.integers(0, 600)),
    st.one_of(st.none(), st.integers(0, 9999)),
)


@SLOW
@given(st.lists(row, min_size=1, max_size=60), st.sampled_from([1, 3, 20]))
def test_rolling_mean_equals_direct_window(spark, rows, ranges):
    base = dt.datetime(2024, 5, 1)
    data = [
        (f"V{i:03d}", z, None if m is None else base + dt.timedelta(minutes=m), None if v is None else v / 100)
        for i, (z, m, v) in enumerate(rows)
    ]
    df = spark.createDataFrame(data, "vehicle_id string, city_zone string, event_timestamp timestamp_ntz, d double")
    fast = rolling_means(df, ["d"], ranges=ranges)
    w = (
        Window.partitionBy("city_zone")
        .orderBy(F.col("event_timestamp").asc_nulls_first(), F.col("vehicle_id").asc_nulls_first())
        .rowsBetween(-5, 0)
    )
    slow = df.select("vehicle_id", F.avg("d").over(w).alias("d_rolling_mean"))
    got = {r["vehicle_id"]: r["d_rolling_mean"] for r in fast.select("vehicle_id", "d_rolling_mean").collect()}
    want = {r["vehicle_id"]: r["d_rolling_mean"] for r in slow.collect()}
    assert got == want


@SLOW
@given(
    st.lists(st.tuples(st.integers(0, 20), st.integers(0, 10_000)), min_size=1, max_size=80, unique_by=lambda t: t[1]),
    st.integers(1, 7),
)
def test_global_rank_equals_row_number_on_random_frames(spark, rows, ranges):
    from pulsegrid.operators.slices import global_rank

    base = dt.datetime(2024, 6, 1)
    df = spark.createDataFrame(
        [(base + dt.timedelta(minutes=m), f"P{pid:05d}") for m, pid in rows], "ts timestamp_ntz, pid string"
    )
    ranked = global_rank(df, ["ts", "pid"], ranges=ranges)
    got = {r["pid"]: (r["_rank"], r["_n"]) for r in ranked.collect()}
    want = {
        r["pid"]: (r["rn"], len(rows))
        for r in df.select("pid", F.row_number().over(Window.orderBy("ts", "pid")).alias("rn")).collect()
    }
    assert got == want


traffic_row = st.tuples(
    st.sampled_from(["Neon North", "Metro Central", None]),
    st.sampled_from(["Car", "Bus", None]),
    st.one_of(st.none(), st.floats(0, 120, allow_nan=False)),
    st.sampled_from(["Low", "High", None]),
    st.one_of(st.none(), st.text(alphabet="AB", min_size=1, max_size=3)),
)


@SLOW
@given(st.lists(traffic_row, min_size=0, max_size=50))
def test_group_counts_add_up(spark, rows):
    from pulsegrid.operators import aggregates as A
    from pulsegrid.operators.matrix import speed_histogram
    from pulsegrid.operators.prepare import prepare_telemetry

    base = dt.datetime(2024, 7, 1)
    data = [
        (vid, base + dt.timedelta(minutes=i), zone, vtype, 50.0, speed, "Rain", "Wet", 10.0, 0.1, level, 0.5)
        for i, (zone, vtype, speed, level, vid) in enumerate(rows)
    ]
    prepared = prepare_telemetry(spark.createDataFrame(data, S.TRAFFIC_SCHEMA))
    zones = A.zone_summary(prepared).agg(F.sum("vehicle_count")).first()[0] or 0
    assert zones == sum(1 for z, _, _, _, vid in rows if z is not None and vid is not None)
    hist = speed_histogram(prepared).agg(F.sum("n")).first()[0] or 0
    assert hist == sum(1 for _, _, s, lv, _ in rows if s is not None and lv is not None)
    types = A.vehicle_type_distribution(prepared)
    total = types.agg(F.sum("count"), F.sum("share")).first()
    assert (total[0] or 0) == sum(1 for _, t, _, _, _ in rows if t is not None)
    if total[0]:
        assert abs(total[1] - 1.0) < 1e-9

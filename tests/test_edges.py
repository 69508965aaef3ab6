"""Hand-written edge rows the shared tables do not contain (NULL, NaN, boundaries, empty input)."""

from __future__ import annotations

import datetime as dt
import math
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.functions import columns as C
from pulsegrid.operators import aggregates as A
from pulsegrid.operators.prepare import filter_telemetry, prepare_telemetry, preprocess_icu, type_traffic
from pulsegrid.operators.ranking import filter_options, top_anomalies
from pulsegrid.operators.slices import contiguous_slices
from pulsegrid.operators.timeseries import forecast, hourly_trend
from pulsegrid.sources import files
from support import fresh_dir

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)


def traffic_rows(spark, rows):
    """rows: dicts with any subset of the 12 columns; the rest NULL."""
    data = [tuple(r.get(c) for c in S.TRAFFIC_COLUMNS) for r in rows]
    return spark.createDataFrame(data, S.TRAFFIC_SCHEMA)


def icu_rows(spark, rows):
    data = [tuple(r.get(c) for c in S.ICU_COLUMNS) for r in rows]
    return spark.createDataFrame(data, S.ICU_SCHEMA)


def test_congestion_bands_are_right_closed(spark):
    values = [-1.0, 35.0, 35.0001, 60.0, 80.0, 101.0, 102.0, None]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    got = [r[0] for r in df.select(C.congestion_band("d")).collect()]
    assert got == [None, "Low", "Moderate", "Moderate", "High", "Critical", None, None]


def test_severity_bands_are_right_closed(spark):
    values = [-0.01, 0.0, 0.33, 0.3301, 0.66, 1.01, 1.02, None]
    df = spark.createDataFrame([(v,) for v in values], "r double")
    got = [r[0] for r in df.select(C.severity_band("r")).collect()]
    assert got == [None, "Stable", "Stable", "Watchlist", "Watchlist", "Critical", None, None]


def test_missing_scores_and_levels_give_false_flags(spark):
    df = traffic_rows(
        spark,
        [
            {"vehicle_id": "a", "timestamp": T0, "ai_anomaly_score": None, "congestion_level": None},
            {"vehicle_id": "b", "timestamp": T0, "ai_anomaly_score": float("nan"), "congestion_level": "High"},
            {"vehicle_id": "c", "timestamp": T0, "ai_anomaly_score": 0.78, "congestion_level": "Critical"},
            {"vehicle_id": "d", "timestamp": T0, "ai_anomaly_score": 0.7799, "congestion_level": "Moderate"},
        ],
    )
    got = {r["vehicle_id"]: (r["is_anomaly"], r["is_high_congestion"]) for r in prepare_telemetry(df).collect()}
    assert got == {"a": (False, False), "b": (False, True), "c": (True, True), "d": (False, False)}
    weights = {r["vehicle_id"]: r["congestion_weight"] for r in type_traffic(df).collect()}
    assert weights == {"a": 1, "b": 3, "c": 4, "d": 2}


def test_severe_event_keeps_three_valued_logic(spark):
    row = {
        "vehicle_id": "x", "timestamp": T0, "traffic_density": None, "average_speed": 10.0,
        "signal_wait_time": 0.0, "accident_probability": 0.0, "ai_anomaly_score": 0.0,
    }
    out = type_traffic(traffic_rows(spark, [row])).first()
    assert out["risk_index"] is None and out["severe_event"] is None
    row2 = dict(row, traffic_density=80.0, average_speed=15.0)
    assert type_traffic(traffic_rows(spark, [row2])).first()["severe_event"] is True


def test_null_zone_dropped_by_dashboard_groups_kept_by_profile(spark):
    rows = [
        {"vehicle_id": f"v{i}", "timestamp": T0, "city_zone": z, "weather_condition": "Rain",
         "congestion_level": "Low", "traffic_density": 10.0, "average_speed": 50.0, "signal_wait_time": 5.0,
         "accident_probability": 0.1, "ai_anomaly_score": 0.2}
        for i, z in enumerate(["A", None, "A"])
    ]
    prepared = prepare_telemetry(traffic_rows(spark, rows))
    assert [r["city_zone"] for r in A.zone_summary(prepared).collect()] == ["A"]
    assert [r["city_zone"] for r in A.accident_hotspots(prepared).collect()] == ["A"]
    profile = A.zone_weather_profile(type_traffic(traffic_rows(spark, rows))).collect()
    assert sorted((r["city_zone"] or "", r["vehicle_events"]) for r in profile) == [("", 1), ("A", 2)]


def test_severe_rate_with_all_vehicle_ids_missing_is_null(spark):
    rows = [{"vehicle_id": None, "timestamp": T0, "city_zone": "A", "ai_anomaly_score": 0.9}]
    out = A.zone_weather_profile(type_traffic(traffic_rows(spark, rows))).first()
    assert out["vehicle_events"] == 0 and out["severe_events"] == 1 and out["severe_event_rate"] is None


def test_shock_index_guards_zero_and_missing_pressure(spark):
    base = {"patient_id": "p", "admission_timestamp": T0, "heart_rate": 90.0, "oxygen_saturation": 95.0,
            "lactate_mmol_l": 1.0, "mortality_risk": 0.1, "critical_event": False}
    df = icu_rows(spark, [dict(base, patient_id="zero", systolic_bp=0.0), dict(base, patient_id="null", systolic_bp=None),
                          dict(base, patient_id="low", systolic_bp=100.0)])
    got = {r["patient_id"]: (r["shock_index"], r["batch_alert"]) for r in preprocess_icu(df).collect()}
    assert got["zero"] == (None, False) and got["null"] == (None, False)
    assert got["low"] == (0.9, True)


def test_trend_skips_empty_hours(spark):
    rows = [
        {"vehicle_id": "a", "timestamp": T0, "traffic_density": 10.0, "ai_anomaly_score": 0.1, "accident_probability": 0.1},
        {"vehicle_id": "b", "timestamp": T0 + dt.timedelta(hours=3, minutes=5), "traffic_density": 30.0,
         "ai_anomaly_score": 0.3, "accident_probability": 0.3},
        {"vehicle_id": "c", "timestamp": T0 + dt.timedelta(hours=5), "traffic_density": 30.0,
         "ai_anomaly_score": None, "accident_probability": 0.3},
    ]
    got = [r["timestamp_hour"] for r in hourly_trend(traffic_rows(spark, rows)).collect()]
    assert got == [T0, T0 + dt.timedelta(hours=3)]


def _pandas_forecast(values, periods=12):
    """The forecast rule stated directly in pandas (rolling mean and mean of differences)."""
    s = pd.Series(values, dtype="float64")
    recent = s.tail(24)
    base = recent.rolling(window=6, min_periods=1).mean().iloc[-1]
    momentum = recent.diff().tail(6).mean()
    momentum = 0 if pd.isna(momentum) else momentum
    return [max(0, min(100, base + momentum * (step + 1))) for step in range(periods)]


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 30])
def test_forecast_branches_match_the_rule(spark, n):
    values = [float((i * 37) % 91) + 0.25 * i for i in range(n)]
    trend = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=2 * i), v) for i, v in enumerate(values)],
        "timestamp_hour timestamp_ntz, traffic_density double",
    )
    got = forecast(trend).orderBy("timestamp_hour").collect()
    expect = _pandas_forecast(values)
    assert len(got) == 12
    last = T0 + dt.timedelta(hours=2 * (n - 1))
    assert [r["timestamp_hour"] for r in got] == [last + dt.timedelta(hours=s) for s in range(1, 13)]
    for r, e in zip(got, expect):
        assert math.isclose(r["forecast_density"], e, rel_tol=1e-9, abs_tol=1e-9)
        assert 0.0 <= r["forecast_density"] <= 100.0


def test_empty_inputs_give_fixed_results(spark):
    empty = traffic_rows(spark, [])
    prepared = prepare_telemetry(empty)
    kpi = A.kpi_summary(prepared).collect()
    assert len(kpi) == 1 and all(v == 0.0 for v in kpi[0])
    assert forecast(hourly_trend(empty)).count() == 0
    top = top_anomalies(prepared)
    assert top.count() == 0 and top.columns == S.DASHBOARD_ANOMALY_COLUMNS
    summary = A.icu_batch_summary(preprocess_icu(icu_rows(spark, []))).collect()
    assert [tuple(r) for r in summary] == [(0, 0.0, 0.0, "N/A")]


def test_icu_summary_top_unit_and_rates(spark):
    rows = []
    for i, (unit, alert_lactate) in enumerate([("B", 5.0), ("B", 1.0), ("A", 5.0), ("A", 1.0), (None, 5.0), ("C", 1.0)]):
        rows.append({"patient_id": f"p{i}", "admission_timestamp": T0, "icu_unit": unit, "heart_rate": 60.0,
                     "systolic_bp": 120.0, "oxygen_saturation": 97.0, "lactate_mmol_l": alert_lactate,
                     "mortality_risk": 0.1 * i, "critical_event": False})
    pre = preprocess_icu(icu_rows(spark, rows))
    out = A.icu_batch_summary(pre).first()
    assert out["rows"] == 6 and math.isclose(out["alert_rate"], 50.0)
    assert out["top_unit"] == "A"  # A and B tie at 0.5; the first name wins
    assert math.isclose(out["avg_mortality_risk"], 0.25)
    rates = [(r["icu_unit"], r["alert_rate"]) for r in A.icu_unit_alert_rates(pre).collect()]
    assert rates == [("A", 0.5), ("B", 0.5), ("C", 0.0)]


def test_top_anomalies_ties_break_on_time_then_id(spark):
    rows = [{"vehicle_id": v, "timestamp": T0 + dt.timedelta(minutes=m), "ai_anomaly_score": 0.9}
            for v, m in [("b", 1), ("a", 1), ("c", 0)]]
    got = [r["vehicle_id"] for r in top_anomalies(prepare_telemetry(traffic_rows(spark, rows)), 2).collect()]
    assert got == ["c", "a"]


def test_fewer_rows_than_slices(spark):
    df = icu_rows(spark, [{"patient_id": f"p{i}", "admission_timestamp": T0 + dt.timedelta(minutes=i)} for i in range(3)])
    sliced = contiguous_slices(df, 5, ["admission_timestamp", "patient_id"])
    assert sorted((r["patient_id"], r["partition_id"]) for r in sliced.collect()) == [("p0", 1), ("p1", 2), ("p2", 3)]
    profile = [(r["partition_id"], r["rows"]) for r in A.icu_slice_profile(df, 5).orderBy("partition_id").collect()]
    assert profile == [(1, 1), (2, 1), (3, 1), (4, 0), (5, 0)]


def test_filter_empty_list_means_no_filter_and_options_sorted(spark):
    rows = [{"vehicle_id": str(i), "timestamp": T0, "city_zone": z, "weather_condition": w, "vehicle_type": "Car",
             "congestion_level": lvl}
            for i, (z, w, lvl) in enumerate([("A", "Rain", "High"), ("B", "Fog", "Low"), ("A", None, "Critical")])]
    df = prepare_telemetry(traffic_rows(spark, rows))
    assert filter_telemetry(df).count() == 3
    assert filter_telemetry(df, zones=["A"], congestion_levels=["High", "Critical"]).count() == 2
    assert filter_telemetry(df, zones=["A"], weather=["Rain"]).count() == 1
    opts = [(r["dimension"], r["option"]) for r in filter_options(df).collect()]
    assert opts == [("city_zone", "A"), ("city_zone", "B"), ("vehicle_type", "Car"),
                    ("weather_condition", "Fog"), ("weather_condition", "Rain")]


def test_csv_reader_counts_corrupt_rows_and_maps_nan(spark):
    folder = fresh_dir("pg-csv-")
    path = os.path.join(folder, "traffic.csv")
    header = ",".join(S.TRAFFIC_COLUMNS)
    good = "QTF-AB-00001,2024-03-01 08:00:00,Neon North,Car,40.5,60.0,Clear,Smooth,12.0,0.1,Moderate,NaN"
    pandas_style = "QTF-AB-00002,2024-03-01 08:01:00.250000,Neon North,Car,40.5,60.0,Clear,Smooth,12.0,0.1,Moderate,0.9"
    bad = "QTF-AB-00003,not-a-time,Neon North,Car,abc,60.0,Clear,Smooth,12.0,0.1,Moderate,0.5"
    with open(path, "w") as fh:
        fh.write("\n".join([header, good, pandas_style, bad]) + "\n")
    raw = files.read_csv(spark, path, S.TRAFFIC_SCHEMA, keep_corrupt=True).cache()
    counts = files.corrupt_rows(raw).first()
    assert (counts["corrupt_rows"], counts["input_rows"]) == (1, 3)
    rows = {r["vehicle_id"]: r for r in raw.collect()}
    assert rows["QTF-AB-00001"]["ai_anomaly_score"] is None
    assert rows["QTF-AB-00002"]["timestamp"] == dt.datetime(2024, 3, 1, 8, 1, 0, 250000)
    raw.unpersist()


def test_pandas_written_csv_reads_back_unchanged(spark):
    """Files written by pandas `to_csv(index=False)` (True/False, space-separated stamps) read exactly."""
    from pulsegrid.sources.fixtures import icu, traffic
    from support import SF_DIRS

    folder = fresh_dir("pg-pandas-")
    for name, frame, reader in (
        ("traffic.csv", traffic(spark, SF_DIRS["0.001"]), files.read_traffic_csv),
        ("icu.csv", icu(spark, SF_DIRS["0.001"]), files.read_icu_csv),
    ):
        path = os.path.join(folder, name)
        frame.toPandas().to_csv(path, index=False)
        back = reader(spark, path)
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in frame.schema]
        assert back.exceptAll(frame).count() == 0 and frame.exceptAll(back).count() == 0


def test_load_telemetry_reads_and_prepares(spark):
    from pulsegrid.plans.dashboard import load_telemetry
    from pulsegrid.sources.fixtures import traffic
    from support import SF_DIRS

    path = os.path.join(fresh_dir("pg-load-"), "traffic.csv")
    source = traffic(spark, SF_DIRS["0.001"])
    source.toPandas().to_csv(path, index=False)
    loaded = load_telemetry(spark, path)
    assert loaded.columns == S.PREPARED_SCHEMA.fieldNames()
    expected = prepare_telemetry(source)
    assert loaded.exceptAll(expected).count() == 0 and expected.exceptAll(loaded).count() == 0


def test_stored_label_is_kept_and_rederived_band_is_separate(spark):
    # the stored label was cut before the density was rounded: 35.00 stored as Moderate
    df = traffic_rows(spark, [{"vehicle_id": "r", "timestamp": T0, "traffic_density": 35.0, "congestion_level": "Moderate"}])
    row = prepare_telemetry(df).select("congestion_level", C.congestion_band("traffic_density").alias("band")).first()
    assert (row["congestion_level"], row["band"]) == ("Moderate", "Low")
    assert type_traffic(df).first()["congestion_weight"] == 2


def test_ids_are_padded_but_never_cut(spark):
    from pulsegrid.sources.fixtures import ICU_SQL_DUCKDB, TRAFFIC_SQL, icu, traffic
    from support import duck_connection, fresh_dir

    import os

    root = fresh_dir("pg-ids-")
    keys = [0, 41, 9_999_998, 9_999_999, 10_000_000, 99_999_990]
    events = [(k, dt.datetime(2024, 1, 1), 1, 1.0) for k in keys]
    orders = [(k, 1, dt.datetime(2024, 1, 1)) for k in keys]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, value double").coalesce(1).write.parquet(f"{root}/events.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{root}/orders.parquet")
    vehicles = ["QTF-0000000", "QTF-0000041", "QTF-9999998", "QTF-9999999", "QTF-10000000", "QTF-99999990"]
    patients = ["ICU-0000001", "ICU-0000042", "ICU-9999999", "ICU-10000000", "ICU-10000001", "ICU-99999991"]
    assert {r[0] for r in traffic(spark, root).select("vehicle_id").collect()} == set(vehicles)
    assert {r[0] for r in icu(spark, root).select("patient_id").collect()} == set(patients)
    con = duck_connection(root)
    for name in ("events", "orders"):
        con.execute(f"create or replace view {name} as select * from read_parquet('{os.path.join(root, name)}.parquet/*.parquet')")
    assert {r[0] for r in con.sql(f"select vehicle_id from ({TRAFFIC_SQL}) t").fetchall()} == set(vehicles)
    assert {r[0] for r in con.sql(f"select patient_id from ({ICU_SQL_DUCKDB}) t").fetchall()} == set(patients)


def test_nan_counts_as_missing_without_a_reader(spark):
    from pulsegrid.operators.matrix import speed_histogram

    nan = float("nan")
    base = [("a", 10.0, 20.0, 0.2, 0.9), ("b", nan, nan, nan, nan), ("c", 30.0, 40.0, 0.4, 0.5)]
    rows = [
        (i, dt.datetime(2024, 1, 1, 5, k), "Metro Central", "Car", d, s, "Clear", "Wet", 1.0, p, "Low", a) for k, (i, d, s, p, a) in enumerate(base)
    ]
    df = spark.createDataFrame(rows, S.TRAFFIC_SCHEMA)
    kpis = A.kpi_summary(prepare_telemetry(df)).first()
    assert kpis["average_speed"] == 30.0 and abs(kpis["average_anomaly_score"] - 0.7) < 1e-12
    assert hourly_trend(df).first()["traffic_density"] == 20.0
    assert speed_histogram(df).agg(F.sum("n")).first()[0] == 2
    assert [r["vehicle_id"] for r in top_anomalies(prepare_telemetry(df)).collect()] == ["a", "c", "b"]

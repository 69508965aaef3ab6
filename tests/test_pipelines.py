"""The composite jobs end to end: CSV in, files out, outputs equal the direct queries."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators import aggregates as A
from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.ranking import top_risk_events
from pulsegrid.operators.aggregates import icu_slice_profile
from pulsegrid.plans.dashboard import dashboard, load_telemetry
from pulsegrid.plans.icu_job import preprocess_icu_sliced, run_icu_job
from pulsegrid.plans.traffic_job import curate_traffic, load_anomalies, load_summary, run_traffic_job
from pulsegrid.sources import files
from pulsegrid.sources.fixtures import icu, traffic
from support import SF_DIRS, compare, fresh_dir

SF = SF_DIRS["0.001"]


def same_rows(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_traffic_job_from_csv(spark):
    root = fresh_dir("pg-job-")
    src = os.path.join(root, "input_csv")
    files.write_csv(traffic(spark, SF), src)
    stats = run_traffic_job(
        spark,
        src,
        summary_path=os.path.join(root, "summary"),
        anomaly_path=os.path.join(root, "anomalies"),
        curated_dir=os.path.join(root, "curated"),
        partition_curated_by=["city_zone"],
    )
    n = traffic(spark, SF).count()
    assert stats["input_rows"] == n and stats["corrupt_rows"] == 0
    assert stats["anomaly_rows"] == min(n, S.PIPELINE_ANOMALY_LIMIT)
    direct_summary = A.zone_weather_profile(type_traffic(traffic(spark, SF)))
    assert stats["summary_rows"] == direct_summary.count()

    summary = load_summary(spark, stats["summary_path"])
    assert summary.schema == S.SUMMARY_SCHEMA
    # means of a few rows with two digits lie on rounding borders, where the order of summing decides
    means = ["avg_density", "avg_speed", "avg_risk_index", "avg_ai_anomaly_score"]
    assert same_rows(summary.drop(*means), direct_summary.drop(*means))
    key = ["city_zone", "weather_condition", "congestion_level"]
    for a, b in zip(summary.orderBy(*key).collect(), direct_summary.orderBy(*key).collect(), strict=True):
        assert all(abs(a[m] - b[m]) < 0.0101 for m in means)
    anomalies = load_anomalies(spark, stats["anomaly_path"])
    assert same_rows(anomalies, top_risk_events(curate_traffic(traffic(spark, SF))))
    # one summary file and one anomaly file
    assert len([f for f in os.listdir(stats["summary_path"]) if f.endswith(".csv")]) == 1

    curated = files.read_parquet(spark, stats["curated_output_dir"])
    assert set(curated.columns) == set(S.CURATED_SCHEMA.fieldNames())
    assert same_rows(curated.select(*S.CURATED_SCHEMA.fieldNames()), curate_traffic(traffic(spark, SF)))


def test_icu_job_from_csv(spark):
    root = fresh_dir("pg-icu-")
    src = os.path.join(root, "icu_csv")
    files.write_csv(icu(spark, SF), src)
    out, report = run_icu_job(spark, src, os.path.join(root, "icu_out"), n_slices=8)
    n = icu(spark, SF).count()
    sizes = sorted(report["slice_rows"].values(), reverse=True)
    assert sum(sizes) == n and sizes[0] - sizes[-1] <= 1 and len(sizes) == 8
    assert out.columns == S.ICU_PREPROCESSED_SCHEMA.fieldNames()
    assert same_rows(out, preprocess_icu_sliced(icu(spark, SF)))
    kpis = A.icu_batch_summary(preprocess_icu_sliced(icu(spark, SF))).first()
    assert report["kpis"]["rows"] == n == kpis["rows"]
    assert report["kpis"]["top_unit"] == kpis["top_unit"] == report["unit_alert_rates"][0][0]
    assert abs(report["kpis"]["alert_rate"] - kpis["alert_rate"]) < 1e-9
    assert abs(report["kpis"]["avg_mortality_risk"] - kpis["avg_mortality_risk"]) < 1e-12
    rates = [(r["icu_unit"], r["alert_rate"]) for r in A.icu_unit_alert_rates(preprocess_icu_sliced(icu(spark, SF))).collect()]
    assert [u for u, _ in report["unit_alert_rates"]] == [u for u, _ in rates]
    assert report["corrupt_rows"] == 0


def test_dashboard_query_set(spark):
    views = dashboard(traffic(spark, SF), zones=["Neon North", "Metro Central"], congestion_levels=["High", "Critical"])
    filtered_n = views["filtered"].count()
    assert filtered_n > 0
    assert views["kpis"].first()["total_vehicles"] == float(filtered_n)
    assert views["vehicle_types"].agg(F.sum("count")).first()[0] == filtered_n
    assert abs(views["vehicle_types"].agg(F.sum("share")).first()[0] - 1.0) < 1e-12
    assert views["speed_histogram"].agg(F.sum("n")).first()[0] == filtered_n
    assert views["forecast"].count() == S.FORECAST_PERIODS
    assert views["top_zones"].count() <= 2
    assert views["heatmap"].columns == ["city_zone"] + [f"h{h:02d}" for h in range(24)]
    assert views["zones"].agg(F.sum("vehicle_count")).first()[0] == filtered_n


def test_materialized_dashboard_equals_lazy(spark):
    args = dict(zones=["Neon North"], weather=["Rain", "Fog"])
    lazy = dashboard(traffic(spark, SF), materialize=False, **args)
    stored = dashboard(traffic(spark, SF), **args)
    for name in ("kpis", "zones", "heatmap", "speed_histogram", "top_anomalies", "forecast"):
        assert compare(stored[name].toPandas(), lazy[name].toPandas()) == [], name


def test_traffic_job_counts_malformed_rows(spark):
    root = fresh_dir("pg-bad-")
    src = os.path.join(root, "input_csv")
    files.write_csv(traffic(spark, SF), src)
    with open(os.path.join(src, "part-extra.csv"), "w") as fh:
        fh.write(",".join(S.TRAFFIC_COLUMNS) + "\n")
        fh.write("QTF-X,not-a-time,Neon North,Car,oops,1,Clear,Smooth,1,0.1,Low,0.2\n")
    stats = run_traffic_job(
        spark, src, os.path.join(root, "s"), os.path.join(root, "a"), os.path.join(root, "c")
    )
    assert stats["corrupt_rows"] == 1
    assert stats["input_rows"] == traffic(spark, SF).count() + 1


def test_jobs_and_materialising_operators_accept_empty_input(spark):
    empty_icu = spark.createDataFrame([], S.ICU_SCHEMA)
    empty_traffic = spark.createDataFrame([], S.TRAFFIC_SCHEMA)
    root = fresh_dir("pg-empty-")
    assert preprocess_icu_sliced(empty_icu).count() == 0
    assert curate_traffic(empty_traffic).count() == 0
    _, report = run_icu_job(spark, empty_icu, os.path.join(root, "icu"))
    assert report["kpis"] == {"rows": 0, "alert_rate": 0.0, "avg_mortality_risk": 0.0, "top_unit": "N/A"}
    stats = run_traffic_job(
        spark, empty_traffic, os.path.join(root, "s"), os.path.join(root, "a"), os.path.join(root, "c")
    )
    assert (stats["input_rows"], stats["summary_rows"], stats["anomaly_rows"]) == (0, 0, 0)
    assert dashboard(empty_traffic, materialize=True)["kpis"].first()["total_vehicles"] == 0.0


def test_jobs_remove_their_scratch_tables(spark):
    from pulsegrid.session import ensure_checkpoint_dir

    scratch = os.path.join(ensure_checkpoint_dir(spark), "pulsegrid-scratch").replace("file:", "")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    root = fresh_dir("pg-clean-")
    src = os.path.join(root, "in")
    files.write_csv(traffic(spark, SF), src)
    run_traffic_job(spark, src, os.path.join(root, "s"), os.path.join(root, "a"), os.path.join(root, "c"))
    run_icu_job(spark, icu(spark, SF), os.path.join(root, "icu"))
    after = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    files.write_csv(icu(spark, SF), os.path.join(root, "icu_in"))
    run_icu_job(spark, os.path.join(root, "icu_in"), os.path.join(root, "icu2"))
    after = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    assert not [p for p in after - before if p.startswith(("traffic-staged", "icu-ranking", "icu-staged"))]


def test_icu_job_counts_malformed_rows(spark):
    root = fresh_dir("pg-icu-bad-")
    src = os.path.join(root, "icu_csv")
    files.write_csv(icu(spark, SF), src)
    with open(os.path.join(src, "part-extra.csv"), "w") as fh:
        fh.write(",".join(S.ICU_COLUMNS) + "\n")
        fh.write("ICU-X,not-a-time,Neuro ICU,abc,Sepsis,1,1,1,1,1,1,1,Room Air,1,0.5,maybe\n")
    out, report = run_icu_job(spark, src, os.path.join(root, "out"))
    assert report["corrupt_rows"] == 1
    assert report["kpis"]["rows"] == icu(spark, SF).count() + 1


def test_empty_slices_are_reported(spark):
    few = icu(spark, SF).orderBy("patient_id").limit(5)
    _, report = run_icu_job(spark, few, os.path.join(fresh_dir("pg-few-"), "icu"), n_slices=8)
    assert report["slice_rows"] == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 0, 7: 0, 8: 0}
    profile = {r["partition_id"]: r["rows"] for r in icu_slice_profile(few, 8).collect()}
    assert profile == report["slice_rows"]


def test_dashboard_takes_what_load_telemetry_returns(spark):
    path = os.path.join(fresh_dir("pg-dash-"), "traffic")
    files.write_csv(traffic(spark, SF), path)
    loaded = dashboard(load_telemetry(spark, path))
    plain = dashboard(traffic(spark, SF))
    assert loaded["kpis"].collect() == plain["kpis"].collect()
    assert loaded["top_anomalies"].collect() == plain["top_anomalies"].collect()


def test_load_telemetry_can_keep_malformed_rows(spark):
    path = os.path.join(fresh_dir("pg-bad-"), "traffic")
    files.write_csv(traffic(spark, SF), path)
    with open(os.path.join(path, "part-zz.csv"), "w") as f:
        f.write(",".join(S.TRAFFIC_COLUMNS) + "\nX,not a time,Z,Car,1,2,Clear,Wet,3,0.1,Low,0.2\n")
    row = files.corrupt_rows(load_telemetry(spark, path, keep_corrupt=True)).first()
    assert (row["corrupt_rows"], row["input_rows"]) == (1, traffic(spark, SF).count() + 1)

"""Views from partial aggregates equal the direct ones, states add up, and bins follow the data."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import states as T
from pulsegrid.operators.matrix import nice_histogram, nice_width
from pulsegrid.operators.prepare import prepare_telemetry
from pulsegrid.plans.dashboard import dashboard
from pulsegrid.sources.fixtures import traffic
from support import SF_DIRS, compare

SF = SF_DIRS["0.001"]
FILTERS = [{}, {"zones": ["Neon North"], "weather": ["Rain", "Fog"]}, {"vehicle_types": ["Bus"], "congestion_levels": ["Low"]}, {"zones": ["nowhere"]}]


def _with_gaps(spark):
    """The traffic with NULLs in every column, by turns."""
    rows = traffic(spark, SF)
    return rows.select(*[F.when(F.crc32(F.concat("vehicle_id", F.lit(c))) % 13 > 0, F.col(c)).alias(c) for c in rows.columns])


@pytest.mark.parametrize("filters", FILTERS, ids=str)
@pytest.mark.parametrize("gaps", [False, True])
def test_views_equal_the_direct_ones(spark, filters, gaps):
    rows = _with_gaps(spark) if gaps else traffic(spark, SF)
    direct, stated = dashboard(rows, materialize=False, **filters), dashboard(rows, **filters)
    assert list(direct) == list(stated)
    for name, view in direct.items():
        assert stated[name].dtypes == view.dtypes, name
        if name == "top_anomalies":  # NULL ids tie
            view, stated[name] = view.select("ai_anomaly_score"), stated[name].select("ai_anomaly_score")
        assert compare(stated[name].toPandas(), view.toPandas()) == [], name


def _scans(view):
    """Leaves of a plan that read files, as their columns."""
    text = view._jdf.queryExecution().executedPlan().toString()
    return [line.split("[")[1].split("]")[0] for line in text.splitlines() if "FileScan" in line]


def test_bounded_views_read_the_states_alone(spark):
    views = dashboard(traffic(spark, SF), zones=["Neon North"])
    for name in set(views) - {"filtered", "top_anomalies"}:
        scans = _scans(views[name])
        assert scans and all("kind" in s or "sum_" in s or "seen" in s for s in scans), (name, scans)


def test_states_are_one_scan_and_one_aggregate(spark):
    plan = T.partial_states(prepare_telemetry(traffic(spark, SF)), F.lit(5.0))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1 and plan.count("Exchange") == 1


def test_states_of_parts_add_up(spark):
    rows = prepare_telemetry(_with_gaps(spark))
    part = F.coalesce(F.crc32("vehicle_id") % 3, F.lit(0))
    merged = T.merge_states([T.partial_states(rows.filter(part == k), F.lit(5.0)) for k in range(3)])
    whole = T.partial_states(rows, F.lit(5.0))
    assert compare(merged.select(*whole.columns).toPandas(), whole.toPandas()) == []


def _plain_width(lo, hi, bins):
    return min(w for k in range(-12, 13) for d in (1, 2, 5) if math.floor(hi / (w := d * 10.0**k)) - math.floor(lo / w) < bins) if hi > lo else 1.0


@pytest.mark.parametrize("lo,hi,bins", [(3, 110, 45), (0, 1, 45), (0.0, 45.0, 45), (-7.5, 1234.5, 10), (1e-7, 3e-7, 45), (5, 5, 45), (0, 1e6, 45), (99.9, 100.1, 45), (0, 100, 1), (0, 10, 10)])
def test_nice_width(spark, lo, hi, bins):
    got = spark.range(1).select(nice_width(F.lit(float(lo)), F.lit(float(hi)), bins)).first()[0]
    assert got == pytest.approx(_plain_width(lo, hi, bins), rel=1e-12)
    digits = got / 10.0 ** math.floor(math.log10(got) + 1e-9)
    assert any(digits == pytest.approx(d) for d in (1, 2, 5))


def test_histogram_follows_the_range(spark):
    rows = prepare_telemetry(traffic(spark, SF))
    for scale in (0.001, 1.0, 1000.0):
        got = nice_histogram(rows.withColumn("average_speed", F.col("average_speed") * scale)).collect()
        bins = {r["bin"] for r in got}
        assert max(bins) - min(bins) < 45 and len(bins) > 15 and sum(r["n"] for r in got) == rows.count()
    assert nice_histogram(rows.limit(0)).count() == 0
    assert nice_histogram(rows.withColumn("average_speed", F.lit(7.25))).select("bin", "bin_width").distinct().collect() == [(7, 1.0)]

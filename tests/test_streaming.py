"""Streaming forms agree with the batch operators on the same rows."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.timeseries import hourly_trend
from pulsegrid.sources import files
from pulsegrid.sources.fixtures import traffic
from pulsegrid.streaming.telemetry import hourly_trend_stream, start_parquet_sink, typed_stream
from support import SF_DIRS, fresh_dir

SF = SF_DIRS["0.001"]


def _input_folder(spark) -> str:
    path = os.path.join(fresh_dir("pg-stream-"), "in")
    files.write_parquet(traffic(spark, SF), path)
    return path


def test_typed_stream_to_parquet_equals_batch(spark):
    src = _input_folder(spark)
    out = os.path.join(fresh_dir("pg-stream-out-"), "typed")
    q = start_parquet_sink(typed_stream(spark, src), out, checkpoint=out + "_ckpt", available_now=True)
    q.awaitTermination(300)
    got = files.read_parquet(spark, out)
    want = type_traffic(traffic(spark, SF))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hourly_trend_stream_emits_closed_hours(spark):
    src = _input_folder(spark)
    name = "pg_trend_stream"
    q = (
        hourly_trend_stream(typed_stream(spark, src), delay="2 hours")
        .writeStream.outputMode("append")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", os.path.join(fresh_dir("pg-stream-ck-"), "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = spark.table(name)
    batch = hourly_trend(traffic(spark, SF))
    max_ts = traffic(spark, SF).agg(F.max("timestamp")).first()[0]
    # an hour is final once the watermark (max event time - delay) reaches its end
    closed = batch.filter(F.col("timestamp_hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts - dt.timedelta(hours=2)))
    assert got.count() > 0
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0


def test_typed_stream_from_csv_folder(spark):
    src = os.path.join(fresh_dir("pg-stream-csv-"), "in")
    files.write_csv(traffic(spark, SF), src)
    out = os.path.join(fresh_dir("pg-stream-csv-out-"), "typed")
    q = start_parquet_sink(typed_stream(spark, src, fmt="csv"), out, checkpoint=out + "_ckpt", available_now=True)
    q.awaitTermination(300)
    got = files.read_parquet(spark, out)
    want = type_traffic(traffic(spark, SF))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_restarted_sink_goes_on_where_it_stopped(spark):
    root = fresh_dir("pg-restart-")
    src, out = os.path.join(root, "in"), os.path.join(root, "out")
    rows = traffic(spark, SF).orderBy("vehicle_id")
    seen = 0
    for more in (10, 7, 3):
        part = rows.offset(seen).limit(more)
        part.coalesce(1).write.mode("append").parquet(src)
        seen += more
        query = start_parquet_sink(typed_stream(spark, src), out, checkpoint=os.path.join(root, "checkpoint"), available_now=True)
        query.awaitTermination(300)
        assert files.read_parquet(spark, out).count() == seen

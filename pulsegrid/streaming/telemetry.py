"""Structured Streaming forms of the telemetry operators.

Telemetry arrives one event a minute; the same operators run on a growing input
folder instead of a fixed file:

* :func:`typed_stream` - the stateless typed columns (risk index, severe flag,
  congestion weight) over a streaming file source with the explicit schema;
* :func:`hourly_trend_stream` - the hourly trend as an event-time tumbling
  window with a watermark, so each hour is emitted once (append mode) and its
  state is dropped when the watermark passes it;
* :func:`start_parquet_sink` - append the rows to Parquet; restarted with the same
  checkpoint folder, the query goes on after its last committed batch.

The rolling per-zone features need the previous events of the zone and stay a
batch operator (:mod:`pulsegrid.operators.rolling`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid import schemas as S
from pulsegrid.functions.columns import clean_doubles, hour_floor
from pulsegrid.operators.prepare import type_traffic
from pulsegrid.sources.files import READ_TIMESTAMP_FORMAT


def event_instant(ts: str) -> Column:
    """The wall-clock timestamp_ntz read as UTC, as a zoned timestamp.

    Watermarks need a zoned timestamp. UTC has no DST, so one-hour event-time
    windows over this instant are exactly the wall-clock hours of ``ts``,
    whatever the session time zone.
    """
    t = F.col(ts)
    return F.make_timestamp(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
        F.extract(F.lit("SECOND"), t), F.lit("UTC"),
    )


def read_traffic_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Streaming read of a traffic folder (Parquet or CSV) with the explicit schema."""
    reader = spark.readStream.schema(S.TRAFFIC_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = (
            reader.option("header", True)
            .option("timestampNTZFormat", READ_TIMESTAMP_FORMAT)
            .option("timestampFormat", READ_TIMESTAMP_FORMAT)
        )
    return clean_doubles(reader.load(path))


def typed_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The typed batch-job columns over a streaming traffic folder."""
    return type_traffic(read_traffic_stream(spark, path, fmt))


def hourly_trend_stream(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly means of density, anomaly score and accident probability, emitted per closed hour."""
    timed = stream.filter(F.col("timestamp").isNotNull()).withColumn("_event_time", event_instant("timestamp"))
    agg = (
        timed.withWatermark("_event_time", delay)
        .groupBy(F.window("_event_time", "1 hour").alias("_w"), hour_floor("timestamp").alias("timestamp_hour"))
        .agg(
            F.avg("traffic_density").alias("traffic_density"),
            F.avg("ai_anomaly_score").alias("ai_anomaly_score"),
            F.avg("accident_probability").alias("accident_probability"),
        )
    )
    return agg.select("timestamp_hour", "traffic_density", "ai_anomaly_score", "accident_probability").filter(
        F.col("traffic_density").isNotNull()
        & F.col("ai_anomaly_score").isNotNull()
        & F.col("accident_probability").isNotNull()
    )


def start_parquet_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to Parquet.

    ``checkpoint`` belongs to ``path``: give the same folder at every restart. A new
    one beside old output would number its batches from 0 again, and the output's
    commit log would skip them.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)

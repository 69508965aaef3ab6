"""Curation in increments: new days are curated alone, with the last rows of each zone carried in.

The rolling features of a row look back over the zone's last events. What an increment needs of all the
rows before it is therefore its zones' tails: the last N - 1 rows of every zone at the end of the day before. They
are kept beside the curated table, a few rows a zone and increment. An increment reads its own rows and one such
table, whatever has been curated before, and replaces its own days only.

    <curated_dir>/event_date=.../     curated rows (the columns of ``curate_traffic``)
    <tails_dir>/through=.../          the tails at the end of that day

A run that broke off is simply repeated: the days are written first, then the tails, and the tails
an increment starts from are those of days before it. Rows without a time come before all others, as in
the rolling window; they belong to the first increment. An increment must come after all that has
been curated, or replace the last one; anything else would leave later days with features of rows that changed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid import schemas as S
from pulsegrid.operators.prepare import type_traffic
from pulsegrid.operators.rolling import rolling_zone_features
from pulsegrid.session import remove_path, shared_scratch_path

#: what the rolling window orders by and averages
CARRIED = ["city_zone", "event_timestamp", "vehicle_id", "traffic_density", "average_speed"]
TAILS_SCHEMA = "city_zone string, event_timestamp timestamp_ntz, vehicle_id string, traffic_density double, average_speed double, through date"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def read_tails(spark: SparkSession, tails_dir: str) -> DataFrame:
    """The kept tails, with the day that each is ``through``; no rows before the first increment."""
    if not _exists(spark, tails_dir):
        return spark.createDataFrame([], TAILS_SCHEMA)
    return spark.read.schema(TAILS_SCHEMA).parquet(tails_dir)


def last_rows(rows: DataFrame, count: int) -> DataFrame:
    """The last ``count`` rows of every zone (NULL is one) in the order of the rolling window; map-side, a task ships that many a zone."""
    newest = Window.partitionBy("city_zone").orderBy(*[F.col(c).desc_nulls_last() for c in CARRIED[1:]])
    return rows.select(*CARRIED).withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= count).drop("_rn")


def _replace_days(df: DataFrame, path: str, column: str) -> None:
    """Write ``df`` by day; days it has are replaced, others stay as they are, file for file."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def curate_increment(traffic: DataFrame, curated_dir: str, tails_dir: str, events: int = S.ROLLING_EVENTS) -> dt.date | None:
    """Curate the days that ``traffic`` holds and add them to the table; returns its last day (None without any rows with a time)."""
    spark = traffic.sparkSession
    typed = type_traffic(traffic)
    day = F.to_date("event_timestamp")
    first, last, timeless = typed.agg(F.min(day), F.max(day), F.count_if(F.col("event_timestamp").isNull())).first()
    if first is None and not timeless:
        return None
    # days are dates, so those of the tails are read off their folders
    known = [r["through"] for r in read_tails(spark, tails_dir).select("through").distinct().collect()]
    days = sorted(d for d in known if d is not None)
    if known and timeless:
        raise ValueError("rows without a time belong to the first increment")
    if days and first is not None and days[-1] >= first and last != days[-1]:
        raise ValueError(f"{first} to {last} would come before or into {days[-1]}, which has been curated")
    before = [d for d in days if first is not None and d < first]
    from_day = F.col("through") == F.lit(before[-1]) if before else F.col("through").isNull() if None in known else F.lit(False)
    carried = read_tails(spark, tails_dir).filter(from_day).drop("through")

    rows = typed.withColumn("_carried", F.lit(False))
    both = rows.unionByName(carried.withColumn("_carried", F.lit(True)), allowMissingColumns=True)
    ordered_path = shared_scratch_path(spark, "increment-ordered")
    curated = rolling_zone_features(both, events=events, path=ordered_path).filter(~F.col("_carried")).drop("_carried")
    _replace_days(curated.withColumn("event_date", day), curated_dir, "event_date")
    tails = last_rows(typed.select(*CARRIED).unionByName(carried), events - 1)
    _replace_days(tails.withColumn("through", F.lit(last).cast("date")), tails_dir, "through")
    remove_path(spark, ordered_path)
    return last


def read_curated(spark: SparkSession, curated_dir: str) -> DataFrame:
    """The curated table of all increments, with its ``event_date`` to filter by."""
    return spark.read.parquet(curated_dir)

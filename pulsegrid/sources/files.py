"""File sources and sinks with explicit schemas.

Readers never infer a schema. CSV is read PERMISSIVE with a corrupt-record
column so malformed rows are counted instead of silently nulled; NaN in double
columns becomes NULL once, here, so later comparisons cannot turn NaN into True.

Writers are Spark writers: every executor writes its own part files, nothing is
collected to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.functions.columns import clean_doubles, q

CORRUPT_COLUMN = "_corrupt_record"

# Timestamps are written with all six fraction digits (Spark's default keeps
# three and would truncate microseconds); reading also accepts whole seconds.
WRITE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
READ_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read header CSV with a fixed schema.

    With ``keep_corrupt=True`` the result carries ``_corrupt_record`` (the raw
    line of rows that did not parse, else NULL); count it with
    :func:`corrupt_rows`.
    """
    read_schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    raw = (
        spark.read.schema(read_schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("timestampNTZFormat", READ_TIMESTAMP_FORMAT)
        .option("timestampFormat", READ_TIMESTAMP_FORMAT)
        .csv(path if isinstance(path, str) else list(path))
    )
    cleaned = clean_doubles(raw)
    return cleaned if keep_corrupt else cleaned.drop(CORRUPT_COLUMN)


def corrupt_rows(df_with_corrupt: DataFrame) -> DataFrame:
    """One-row count of malformed input rows."""
    # Spark converts only the columns that a query asks for, and a value that is not converted is
    # never found malformed: the row count goes over all of them on purpose
    missing = sum((F.col(q(c)).isNull().cast("int") for c in df_with_corrupt.columns if c != CORRUPT_COLUMN), F.lit(0))
    return df_with_corrupt.agg(
        F.count(F.col(CORRUPT_COLUMN)).alias("corrupt_rows"),
        (F.count_if(missing > 0) + F.count_if(missing == 0)).alias("input_rows"),
    )


def read_traffic_csv(spark: SparkSession, path: str) -> DataFrame:
    """Traffic telemetry CSV with its explicit schema."""
    return read_csv(spark, path, S.TRAFFIC_SCHEMA)


def read_icu_csv(spark: SparkSession, path: str) -> DataFrame:
    """ICU monitoring CSV with its explicit schema."""
    return read_csv(spark, path, S.ICU_SCHEMA)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone/weather profile CSV with its explicit schema."""
    return read_csv(spark, path, S.SUMMARY_SCHEMA)


def read_anomalies_csv(spark: SparkSession, path: str) -> DataFrame:
    """Top-risk export CSV with its explicit schema."""
    return read_csv(spark, path, S.ANOMALIES_SCHEMA)


def read_icu_preprocessed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Preprocessed ICU CSV with its explicit schema."""
    return read_csv(spark, path, S.ICU_PREPROCESSED_SCHEMA)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, optionally with an explicit schema (no footer inference then); NaN reads as NULL."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return clean_doubles(reader.parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` with header CSV part files.

    ``single_file`` funnels the output through one task; use it only for
    results whose size is bounded (summaries, top-k), never for row-level data.
    """
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", WRITE_TIMESTAMP_FORMAT)
        .option("timestampFormat", WRITE_TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_bucketed(df: DataFrame, path: str, buckets: int, by: Sequence[str], compression: str = "snappy") -> DataFrame:
    """Write ``df`` to ``path`` in ``buckets`` hash buckets of ``by`` and return it as a table that Spark knows to be dealt out so.

    Windows, aggregates and joins on ``by`` then read their rows from the files without another shuffle. Bucketing is
    part of a table's entry in the session's catalog: the entry lives for this call alone, the files stay, and the returned
    DataFrame keeps the layout. At most ``spark.sql.sources.bucketing.maxBuckets`` buckets.
    """
    spark = df.sparkSession
    name = f"pulsegrid_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    writer = df.write.mode("overwrite").format("parquet").option("path", path).option("compression", compression)
    writer.bucketBy(max(1, min(buckets, most)), *by).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    spread_by: Sequence[Column] = (),
    sort_by: Sequence[str] = (),
    bloom: dict[str, int] | None = None,
    row_group_bytes: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Overwrite ``path`` with Parquet, optionally partitioned by columns.

    Partitioned rows are first rebalanced over those columns and ``spread_by`` (say the day), so a folder gets few
    files, and adaptive execution merges small ones and cuts a hot one up. ``sort_by`` orders the rows of each file,
    so that the minima and maxima of row groups and pages let a filter on these columns skip the others.
    ``bloom`` names columns that get Bloom filters, with the distinct values to expect in a row group: for
    look-ups of values that lie scattered. ``row_group_bytes``: Spark's default if None.
    """
    partition_by = list(partition_by or [])
    if partition_by:
        # the hint takes columns only
        helper = {f"_spread_{k}_{uuid.uuid4().hex}": c for k, c in enumerate(spread_by)}
        df = df.withColumns(helper).hint("rebalance", *[F.col(q(c)) for c in [*partition_by, *helper]]).drop(*helper)
    if sort_by:
        df = df.sortWithinPartitions(*[F.col(q(c)) for c in [*partition_by, *sort_by]])
    writer = df.write.mode(mode)
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")  # no larger than the values need
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)

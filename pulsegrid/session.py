"""Session helpers: building a session for scripts/tests and finding shared folders.

Library code never builds or stops a session; the caller owns it. Shared scratch
space (checkpoints, sink round-trips, materialised intermediate tables) always
lives under the folder the cluster names in ``spark.checkpoint.dir``; a
machine-local temporary folder is only ever chosen by tests, and only when that
setting is unset.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: bytes of input that one range partition should hold
RANGE_BYTES = 128 << 20
SCRATCH = "pulsegrid-scratch"
CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    master: str | None = None,
    app_name: str = "pulsegrid",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings this library is tuned for.

    AQE is on so that shuffle partitions are coalesced or split at run time and
    skewed join partitions are split; the UI stays off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the session.

    The folder comes from ``spark.checkpoint.dir`` (or an already configured
    SparkContext checkpoint dir). ``fallback`` is only for tests and local
    scripts where the setting is unset; on a cluster the setting must name a
    shared file system.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if fallback is None:
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder every executor can reach"
            )
        configured = fallback
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, SCRATCH, f"{name}-{uuid.uuid4().hex}")


def range_count(df: DataFrame, target_bytes: int = RANGE_BYTES) -> int:
    """Most partitions that ordering or dealing out ``df`` takes: the optimizer's size estimate over ``target_bytes``, at least the session's shuffle partitions.

    The estimate does not see what filters and joins leave; see :func:`into_ranges`.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # an estimate without statistics is astronomically large; 2**20 ranges of 128 MB are 128 TB
    return min(max(least, -(-size // target_bytes)), 1 << 20) if size < 1 << 60 else least


def observed(observation: Observation, fallback: Callable[[], dict]) -> dict:
    """The observed metrics of a job that has run, or ``fallback()`` when Catalyst dropped the metrics node of a provably empty input."""
    try:
        return dict(observation.get)
    except Py4JJavaError as e:
        # no plan reported metrics: the JVM then fails to turn them into a row
        if "toPyRow" not in str(e):
            raise
        return fallback()


def _is_on(spark: SparkSession, key: str) -> bool:
    return spark.conf.get(key, "true") == "true"


@contextmanager
def ranges_by_size(df: DataFrame) -> Iterator[None]:
    """While a job over ``into_ranges(df, ...)`` runs: it starts from :func:`range_count` partitions, and adaptive execution merges them by the rows that came.

    An explicit number of partitions is never merged, so the number has to be a setting of the session for as long.
    """
    spark = df.sparkSession
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, str(range_count(df)))
    try:
        yield
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)


def into_ranges(df: DataFrame, *keys: str | Column, ranges: int | None = None) -> DataFrame:
    """``df`` in ranges of ``keys``: ``ranges`` of them, or else as many as its rows fill when the job runs within :func:`ranges_by_size`."""
    spark = df.sparkSession
    if ranges is None and _is_on(spark, "spark.sql.adaptive.enabled") and _is_on(spark, "spark.sql.adaptive.coalescePartitions.enabled"):
        return df.repartitionByRange(*keys)
    return df.repartitionByRange(ranges or range_count(df), *keys)


def remove_scratch(spark: SparkSession) -> bool:
    """Delete every scratch table that this session's queries and jobs wrote; for when their results are done with."""
    return remove_path(spark, os.path.join(ensure_checkpoint_dir(spark), SCRATCH))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote (e.g. a job's staged copy) on any Hadoop file system.

    Only for scratch output whose readers are finished; returns whether
    something was deleted.
    """
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))

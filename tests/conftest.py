from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pulsegrid.session import ensure_checkpoint_dir
    from support import fresh_dir

    session = (
        SparkSession.builder.master("local[*]")
        .appName("pulsegrid-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests only: a local checkpoint folder when the session names none
    ensure_checkpoint_dir(session, fallback=fresh_dir("pg-ckpt-"))
    yield session
    session.stop()

"""Test helpers: a local session and an order-insensitive Spark vs DuckDB comparison."""

from __future__ import annotations

import datetime as dt
import math
import os
import tempfile

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SF_DIRS = {sf: f"/root/testdata/sf{sf}" for sf in ("0.001", "0.01", "0.1")}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm_value(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).to_pydatetime().replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalar
        return _norm_value(v.item())
    return v


def _rows(pdf: pd.DataFrame, cols: list[str]) -> list[tuple]:
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_value(v) for v in rec))
    return out


def _sort_key(row: tuple):
    key = []
    for v in row:
        if v is None:
            key.append((0, ""))
        elif isinstance(v, bool):
            key.append((1, str(v)))
        elif isinstance(v, (int, float)):
            key.append((2, f"{round(float(v), 6):+.6f}"))
        else:
            key.append((3, str(v)))
    return key


def _close(a, b, rel=1e-9, abs_=1e-9) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return bool(a) == bool(b)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=abs_)
    return a == b


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> list[str]:
    """Return a list of differences (empty when the results agree)."""
    problems = []
    s_cols, d_cols = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if s_cols != d_cols:
        return [f"columns differ: spark={s_cols} duck={d_cols}"]
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}")
        return problems
    s_rows = sorted(_rows(spark_pdf, s_cols), key=_sort_key)
    d_rows = sorted(_rows(duck_pdf, s_cols), key=_sort_key)
    bad = 0
    for sr, drow in zip(s_rows, d_rows):
        for c, a, b in zip(s_cols, sr, drow):
            if not _close(a, b):
                bad += 1
                if bad <= 5:
                    problems.append(f"{c}: spark={a!r} duck={b!r}")
    if bad:
        problems.append(f"{bad} differing values")
    return problems


def fresh_dir(prefix: str = "pg-") -> str:
    return tempfile.mkdtemp(prefix=prefix, dir="/tmp")


def direct_rolling_features(typed):
    """The rolling zone features as one window per zone, in SQL."""
    columns = ", ".join(typed.columns)
    return typed.sparkSession.sql(
        f"""select {columns}, round(avg(traffic_density) over w, 2) as rolling_density_6_event,
                   round((avg(average_speed) over w) - average_speed, 2) as speed_drop_from_zone_avg
            from {{rows}} window w as (partition by city_zone
              order by event_timestamp nulls first, vehicle_id nulls first, traffic_density nulls first, average_speed nulls first
              rows between 5 preceding and current row)""",
        rows=typed,
    )

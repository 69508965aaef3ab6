"""The driver contract: entry(), queries(), oracle_sql()."""

from __future__ import annotations

from pyspark.sql import DataFrame

import __spark_entry__ as entry_module
from pulsegrid import schemas as S
from pulsegrid.catalog import QUERIES


def test_entry_returns_the_flagship_profile(spark):
    df = entry_module.entry(spark)
    assert isinstance(df, DataFrame)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in S.SUMMARY_SCHEMA]
    assert df.count() > 0


def test_queries_and_oracles_line_up():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(QUERIES) <= set(queries) and set(QUERIES) <= set(oracles) and len(QUERIES) == 54
    assert set(oracles) <= set(queries)
    assert all(callable(q) for q in queries.values())
    assert all(isinstance(sql, str) and sql.strip() for sql in oracles.values())

"""Every registered query against its DuckDB SQL on the sf0.01 tables."""

from __future__ import annotations

import pytest

from pulsegrid.catalog import QUERIES
from pulsegrid.oracles import ORACLE_SQL as ORACLES
from support import SF_DIRS, compare, duck_connection

SF = SF_DIRS["0.01"]


@pytest.fixture(scope="module")
def duck():
    con = duck_connection(SF)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLES[name]).to_arrow_table().to_pandas()
    problems = compare(got, want)
    assert not problems, f"{name}: " + "; ".join(problems)


SMALL_SF = SF_DIRS["0.001"]


@pytest.fixture(scope="module")
def duck_small():
    con = duck_connection(SMALL_SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_on_smallest_tables(spark, duck_small, name):
    got = QUERIES[name](spark, SMALL_SF).toPandas()
    want = duck_small.sql(ORACLES[name]).to_arrow_table().to_pandas()
    problems = compare(got, want)
    assert not problems, f"{name}: " + "; ".join(problems)

"""Every registered query against its comparison SQL."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from conftest import SMALL
from workload import oracles, queries
from workload.compare import difference, duckdb_rows, duckdb_views, spark_rows

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def connection():
    return duckdb_views(SMALL)


def test_every_query_has_sql():
    assert queries.queries().keys() == oracles.oracle_sql().keys()
    assert queries.queries().keys() <= entry_point.queries().keys()
    assert oracles.oracle_sql().items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_same_rows(spark, connection, name):
    mine = spark_rows(queries.queries()[name](spark, SMALL))
    other = duckdb_rows(connection, oracles.oracle_sql()[name])
    assert difference(mine, other) == ""


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0

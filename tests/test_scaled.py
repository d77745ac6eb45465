"""Copies of the driver tables, for timing at other sizes."""

from __future__ import annotations

from pathlib import Path

import pytest

from conftest import SMALL
from workload import oracles, queries
from workload.compare import difference, duckdb_rows, duckdb_views, spark_rows
from workload.scaled import KEYS, scaled

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="driver tables are absent")


def test_copies_have_their_own_keys_and_the_same_results(spark, tmp_path):
    out = scaled(spark, SMALL, str(tmp_path), 3)
    for name, keys in KEYS.items():
        old, new = (spark.read.parquet(f"{x}/{name}.parquet") for x in (SMALL, out))
        assert new.columns == old.columns and new.count() == 3 * old.count()
        assert new.select(keys[0]).distinct().count() == 3 * old.select(keys[0]).distinct().count()
    query, sql = queries.queries()["mrr_monthly"], oracles.oracle_sql()["mrr_monthly"]
    mine = spark_rows(query(spark, out))
    assert difference(mine, duckdb_rows(duckdb_views(out), sql)) == ""
    assert sum(mine[1].values()) >= 2 * sum(spark_rows(query(spark, SMALL))[1].values())

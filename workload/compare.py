"""Run queries and their comparison SQL side by side on one directory of tables."""

from __future__ import annotations

import math
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duckdb_views(sf_dir: str, threads: int = 8) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect(config={"threads": threads})
    for name in TABLES:
        path = Path(sf_dir, f"{name}.parquet")
        if path.exists():
            files = f"{path}/*.parquet" if path.is_dir() else path
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(_plain(row[at]) for at in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def duckdb_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def difference(left: tuple[list[str], Counter], right: tuple[list[str], Counter]) -> str:
    """Empty when equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[1] == right[1]:
        return ""
    missing, extra = right[1] - left[1], left[1] - right[1]
    return (
        f"{sum(left[1].values())} / {sum(right[1].values())} rows, "
        f"{sum(missing.values())} missing e.g. {next(iter(missing), None)}, "
        f"{sum(extra.values())} extra e.g. {next(iter(extra), None)}"
    )


def main() -> None:
    import sys

    from tenureline.session import local_session
    from workload.oracles import oracle_sql
    from workload.queries import queries

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duckdb_views(sf_dir), oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        mine = spark_rows(query(spark, sf_dir))
        spark_seconds = time.time() - started
        started = time.time()
        other = duckdb_rows(connection, sql[name]) if name in sql else mine
        duckdb_seconds = time.time() - started
        verdict = difference(mine, other) or ("ok" if name in sql else "no sql")
        rows = sum(mine[1].values())
        seconds = f"{spark_seconds:6.2f}s {duckdb_seconds:6.2f}s"
        print(f"{name:34} {rows:8} {seconds} {verdict}", flush=True)


if __name__ == "__main__":
    main()

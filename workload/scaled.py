"""Larger tables from the driver's: copies with keys of their own, for timing at other sizes."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Tables that the timed queries read, and the keys that tell copies apart.
KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "part": ["p_partkey"],
    "supplier": ["s_suppkey"],
}
#: Copies lie multiples of this apart: 4 * 11 * 13 * 23, the moduli of the subscription formulas,
#: so that a copy has the same mix of plans, statuses and ends.
STEP = 13_156


def scaled(spark: SparkSession, sf_dir: str, out: str, copies: int) -> str:
    """Writes ``copies`` of each table under ``out``; every copy has customers and orders of its own.

    Rows are made by Spark from the tables' rows, so nothing of them passes the driver but the
    largest key of each table.
    """
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in KEYS}
    owners = {"c_custkey": "customer", "o_custkey": "customer", "o_orderkey": "orders", "p_partkey": "part", "s_suppkey": "supplier"}
    largest = {name: df.agg(F.max(KEYS[name][0])).first()[0] or 0 for name, df in tables.items()}
    apart = {name: -(-(int(key) + 1) // STEP) * STEP for name, key in largest.items()}
    for name, df in tables.items():
        copied = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("copy", F.col("copy").cast("long"))
        for key in KEYS[name]:
            copied = copied.withColumn(key, F.col(key) + F.col("copy") * apart[owners[key]])
        copied.select(df.columns).write.parquet(f"{out}/{name}.parquet")
    return out

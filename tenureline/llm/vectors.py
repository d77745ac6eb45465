"""Vectors in Arrow batches as padded matrices, and blocks of them as single rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Not null, and no component null or not finite."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & ~F.coalesce(odd, F.lit(False))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of a list column in double precision, filled with zeros up to ``dims``."""
    lengths = column.value_lengths().to_numpy().astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dims).all():
        return values.reshape(len(column), dims)
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def joined(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a partition whose size its caller bounds."""
    held = [x for x in batches if x.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


@contextmanager
def small_batches(spark: SparkSession, rows: int):
    """Rows that carry whole blocks go to Python few at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)

"""Delimited extracts with a header row and a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Doubled quotes inside quoted fields, blanks kept: the usual spreadsheet dialect.
_DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_extract(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Read without inference; a wrong header or a malformed row fails the read.

    Every column is parsed even if few are used, else malformed rows could pass unseen.
    Fields with line breaks need ``multiLine=True``, which makes a file unsplittable.
    """
    settings = {
        **_DIALECT, "enforceSchema": False, "mode": "FAILFAST", "columnPruning": False, **options
    }
    return spark.read.schema(schema).options(**settings).csv(path)


def write_extract(df: DataFrame, path: str, **options) -> str:
    df.write.mode("overwrite").options(**{**_DIALECT, **options}).csv(path)
    return path

"""Tables that several jobs read, stored once in the folder that all executors share."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame

from tenureline.sources.publish import fresh_path, remove, stage_at

#: Where tables that were stored and not yet released lie.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: its rows are fixed and its lineage ends here.

    The files go with ``release``, or with an enclosing ``publish.scratch``.
    """
    path = fresh_path(df.sparkSession, f"llm-{name}")
    out = stage_at(df, path)
    _PLACES[out] = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more; others are left alone."""
    for df in tables:
        if path := _PLACES.pop(df, None):
            remove(df.sparkSession, path)

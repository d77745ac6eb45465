"""Orderings with explicit null placement, for windows and for aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nulls_last(columns: Sequence[str]) -> list[Column]:
    """Sort order from names; a leading ``-`` means descending. Nulls always go last."""
    return [
        F.desc_nulls_last(name[1:]) if name.startswith("-") else F.asc_nulls_last(name)
        for name in columns
    ]


def sort_key(*columns: Column) -> Column:
    """Struct that sorts ascending with nulls last, usable in ``min_by`` and ``<``."""
    fields = []
    for position, column in enumerate(columns):
        fields.append(column.isNull().alias(f"null_{position}"))
        fields.append(column.alias(f"value_{position}"))
    return F.struct(*fields)

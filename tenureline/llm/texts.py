"""Texts in Arrow batches, a bounded amount of them at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from .kept import give_back

#: Rows handed on at once; a batch of long texts stays one batch of references to Arrow memory.
ROWS = 512


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of few rows, so that only their texts are Python strings at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)
    give_back()


def strings(column: pa.Array) -> list[str]:
    """Null is the empty text."""
    return [x or "" for x in column.to_pylist()]

"""Connected components of a graph given as pairs, by alternating large and small stars.

Every task first thins its links to a spanning forest. What fits one task by a fixed bound is
joined there; beyond it, every round links each node to the smallest neighbour it knows of, and
the number of rounds grows with the logarithm of the longest path. Rounds are stored, so that a
lost executor costs a read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import release, stored

PAIRS = "hi long, lo long"
#: Thinned links that one task joins: 16 bytes each.
TASK_LINKS = 500_000


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that join what the links (a, b) join, at most one per node."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = where[: len(a)], where[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        np.minimum.at(root, before[left], least)
        np.minimum.at(root, before[right], least)
        root = root[root]
        if np.array_equal(root, before):
            break
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hi, lo = spanning_links(*(batch.column(i).to_numpy() for i in (0, 1)))
        yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo)], names=["hi", "lo"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task, over all links, of which there are at most TASK_LINKS: the component of every node."""
    held = [[x.column(i).to_numpy() for i in (0, 1)] for x in batches]
    if held:
        node, root = spanning_links(*(np.concatenate(x) for x in zip(*held, strict=True)))
        roots = np.unique(root)
        columns = [pa.array(np.concatenate([node, roots])), pa.array(np.concatenate([root, roots]))]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "component"])


def connected_components(pairs: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``pairs``: its first two columns, longs, not null.

    ``component`` is the smallest node that links reach. Repeated pairs and pairs of a node with
    itself change nothing; a node that only meets itself may be absent.
    """
    a, b = (F.col(f"`{name}`") for name in pairs.columns[:2])
    pairs = pairs.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    pairs = stored(pairs.mapInArrow(_thinned, PAIRS).distinct(), "links")
    if pairs.count() <= TASK_LINKS:
        return _ended(pairs.coalesce(1).mapInArrow(_joined, "node long, component long"), pairs)
    state = None
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi != lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        before = pairs
        pairs = stored(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        release(before)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pairs.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return _ended(pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots), pairs)


def _ended(found: DataFrame, pairs: DataFrame) -> DataFrame:
    found = stored(found, "components")
    release(pairs)
    return found

"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors of cosine c lie sqrt(2 - 2 c) apart: epsilon for the threshold. Vectors are sorted
by label and by their grid cells of width epsilon on the leading principal dimensions, and the
sequence is cut into blocks. A block is joined with an interval of the sequence by halving it,
skipping intervals whose labels or boxes in the principal dimensions are provably apart; two
blocks that remain are compared by one matrix product. Block pairs that lie together in the square
of the sequence share a cell and are compared in one task, so a block moves once per cell. A block
pair gives link counts and the links that span its groups, never a row per link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, spanning_links
from .staging import stored
from .vectors import joined, matrix, usable

#: Vectors of a block, and most blocks of the sequence: beyond, blocks grow, so that the boxes
#: of all blocks stay within about 4 MB.
BLOCK_VECTORS, MOST_BLOCKS = 2048, 1 << 15
#: Bytes of the vectors of a cell, the square of block pairs that is compared in one task.
CELL_BYTES = 32 << 20
#: Leading principal dimensions of the grid.
GRID_DIMS = 4
#: Rows of a block compared at once.
TILE = 1024
_FOUND = pa.schema([("kind", pa.int8()), ("class", pa.int64()), ("value", pa.int64())])
_BLOCK = "block int, n int, labels array<long>, low array<double>, high array<double>, ids binary, label binary, copies binary, vectors binary"


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(dims: int):
    """Task: sums of its unit vectors and of their products, as (place, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, first, second = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            x = _unit(matrix(batch.column(0), dims))
            count, first, second = count + len(x), first + x.sum(axis=0), second + x.T @ x
        if count:
            out = np.concatenate([[count], first, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(out)], names=["place", "value"])

    return run


def _axes(classes: DataFrame, dims: int) -> np.ndarray:
    """Leading eigenvectors of the covariance over all vectors; dims x dims sums reach the driver."""
    sums = classes.select("embedding").mapInArrow(_moments(dims), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    flat = sums.sort_values("place")["value"].to_numpy()
    if not len(flat):
        return np.zeros((dims, 0))
    mean = flat[1 : dims + 1] / flat[0]
    _, vectors = np.linalg.eigh(flat[dims + 1 :].reshape(dims, dims) / flat[0] - np.outer(mean, mean))
    return vectors[:, ::-1][:, :GRID_DIMS]


def _placed(dims: int, axes: np.ndarray, epsilon: float):
    """Task: adds the principal coordinates and the grid cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _unit(matrix(batch.column("embedding"), dims)) @ axes
            cells = np.floor(at / epsilon).astype(np.int32)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.array(x.ravel()).type)) for x in (at, cells)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "at", "cell"])

    return run


def _as_block(dims: int):
    """Task: its sorted rows as one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = joined(batches)
        if rows is None:
            return
        col = lambda name: rows.column(name).combine_chunks()
        labels = col("label").to_numpy().astype(np.int64)
        at = matrix(col("at"), len(rows.column("at")[0]))
        values = [
            TaskContext.get().partitionId(),
            len(rows),
            [int(labels.min()), int(labels.max())],
            at.min(axis=0).tolist(),
            at.max(axis=0).tolist(),
            col("class").to_numpy().astype(np.int64).tobytes(),
            labels.tobytes(),
            col("copies").to_numpy().astype(np.int64).tobytes(),
            _unit(matrix(col("embedding"), dims)).tobytes(),
        ]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 2, *[pa.binary()] * 4]
        names = ["block", "n", "labels", "low", "high", "ids", "label", "copies", "vectors"]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    return run


class Intervals:
    """The sequence of blocks, halved down to single blocks, with labels and boxes of each part."""

    def __init__(self, blocks: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray, epsilon: float):
        self.blocks, self.labels, self.low, self.high, self.epsilon = blocks, labels, low, high, epsilon
        self.parts: dict[tuple[int, int], tuple] = {}
        if len(blocks):
            self._cover(0, len(blocks))

    def _cover(self, i: int, j: int) -> tuple:
        if j - i == 1:
            own = (self.labels[i, 0], self.labels[i, 1], self.low[i], self.high[i])
        else:
            a, b = self._cover(i, (i + j) // 2), self._cover((i + j) // 2, j)
            own = (min(a[0], b[0]), max(a[1], b[1]), np.minimum(a[2], b[2]), np.maximum(a[3], b[3]))
        self.parts[i, j] = own
        return own

    def _apart(self, a: tuple, b: tuple) -> bool:
        if a[1] < b[0] or b[1] < a[0]:
            return True
        gap = np.maximum(0, np.maximum(a[2] - b[3], b[2] - a[3]))
        return float(gap @ gap) > self.epsilon**2 * (1 + 1e-9)

    def partners(self, own: int) -> list[int]:
        """Positions from ``own`` on whose blocks may hold a link with it."""
        found, open_ = [], [(0, len(self.blocks))]
        while open_:
            i, j = open_.pop()
            if j <= own or self._apart(self.parts[own, own + 1], self.parts[i, j]):
                continue
            if j - i == 1:
                found.append(i)
            else:
                open_ += [(i, (i + j) // 2), ((i + j) // 2, j)]
        return found


def _block_pairs(intervals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Intervals(*intervals.value)
        position = {int(b): k for k, b in enumerate(tree.blocks)}
        for batch in batches:
            for block in batch.column(0).to_pylist():
                found = tree.blocks[tree.partners(position[block])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block, np.int32)), pa.array(found.astype(np.int32))], names=["left", "right"])

    return run


def _cell_blocks(n_blocks: int, dims: int) -> int:
    """Blocks on each side of a cell: as many as fit its bytes, fewer where cells would be few."""
    return max(1, min(CELL_BYTES // (2 * BLOCK_VECTORS * 8 * max(dims, 1)), n_blocks // 8))


def _compared(dims: int, threshold: float):
    """Group: the blocks of one cell and its block pairs; gives (0, class, linked vectors) and
    spanning links (1, class, class) of each pair."""

    def block(rows: pa.Table, k: int) -> tuple:
        raw = [rows.column(x)[k].as_buffer() for x in ("ids", "label", "copies", "vectors")]
        ids, label, copies = (np.frombuffer(x, np.int64) for x in raw[:3])
        return ids, label, copies, np.frombuffer(raw[3], np.float64).reshape(len(ids), dims)

    def pair(a: tuple, b: tuple, same: bool) -> pa.RecordBatch | None:
        counts = np.zeros(len(a[0]), np.int64), np.zeros(len(b[0]), np.int64)
        links = []
        for i in range(0, len(a[0]), TILE):
            for j in range(i if same else 0, len(b[0]), TILE):
                s, t = slice(i, i + TILE), slice(j, j + TILE)
                r, c = np.nonzero((a[3][s] @ b[3][t].T >= threshold) & (a[1][s, None] == b[1][None, t]))
                if same and i == j:
                    r, c = r[r < c], c[r < c]
                if len(r):
                    counts[0][s] += np.bincount(r, b[2][t][c], len(counts[0][s])).astype(np.int64)
                    counts[1][t] += np.bincount(c, a[2][s][r], len(counts[1][t])).astype(np.int64)
                    links.append(spanning_links(a[0][s][r], b[0][t][c]))
        if not links:
            return None
        hi, lo = spanning_links(*(np.concatenate(x) for x in zip(*links, strict=True)))
        hit = [x > 0 for x in counts]
        ids = np.concatenate([a[0][hit[0]], b[0][hit[1]], hi])
        value = np.concatenate([counts[0][hit[0]], counts[1][hit[1]], lo])
        kind = np.concatenate([np.zeros(len(ids) - len(hi), np.int8), np.ones(len(hi), np.int8)])
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(ids), pa.array(value)], schema=_FOUND)

    def run(rows: pa.Table) -> pa.Table:
        held = {number: block(rows, k) for k, number in enumerate(rows.column("block").to_pylist())}
        pairs = [(x["left"], x["right"]) for x in rows.column("pairs")[0].as_py()]
        found = (pair(held[left], held[right], left == right) for left, right in pairs)
        return pa.Table.from_batches([x for x in found if x is not None], schema=_FOUND)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors`` (vec_id, embedding, label).

    Rows link when their labels are equal and not null and their cosine in double precision is
    ``threshold`` or more. Defined cases: vectors that are null, zero, empty or hold null or
    non-finite components, and rows without label, have no links; of vectors of different length
    the shorter is filled with zeros; repeated rows count as vectors of their own; a null vec_id
    takes part, is never a component_id beside others, and is not kept; an empty table gives an
    empty table; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", "label")
    some = F.exists("embedding", lambda x: x != 0)
    fit = rows.where(usable(F.col("embedding")) & some & F.col("label").isNotNull())
    classes = fit.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "vectors")
    dims, n = classes.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0)), F.count("*")).first()

    epsilon = float(np.sqrt(2 - 2 * threshold))
    axes = _axes(classes, dims)
    kind = "label long, class long, copies long, embedding array<double>"
    typed = classes.selectExpr("CAST(label AS LONG) AS label", "class", "copies", "CAST(embedding AS array<double>) AS embedding")
    placed = typed.mapInArrow(_placed(dims, axes, epsilon), f"{kind}, at array<double>, cell array<int>")
    n_blocks = max(1, min(MOST_BLOCKS, -(-n // BLOCK_VECTORS)))
    ordered = placed.repartitionByRange(n_blocks, "label", "cell", "class").sortWithinPartitions("label", "cell", "class")
    blocks = stored(ordered.mapInArrow(_as_block(dims), _BLOCK), "blocks")

    boxes = blocks.select("block", "labels", "low", "high").orderBy("block").toPandas()
    stacked = [np.array(boxes[c].tolist()) for c in ("labels", "low", "high")]
    intervals = spark.sparkContext.broadcast((boxes["block"].to_numpy(), *stacked, epsilon))
    pairs = blocks.select("block").repartition(max(1, min(n_blocks, 256))).mapInArrow(_block_pairs(intervals), "left int, right int")
    # a block travels once to each cell that needs it, and not once per pair
    side = _cell_blocks(n_blocks, dims)
    cell = [F.floor(F.col(x) / side).cast("int").alias(f"{x}_cell") for x in ("left", "right")]
    cells = pairs.groupBy(*cell).agg(F.collect_list(F.struct("left", "right")).alias("pairs"))
    needed = cells.withColumn("block", F.explode(F.array_union("pairs.left", "pairs.right")))
    facing = needed.join(blocks.select("block", "ids", "label", "copies", "vectors"), "block")
    found = facing.groupBy("left_cell", "right_cell").applyInArrow(_compared(dims, threshold), "kind byte, class long, value long")
    found = stored(found, "near")

    counts = found.where("kind = 0").groupBy("class").agg(F.sum("value").alias("linked"))
    labels = connected_components(found.where("kind = 1").select("class", "value")).select(F.col("node").alias("class"), "component")
    known = classes.join(counts, "class", "left").join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("label", "embedding", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")

    usable_rows = rows.withColumn("fit", F.coalesce(usable(F.col("embedding")) & some & F.col("label").isNotNull(), F.lit(False)))
    out = usable_rows.where("fit").join(known, ["label", "embedding"])
    out = out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"))
    alone = usable_rows.where("NOT fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

"""Chat formatting by a prefix tree.

Conversations that begin with the same turns share the nodes of these turns, and a node's text is
emitted once. The order of emission is depth first: conversations sorted by their paths, the
digests of all their beginnings; of each, the nodes that the one before it lacks. A node has its
interval in that order, position ids that count from the root of its path, and the intervals that
its ancestors cover, all that its characters attend to besides themselves. The unit is the character
here; a tokeniser applied to each node's text gives tokens in the same layout.

A turn is ``<s>role[INST]text</s>``. Control strings inside role or text get a backslash after
their first character, and one more where backslashes stand there already, so that the
original can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stored
from .texts import slices

OPEN, BODY, CLOSE = "<s>", "[INST]", "</s>"
#: Paths sorted in one task.
PATH_ROWS = 50_000
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def rendered(role: str, text: str) -> str:
    return f"{OPEN}{escaped(role)}{BODY}{escaped(text)}{CLOSE}"


def parsed(piece: str) -> tuple[str, str]:
    role, _, text = piece[len(OPEN) : -len(CLOSE)].partition(BODY)
    return unescaped(role), unescaped(text)


def _digest(parent: str, role: str, text: str) -> str:
    data = f"{parent}\n{len(role)}\n{role}{text}".encode("utf-8", "surrogatepass")
    return hashlib.blake2b(data, digest_size=16).hexdigest()


_TURN = "conv long, conv_id long, seq int, last boolean, node string, tree string, parent string, position long, piece string, mask_start int, mask_length int, path array<string>, ends array<long>"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task, over rows sorted by conversation and turn: a row per turn, and one with the path and
    its summed lengths per conversation (seq -1)."""
    base = TaskContext.get().partitionId() << 40
    number, rows = -1, []
    now, path, ends = (), [], []
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), *[pa.string()] * 3, pa.int64(), pa.string(), *[pa.int32()] * 2, pa.list_(pa.string()), pa.list_(pa.int64())]
    names = ["conv", "conv_id", "seq", "last", "node", "tree", "parent", "position", "piece", "mask_start", "mask_length", "path", "ends"]

    def close() -> None:
        if path:
            rows[-1][3] = True
            rows.append([base + number, now[0], -1, None, path[-1], path[0], *[None] * 5, path, ends])

    def batch(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    for part in slices(batches):
        for conv_id, role, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if now != (conv_id,):
                close()
                now, number, path, ends = (conv_id,), number + 1, [], []
            role, text = role or "", text or ""
            piece = rendered(role, text)
            parent, position = (path[-1], ends[-1]) if path else (None, 0)
            node = _digest(parent or "", role, text)
            start = len(OPEN) + len(escaped(role)) + len(BODY)
            mask = (start, len(piece) - len(CLOSE) - start) if role == "assistant" else (None, None)
            rows.append([base + number, conv_id, len(path), False, node, path[0] if path else node, parent, position, piece, *mask, None, None])
            path.append(node)
            ends.append(position + len(piece))
        # the last turn may turn out to be its conversation's last one
        if len(rows) > 1:
            yield batch(rows[:-1])
            rows = rows[-1:]
    close()
    if rows:
        yield batch(rows)


def _shared(a: list[str], b: list[str]) -> int:
    """Nodes that two paths have in common. A node's digest covers all before it, so paths that
    differ at one place differ at all later ones."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[half - 1] == b[half - 1] else (low, half - 1)
    return low


_PLACED = "part int, conv long, n int, shared int, cut long, start long, size long, first array<string>, ends array<long>, last array<string>"


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task, over paths in order: how many nodes each shares with the one before, their length,
    where its own nodes start within the task; and one row (conv null) with the task's outer paths."""
    at, before, start, first = TaskContext.get().partitionId(), [], 0, None
    kinds = [pa.int32(), pa.int64(), *[pa.int32()] * 2, *[pa.int64()] * 3, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string())]
    names = ["part", "conv", "n", "shared", "cut", "start", "size", "first", "ends", "last"]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for part in slices(batches):
        rows = []
        for conv, path, ends in zip(*(part.column(x).to_pylist() for x in ("conv", "path", "ends")), strict=True):
            first = first or (path, ends, conv)
            shared = _shared(path, before)
            cut = ends[shared - 1] if shared else 0
            rows.append((at, conv, len(path), shared, cut, start, None, None, None, None))
            start += ends[-1] - cut
            before = path
        yield batch(rows)
    if first:
        yield batch([(at, first[2], None, None, None, None, start, first[0], first[1], before)])


def _corrected(ordered: DataFrame) -> DataFrame:
    """``(conv, n, shared, cut, start)`` with the true share and start: the first path of a task
    shares with the last of the task before, and tasks follow one another. Five numbers per task
    reach the driver; the paths between them are compared in Spark."""
    spark = ordered.sparkSession
    outer = ordered.where("size IS NOT NULL").drop("shared", "cut")
    parts = sorted(row["part"] for row in outer.select("part").collect())
    follows = spark.createDataFrame(list(pairwise(parts)), "before int, part int")
    left = outer.select(F.col("part").alias("before"), F.col("last").alias("left"))
    common = F.size(F.array_intersect("left", "first"))
    edges = outer.join(follows, "part", "left").join(left, "before", "left").withColumn("shared", F.coalesce(F.when(F.col("left").isNotNull(), common), F.lit(0)))
    edges = edges.withColumn("cut", F.when(F.col("shared") > 0, F.element_at("ends", F.col("shared"))).otherwise(0))
    total, moves = 0, []
    for edge in sorted(edges.select("part", "conv", "size", "shared", "cut").collect()):
        moves.append((edge["part"], edge["conv"], edge["shared"], edge["cut"], total))
        total += edge["size"] - edge["cut"]
    table = spark.createDataFrame(moves, "part int, first_conv long, first_shared int, first_cut long, total long")
    first = F.col("conv") == F.col("first_conv")
    return ordered.where("size IS NULL").join(table, "part").select(
        "conv",
        "n",
        F.when(first, F.col("first_shared")).otherwise(F.col("shared")).alias("shared"),
        F.when(first, F.col("first_cut")).otherwise(F.col("cut")).alias("cut"),
        # what the first path shares is not emitted again
        F.when(first, F.col("total")).otherwise(F.col("total") + F.col("start") - F.col("first_cut")).alias("start"),
    )


def formatted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and members of the prefix tree of ``turns`` (conv_id long, turn, role, text).

    Nodes: ``node, parent, tree, depth, start, length, position, piece, mask_start, mask_length,
    attends``; a node's characters lie at ``start`` in the emitted text, their position ids begin
    at ``position``, the loss mask covers ``mask_length`` of them, and ``attends`` lists the
    intervals that the ancestors cover from the root on, adjacent ones as one: as many as the path
    has branches, and not as it has turns. Members: ``conv, conv_id, seq, last, node``.

    Defined cases: null role or text is empty; rows of null conv_id form one conversation; rows of
    one turn are taken by role, then text, nulls first, repeated rows each as a turn; an empty
    table gives empty tables; very long texts are nodes like others; other columns are ignored.
    A conversation of n turns moves n scalar rows, and its path, n digests, once for the order.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    chains = stored(rows.mapInArrow(_chains, _TURN), "chains")
    paths = chains.where("seq < 0").select("conv", "path", "ends")
    members = chains.where("seq >= 0").drop("path", "ends")

    tasks = max(1, -(-paths.count() // PATH_ROWS))
    ordered = paths.repartitionByRange(tasks, "path", "conv").sortWithinPartitions("path", "conv")
    placed = _corrected(stored(ordered.mapInArrow(_ordered, _PLACED), "paths"))

    # a node belongs to the first conversation in order that has it
    placed = placed.where("n > shared")
    start = F.col("start") + F.col("position") - F.col("cut")
    own = members.join(placed.withColumnRenamed("start", "own_start"), "conv").withColumn("start", F.col("own_start")).where("seq >= shared")
    nodes = stored(
        own.select(
            "node", "parent", "tree", F.col("seq").alias("depth"), start.alias("start"), F.length("piece").cast("long").alias("length"),
            "position", "piece", "mask_start", "mask_length", "conv", "own_start",
        ),
        "nodes",
    )
    # the own nodes of a conversation lie side by side, so those of a path do per owner
    places = nodes.select("node", F.col("conv").alias("owner"), "start", (F.col("start") + F.col("length")).alias("end"))
    above = members.join(placed.select("conv", "shared"), "conv").where("seq < shared").select("conv", "seq", "node").join(places, "node")
    above = above.groupBy("conv", "owner").agg(F.min("seq").alias("seq"), F.min("start").alias("start"), F.max("end").alias("end"))
    above = above.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end"))).alias("above"))
    shared = F.transform("above", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    kind = "array<struct<start:bigint,end:bigint>>"
    before = F.when(F.col("start") > F.col("own_start"), F.array(F.struct(F.col("own_start").alias("start"), F.col("start").alias("end"))))
    # where the owner above is the one emitted just before, its interval ends where this one starts
    attends = F.aggregate(
        F.concat(F.coalesce(shared, F.array().cast(kind)), F.coalesce(before, F.array().cast(kind))),
        F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] == x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), x["end"].alias("end")))),
        ).otherwise(F.concat(done, F.array(x))),
    )
    nodes = nodes.join(above, "conv", "left").withColumn("attends", attends).drop("conv", "own_start", "above")
    return nodes, members.select("conv", "conv_id", "seq", "last", "node")


def _lengthened(covered: list[list[int]], start: int, end: int) -> None:
    """``covered`` with one interval more, as one with the last where they meet."""
    if covered and covered[-1][1] == start:
        covered[-1][1] = end
    else:
        covered.append([start, end])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task, over a conversation's nodes in order: its digests. Position ids have to run on, and
    the nodes' places to be those that the last node attends to."""
    now, state, out, covered, attends = None, None, [], [], []

    def close() -> None:
        if state is not None:
            if covered != attends:
                raise ValueError(f"the last node of conversation {state[0]} attends to {attends}, its nodes lie at {covered}")
            conv_id, n, turns, loss_n, loss, chars = state
            out.append((conv_id, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    for part in slices(batches):
        for conv, conv_id, piece, mask_start, mask_length, position, start, length, last in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if now != conv:
                close()
                now, state, covered = conv, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], []
            if position != state[5]:
                raise ValueError(f"a node of conversation {conv_id} has position {position} after {state[5]} characters")
            _lengthened(covered, start, start + length)
            if last is not None:
                attends = [[x["start"], x["end"]] for x in last]
                _lengthened(attends, start, start + length)
            role, text = parsed(piece)
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            if mask_start is not None:
                own = unescaped(piece[mask_start : mask_start + mask_length])
                state[3] += len(own)
                state[4].update(own.encode())
            state[5] += len(piece)
        if out:
            yield batch()
            out = []
    close()
    if out:
        yield batch()


def conversations_of(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, read back
    from the emitted nodes by their positions and the intervals that the last one attends to."""
    parts = ["piece", "mask_start", "mask_length", "position", "start", "length"]
    rows = members.join(nodes.select("node", *parts, "attends"), "node").withColumn("attends", F.when(F.col("last"), F.col("attends")))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "seq").select("conv", "conv_id", *parts, "attends")
    return rows.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

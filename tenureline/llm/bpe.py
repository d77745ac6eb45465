"""Byte-level BPE encoding and decoding as a monoid over text segments, reduced in a tree.

A text is halved down to leaves, the leaves are split into pretokens, and neighbours are joined:
only a window at the cut is split again. Its left end is a pretoken that ends two characters
before the cut, the farthest any alternative of the pattern looks ahead; to the right, splitting
stops at the first boundary that the right segment has too, from where both scans are the same.

Long pretokens are halved in turn, and their tokens joined: the tokens around the cut are encoded
again in a window that doubles until its outermost tokens are those that stood there before. Then
every adjacent pair of the joined sequence is one that BPE leaves apart, which makes it the
encoding of the whole. Decoding concatenates bytes up the tree.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import kept
from .texts import slices, strings

#: Characters of a text leaf, bytes of a pretoken leaf, ids of a decoding leaf.
TEXT_LEAF, BYTES_LEAF, IDS_LEAF = 4096, 48, 4096
#: Characters that an alternative of the pattern may look at beyond the end of its match.
LOOK_AHEAD = 2
#: Pretokens that a Python worker remembers, and characters of the longest one remembered: together
#: they bound the memory. Longer ones are encoded each time.
MEMO, MEMO_CHARS = 500_000, 64


def read_ranks(path: str) -> bytes:
    """A rank file: a line with base64 bytes and rank for each token. Read by the driver."""
    return Path(path).read_bytes()


class BytePairs:
    """Merges by rank, the lowest first, the leftmost of equals."""

    def __init__(self, rank_file: bytes):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}

    def whole(self, data: bytes) -> list[int]:
        """The encoding of one pretoken."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.reduced(data)

    def reduced(self, data: bytes) -> list[int]:
        """Encode halves, then join them."""
        if len(data) <= BYTES_LEAF:
            return self.merged(data)
        middle = len(data) // 2
        return self.joined(self.reduced(data[:middle]), self.reduced(data[middle:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        size = 2
        while True:
            i, j = max(0, len(left) - size), min(len(right), size)
            window = self.merged(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))
            settled_left = i == 0 or window[0] == left[i]
            settled_right = j == len(right) or window[-1] == right[j - 1]
            if settled_left and settled_right:
                return left[:i] + window + right[j:]
            size *= 2

    def merged(self, data: bytes) -> list[int]:
        ranks = self.ranks
        if len(data) > 2 * BYTES_LEAF:
            return self._merged_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        scores = [ranks.get(parts[i] + parts[i + 1], 1 << 40) for i in range(len(parts) - 1)]
        while scores and (low := min(scores)) < 1 << 40:
            i = scores.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 40)
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 40)
        return [ranks[x] for x in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(rank, i, 2) for i in range(len(parts) - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (rank := ranks.get(parts[a] + parts[b])) is not None:
                    heappush(heap, (rank, a, len(parts[a]) + len(parts[b])))
        return [ranks[x] for x in parts if x is not None]


class Pretokens:
    """Splits of texts by a pattern, as a monoid."""

    def __init__(self, pattern: str, leaf: int = TEXT_LEAF):
        self.pattern, self.leaf = regex.compile(pattern), leaf

    def of(self, text: str) -> list[str]:
        return self._reduced(text, 0, len(text))

    def _reduced(self, text: str, start: int, end: int) -> list[str]:
        if end - start <= self.leaf:
            return self.pattern.findall(text, start, end)
        cut = (start + end) // 2
        return self._joined(text, cut, end, self._reduced(text, start, cut), self._reduced(text, cut, end))

    def _joined(self, text: str, cut: int, end: int, left: list[str], right: list[str]) -> list[str]:
        i, at = len(left), cut
        while i and at > cut - LOOK_AHEAD:
            i -= 1
            at -= len(left[i])
        window, j, edge = [], 0, cut
        for match in self.pattern.finditer(text, at, end):
            window.append(match[0])
            at = match.end()
            while edge < at:
                edge += len(right[j])
                j += 1
            if edge == at and at > cut:
                break
        return left[:i] + window + right[j:]


class Memo(dict):
    """Packed ids of pretokens, of a bounded number of short ones."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs = pairs

    def __missing__(self, piece: str) -> bytes:
        ids = self.pairs.whole(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = packed
        return packed


def decoded_bytes(tokens: list[bytes]) -> bytes:
    """Concatenation of halves."""
    if len(tokens) <= IDS_LEAF:
        return b"".join(tokens)
    middle = len(tokens) // 2
    return decoded_bytes(tokens[:middle]) + decoded_bytes(tokens[middle:])


def encoded(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every whole text as packed little-endian 32-bit integers.

    Each match of ``pattern`` is encoded apart, strings of special tokens like any other text.
    Defined cases: a null or empty text has no ids; repeated rows each give a row; a null doc_id
    stays null; an empty table gives an empty table; other columns are ignored.
    """
    rank_file = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens = Pretokens(pattern)
        memo = kept("bpe", ("pretokens", rank_path), lambda: Memo(BytePairs(rank_file.value)))
        for part in slices(batches):
            ids = [b"".join(map(memo.__getitem__, pretokens.of(text))) for text in strings(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def decoded(ids: DataFrame, rank_path: str) -> DataFrame:
    """The columns of ``ids``, with ``bytes``: what the packed ids stand for. Null ids give null."""
    rank_file = ids.sparkSession.sparkContext.broadcast(read_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept("bpe", ("tokens", rank_path), lambda: BytePairs(rank_file.value)).tokens
        for part in slices(batches):
            out = [
                None if x is None else decoded_bytes([tokens[i] for i in memoryview(x).cast("I")]) for x in part.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "bytes"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in ids.dtypes)
    return ids.mapInArrow(run, f"{schema}, bytes binary")

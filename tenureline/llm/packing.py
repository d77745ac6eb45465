"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are integers up to the capacity, so a histogram of at most ``capacity`` counts holds all
that packing needs to know. The plan is made on the histogram: documents above a third of the
capacity meet at most in pairs, matched greedily, the longest first with the longest that fits;
shorter ones, the longest first, go to the sequences with the smallest gap that holds them.
Sequences filled alike are one entry of the plan, so its size follows from the capacity and not
from the data. Then every piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .alignment import a_bytes
from .kept import kept
from .staging import stored
from .texts import slices

#: Words that a Python worker remembers, unless told otherwise.
MEMO = 400_000
#: Pieces of one length ranked in one task.
RANKED_ROWS = 50_000
#: A word that the pretokeniser cuts once, before its tail of punctuation: ASCII letters and
#: letters of Latin-1, then ASCII punctuation.
_LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
_TAILED = re.compile(rb"(" + _LETTER + rb"+)([!-/:-@\[-`{-~]+)")
#: A word that is one pretoken of such letters, short enough for any encoder.
_PLAIN = re.compile(_LETTER + rb"{1,64}")


def plain_model(path: str):
    """The merges of a lower-casing word BPE in ``tiktoken``, which takes a word's end as a line feed;
    None unless ids rise in the order of merges and nothing else in the file bears on letters."""
    import tiktoken

    file = json.load(open(path, encoding="utf-8"))
    model, lower = file["model"], {"type": "Lowercase"}
    end, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
    if not end or model.get("type") != "BPE" or any(model.get(x) for x in ("continuing_subword_prefix", "dropout", "ignore_merges")):
        return None
    if lower not in (file.get("normalizer") or {}).get("normalizers", []):
        return None
    merges = ["".join(x) if isinstance(x, list) else x.replace(" ", "") for x in model["merges"]]
    by_rank = [vocabulary[x] for x in dict.fromkeys(merges)]
    table, last = a_bytes(path), end.encode()
    ranks = {table[at].removesuffix(last) + b"\n" * table[at].endswith(last): at for at in vocabulary.values()}
    letters = all(bytes([x]) + mark in ranks for x in range(256) for mark in (b"", b"\n"))
    if not letters or len(ranks) != len(vocabulary) or by_rank != sorted(by_rank) or len(vocabulary) != len(by_rank) + 512:
        return None
    return tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})


class Words(dict):
    """Packed ids of words by a tokeniser whose pretokens end at blanks: encoded once per word,
    words of plain letters by the same merges in a faster library.

    The tokeniser ignores the case of A-Z and drops blanks, so a text may be cut at spaces. Only
    its special tokens are found by case: a word that has one in any case keeps its own.
    """

    def __init__(self, path: str, remembered: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__({b"": b""})
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        special = [x.content.encode().lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special)) or rb"(?!)")
        self.plain = plain_model(path)

    def __missing__(self, word: bytes) -> bytes:
        if self.plain and _PLAIN.fullmatch(word):
            found = self.plain.encode_ordinary(word.decode().lower() + "\n")
            ids = struct.pack(f"<{len(found)}I", *found)
        elif cut := _TAILED.fullmatch(word):
            ids = self[cut[1]] + self[cut[2]]
        else:
            ids = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        if len(self) > self.remembered:
            self.clear()
        raw = (text or "").encode().replace(b"\n", b" ")
        words = (lowered := raw.lower()).split(b" ")
        if self.special.search(lowered):
            words = [own if self.special.search(word) else word for word, own in zip(words, raw.split(b" "), strict=True)]
        return b"".join(map(self.__getitem__, filter(None, words)))


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True, remembered: int = MEMO) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: every document's ids and ``end_id``.

    Only documents longer than ``capacity`` are cut. ``ids`` are packed little-endian 32-bit
    integers. A null or empty text has ``end_id`` alone; very long texts give many pieces; repeated
    rows and rows with a null doc_id each give their pieces; an empty table gives an empty table;
    other columns are ignored. ``remembered`` words per Python worker are encoded once; it trades
    memory for time.
    """
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept("packing", (tokenizer_path, remembered), lambda: Words(tokenizer_path, remembered))
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = words.ids(text) + end
                for k, i in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[i : i + 4 * capacity]
                    rows.append((doc_id, k, i // 4, len(own) // 4, zlib.crc32(own), own)[: len(names)])
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Plan:
    """Places for a histogram of lengths: ranks of a length, from the first on, to sequences from
    ``sequence`` on, at ``offset`` in each."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {length: n for length, n in histogram.items() if n > 0}
        self.rank = dict.fromkeys(self.left, 0)
        self.slots: list[tuple[int, int, int, int]] = []
        self.sequences = 0
        self.gaps: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = {}
        lengths = sorted(self.left)
        cut = bisect_right(lengths, capacity // 3)
        self._match(lengths[cut:])
        for length in reversed(lengths[:cut]):
            self._fill(length)

    def _place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.slots.append((length, self.rank[length], sequence, offset))
        self.rank[length] += n
        self.left[length] -= n

    def _leave(self, sequence: int, n: int, gap: int) -> None:
        """``n`` sequences have ``gap`` free."""
        if n and gap:
            if gap not in self.open:
                insort(self.gaps, gap)
            self.open.setdefault(gap, []).append((sequence, n))

    def _new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _match(self, lengths: list[int]) -> None:
        while lengths:
            longest = lengths[-1]
            fits = bisect_right(lengths, self.capacity - longest) - 1
            if fits >= 0 and lengths[fits] == longest and self.left[longest] == 1:
                fits -= 1
            if fits < 0:
                n = self.left[longest]
                first = self._new(n)
                self._place(longest, n, first, 0)
                self._leave(first, n, self.capacity - longest)
            else:
                other = lengths[fits]
                n = self.left[longest] // 2 if other == longest else min(self.left[longest], self.left[other])
                first = self._new(n)
                self._place(longest, n, first, 0)
                self._place(other, n, first, longest)
                self._leave(first, n, self.capacity - longest - other)
                if other != longest and not self.left[other]:
                    del lengths[fits]
            if not self.left[longest]:
                lengths.pop()

    def _fill(self, length: int) -> None:
        while n := self.left[length]:
            at = bisect_left(self.gaps, length)
            if at == len(self.gaps):
                gap, each = self.capacity, self.capacity // length
                count = max(1, n // each)
                first = self._new(count)
            else:
                gap = self.gaps[at]
                each = gap // length
                first, count = self.open[gap].pop()
                if not self.open[gap]:
                    del self.open[gap], self.gaps[at]
            each = min(each, n)
            used = min(count, n // each)
            self._leave(first + used, count - used, gap)
            for i in range(each):
                self._place(length, used, first, self.capacity - gap + i * length)
            self._leave(first, used, gap - each * length)


def packed(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """The columns of ``pieces``, with ``sequence_id`` and ``offset``, gapless from 0.

    ``pieces`` has a ``length`` from 1 to ``capacity`` in each row. Rows are never cut, dropped or
    merged: repeated rows take a place each. An empty table gives an empty table. Columns of
    ``pieces`` named ``sequence_id`` or ``offset``, in any case, give way to the new ones; all others
    stay, whatever their names.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    fixed = stored(pieces.select(F.col("length").cast("long").alias("length"), F.struct(*pieces.columns).alias("piece"), F.monotonically_increasing_id().alias("row")), "pieces")
    total = fixed.count()
    ranked = max(1, -(-total // RANKED_ROWS))
    group = Window.partitionBy("length", "dealt")
    rows = fixed.withColumn("dealt", F.pmod(F.xxhash64("row"), F.lit(ranked)))
    counts = rows.groupBy("length", "dealt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = rows.withColumn("own", F.row_number().over(group.orderBy("row")) - 1)
    rows = rows.join(counts.drop("n"), ["length", "dealt"]).select("piece", (F.col("before") + F.col("own")).alias("rank"), "length")

    histogram = {row["length"]: row["n"] for row in fixed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if None in histogram:
        raise ValueError("a length is null")
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError("lengths must be from 1 to the capacity")
    slots = np.array(sorted(Plan(histogram, capacity).slots), np.int64).reshape(-1, 4)
    plan = spark.sparkContext.broadcast(slots)
    # by place, so that no name of the pieces meets one of these
    rows = rows.select(*(F.col("piece").getField(name).alias(f"c{i}") for i, name in enumerate(pieces.columns)), "length", "rank")

    names = [*pieces.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = plan.value
        keys = (slots[:, 0] << 44) + slots[:, 1]
        for batch in batches:
            length, rank = (x.to_numpy() for x in batch.columns[-2:])
            at = slots[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            values = [pa.array(at[:, 2] + rank - at[:, 1]), pa.array(at[:, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *values], names=names)

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    return rows.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """``(sequence_id, n_documents, length, ids)``: the training sequences, from packed pieces with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = placed.groupBy("sequence_id").agg(F.count("*").alias("n_documents"), F.sum("length").alias("length"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return out.select("sequence_id", "n_documents", "length", joined.alias("ids"))

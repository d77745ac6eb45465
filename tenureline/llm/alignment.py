"""Alignment of two tokenisations of the same bytes, by merge-path partitioning.

Tokeniser A (byte-level BPE) and B (pieces with byte fallback) encode ``space + text``. The ends of
their tokens are two sorted lists of byte offsets; merging them shows where both end together: these
offsets cut the tokens into groups, and the two tokens that end there are linked.

A merge of m + n ends is a path through an m x n grid. Diagonals at equal distances cut it into
pieces of equal work; a binary search on each diagonal finds where the path crosses it, so every
piece knows its part of both lists without the others. A document of one piece is merged where it
was encoded; the pieces of longer ones are dealt out over all tasks. A piece emits its links and
the groups between its first and its last cut; the tokens before and after these, its boundary, are
stitched to groups in the order of the pieces.

If two tokens end together, the bytes of one are a suffix of the other's. So the vocabularies bound
the pairs of ids that can ever be linked, whatever the corpus: a few hundred thousand, which are
numbered. Counts over the corpus are one long for each.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import kept
from .staging import stored
from .texts import slices

#: Ends that a piece merges, of both lists together.
PIECE_ENDS = 32_768
#: Texts beyond this length, or with other than Latin-1 characters, go to the tokenizers library.
SHORT_TEXT = 100_000
SPACE = "▁"

_SCHEMA = (
    "key long, doc_id long, piece int, pieces int, n_a long, n_b long, n_groups long, groups binary, links binary, "
    "a_ids binary, a_ends binary, b_ids binary, b_ends binary"
)
_MERGED = "key long, doc_id long, piece int, n_a long, n_b long, n_groups long, links binary, head_a binary, head_b binary, groups binary, tail_a binary, tail_b binary"


def _byte_level() -> dict[str, int]:
    """Byte-level tokenisers write bytes as printable characters: those that print stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in own]
    return {chr(x): x for x in own} | {chr(0x100 + i): x for i, x in enumerate(rest)}


def a_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE in a ``tokenizers`` file."""
    model, table = json.load(open(path, encoding="utf-8")), _byte_level()
    out = [b""] * (1 + max([*model["model"]["vocab"].values(), *(x["id"] for x in model["added_tokens"])]))
    for entry, at in model["model"]["vocab"].items():
        out[at] = bytes(table[c] for c in entry)
    for added in model["added_tokens"]:
        out[added["id"]] = added["content"].encode()
    return out


def b_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a ``sentencepiece`` model; control pieces stand for themselves."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(x[1:-1], 16)]) if model.is_byte(i) else x.replace(SPACE, " ").encode() for i, x in enumerate(pieces)]


def linkable(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sorted codes a_id * len(b) + b_id of all pairs of which one is a suffix of the other."""
    ids: tuple[dict[bytes, list[int]], dict[bytes, list[int]]] = ({}, {})
    for own, tokens in zip(ids, (a, b), strict=True):
        for i, token in enumerate(tokens):
            if token:
                own.setdefault(token, []).append(i)
    codes = [i * len(b) + j for i, x in enumerate(a) for k in range(len(x)) for j in ids[1].get(x[k:], ())]
    codes += [i * len(b) + j for j, x in enumerate(b) for k in range(1, len(x)) for i in ids[0].get(x[k:], ())]
    return np.unique(np.array(codes, np.int64))


class Tokenisers:
    """Both tokenisers, the byte lengths of their tokens, and the numbers of linkable pairs."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        tokens = a_bytes(a_path), b_bytes(b_path)
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in own], np.int64) for own in tokens)
        self.a_table, self.b_table = tokens
        self.codes, self.n_b = linkable(*tokens), len(tokens[1])
        self.a_model = Tokenizer.from_file(a_path)
        self.a_model.encode_special_tokens = True
        self.short_model = self._short_model(a_path)
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # an id and what follows it: within its side of a group, or at its end
        width = len(str(max(map(len, tokens)))) + 1
        text = [f"{i}{x}" for own, end in zip(tokens, "|;", strict=True) for i in range(len(own)) for x in (",", end)]
        self.text, self.b_text = np.array(text, f"S{width}"), 2 * len(tokens[0])

    def _short_model(self, path: str):
        """The same merges in ``tiktoken``, several times as fast; None unless they are plain."""
        import public_tokenizers
        import tiktoken

        file = json.load(open(path, encoding="utf-8"))
        before, vocabulary = file.get("pre_tokenizer") or {}, file["model"]["vocab"]
        merges = ["".join(x) if isinstance(x, list) else x.replace(" ", "") for x in file["model"]["merges"]]
        by_rank = [vocabulary[x] for x in dict.fromkeys(merges)]
        cut_alike = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        # ids must be ranks: every entry is a byte, or the outcome of a merge, in the order of merges
        if not cut_alike or file.get("normalizer") or by_rank != sorted(by_rank) or len(vocabulary) != len(by_rank) + 256:
            return None
        ranks = {self.a_table[i]: i for i in vocabulary.values()}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        for i, text in enumerate(texts):
            if self.short_model and len(text) <= SHORT_TEXT and _latin(text):
                out[i] = np.array(self.short_model.encode_ordinary(text), np.int64)
        rest = [i for i, x in enumerate(out) if x is None]
        for i, found in zip(rest, self.a_model.encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(found.ids, np.int64)
        return out

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of A, their ends, ids of B, their ends; none if either gives other bytes than the text."""
        a_of = self.a_ids([f" {x}" for x in texts])
        for text, a, b in zip(texts, a_of, self.b_model.encode(texts, num_threads=1), strict=True):
            b = np.array(b, np.int64)
            if not text or not self._same(text, a, b):
                a, b = a[:0], b[:0]
            yield a, np.cumsum(self.a_lengths[a]), b, np.cumsum(self.b_lengths[b])

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        raw = b" " + text.encode()
        return all(raw == b"".join(map(table.__getitem__, ids.tolist())) for table, ids in ((self.a_table, a), (self.b_table, b)))

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of pairs of ids."""
        return np.searchsorted(self.codes, a * self.n_b + b).astype("<i4")

    def groups(self, a: np.ndarray, a_cuts: np.ndarray, b: np.ndarray, b_cuts: np.ndarray) -> bytes:
        """Groups as ``a1,a2|b1;a3|b2,b3;``, cut after these places of both lists."""
        out = np.empty(len(a) + len(b), np.int64)
        for ids, cuts, others, base in ((a, a_cuts, np.concatenate([[-1], b_cuts]), 0), (b, b_cuts, a_cuts, self.b_text)):
            ends = np.zeros(len(ids), np.int64)
            ends[cuts] = 1
            group = np.cumsum(ends) - ends
            out[np.arange(len(ids)) + others[group] + 1] = base + 2 * ids + ends
        raw = self.text[out].view(np.uint8)
        return raw[raw != 0].tobytes()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def diagonals(a_ends: np.ndarray, b_ends: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) where the merge path of two strictly rising lists crosses every ``work``-th
    diagonal, found by binary search on all diagonals at once; equal ends stay in one piece.

    On a tie the path first takes the end of A. The first place is (0, 0), the last both lengths.
    """
    m, n = len(a_ends), len(b_ends)
    d = np.arange(work, m + n, work)
    low, high = np.maximum(d - n, 0), np.minimum(d, m)
    while (low < high).any():
        middle = (low + high) // 2
        at = np.where(low < high, middle, 0)
        # the end of A at ``at`` comes before the end of B that the diagonal would take in its place
        before = a_ends[at] <= b_ends[np.clip(d - at - 1, 0, n - 1)]
        low, high = np.where((low < high) & before, middle + 1, low), np.where((low < high) & ~before, middle, high)
    i, j = low, d - low
    tie = (i > 0) & (j < n) & (a_ends[np.maximum(i - 1, 0)] == b_ends[np.minimum(j, n - 1)]) if m and n else np.zeros(len(d), bool)
    j = j + tie
    return np.concatenate([[0], i, [m]]), np.concatenate([[0], j, [n]])


def merged(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends that they share."""
    if not len(a_ends) or not len(b_ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(a_ends, b_ends), len(a_ends) - 1)
    b_cuts = np.flatnonzero(a_ends[at] == b_ends)
    return at[b_cuts], b_cuts


def _tokenisers(a_path: str, b_path: str) -> Tokenisers:
    return kept("alignment", (a_path, b_path), lambda: Tokenisers(a_path, b_path))


def _digested(groups: bytes, digest: bool) -> bytes:
    return hashlib.sha256(groups).hexdigest().encode() if digest and groups else groups


def _packed(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def _encoded(a_path: str, b_path: str, work: int, digest: bool):
    """Task: a finished row per short document, a row per piece of a longer one."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, key = _tokenisers(a_path, b_path), TaskContext.get().partitionId() << 40
        for part in slices(batches):
            rows = []
            texts = [x or "" for x in part.column(1).to_pylist()]
            for doc_id, (a, a_ends, b, b_ends) in zip(part.column(0).to_pylist(), both.encoded(texts), strict=True):
                key += 1
                if len(a) + len(b) <= work:
                    a_cuts, b_cuts = merged(a_ends, b_ends)
                    groups = both.groups(a, a_cuts, b, b_cuts)[:-1]
                    links = both.links(a[a_cuts], b[b_cuts]).tobytes()
                    rows.append((key, doc_id, 0, 1, len(a), len(b), len(a_cuts), _digested(groups, digest), links, None, None, None, None))
                    continue
                i, j = diagonals(a_ends, b_ends, work)
                for k in range(len(i) - 1):
                    x, y = slice(i[k], i[k + 1]), slice(j[k], j[k + 1])
                    data = [_packed(a[x], "<u4"), _packed(a_ends[x], "<i8"), _packed(b[y], "<u4"), _packed(b_ends[y], "<i8")]
                    rows.append((key, doc_id, k, len(i) - 1, i[k + 1] - i[k], j[k + 1] - j[k], None, None, None, *data))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _pieces_merged(a_path: str, b_path: str):
    """Task: the cuts of pieces, each by itself."""
    names = [x.split()[0] for x in _MERGED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenisers(a_path, b_path)
        for part in slices(batches):
            rows = []
            for row in part.to_pylist():
                a, a_ends, b, b_ends = (np.frombuffer(row[name], kind).astype(np.int64) for name, kind in (("a_ids", "<u4"), ("a_ends", "<i8"), ("b_ids", "<u4"), ("b_ends", "<i8")))
                a_cuts, b_cuts = merged(a_ends, b_ends)
                links = both.links(a[a_cuts], b[b_cuts]).tobytes()
                first_a, first_b, last_a, last_b = (*(x[0] + 1 for x in (a_cuts, b_cuts)), *(x[-1] + 1 for x in (a_cuts, b_cuts))) if len(a_cuts) else (len(a), len(b), len(a), len(b))
                inner = both.groups(a[first_a:last_a], a_cuts[1:] - first_a, b[first_b:last_b], b_cuts[1:] - first_b)
                ends = [_packed(x, "<u4") for x in (a[:first_a], b[:first_b], a[last_a:], b[last_b:])]
                rows.append((row["key"], row["doc_id"], row["piece"], row["n_a"], row["n_b"], len(a_cuts), links, ends[0], ends[1], inner, ends[2], ends[3]))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


class _Document:
    """The pieces of one document, stitched in order; only the open group is held when digesting."""

    def __init__(self, doc_id: int | None, digest: bool):
        self.doc_id, self.counts = doc_id, [0, 0, 0]
        self.open_a = self.open_b = b""
        self.text, self.sha, self.any = [], hashlib.sha256() if digest else None, False

    def _emit(self, text: bytes) -> None:
        # a group's closing mark is written when the next one begins
        if text:
            text = (b";" if self.any else b"") + text[:-1]
            self.any = True
            self.sha.update(text) if self.sha else self.text.append(text)

    def add(self, row: dict) -> None:
        self.counts = [x + row[name] for x, name in zip(self.counts, ("n_a", "n_b", "n_groups"), strict=True)]
        self.open_a, self.open_b = self.open_a + row["head_a"], self.open_b + row["head_b"]
        if row["n_groups"]:
            a, b = (np.frombuffer(x, "<u4").tolist() for x in (self.open_a, self.open_b))
            self._emit(",".join(map(str, a)).encode() + b"|" + ",".join(map(str, b)).encode() + b";")
            self._emit(row["groups"])
            self.open_a, self.open_b = row["tail_a"], row["tail_b"]

    def row(self, key: int) -> tuple:
        return key, self.doc_id, *self.counts, self.sha.hexdigest().encode() if self.sha else b"".join(self.text)


def _stitched(digest: bool):
    """Task, over pieces sorted by document and number: a row per document."""
    names = ["key", "doc_id", "n_a", "n_b", "n_groups", "groups"]
    kinds = [pa.int64()] * 5 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, document = None, None
        batch_of = lambda row: pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], names=names)
        for part in slices(batches):
            for row in part.to_pylist():
                if document is None or row["key"] != key:
                    if document is not None:
                        yield batch_of(document.row(key))
                    key, document = row["key"], _Document(row["doc_id"], digest)
                document.add(row)
        if document is not None:
            yield batch_of(document.row(key))

    return run


class Alignment:
    """The alignment of a corpus, held as tables: documents with their groups, and links."""

    def __init__(self, documents: DataFrame, links: DataFrame, a_path: str, b_path: str):
        #: (key, doc_id, n_a, n_b, n_groups, groups), a row per document
        self.documents = documents
        #: (key, links): packed little-endian 32-bit numbers of linked pairs, several rows per document
        self.links = links
        self.a_path, self.b_path = a_path, b_path

    @cached_property
    def _pairs(self) -> tuple[np.ndarray, int]:
        a, b = a_bytes(self.a_path), b_bytes(self.b_path)
        return linkable(a, b), len(b)

    @cached_property
    def _counts(self) -> np.ndarray:
        n = len(self._pairs[0])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(n, np.int64)
            for part in slices(batches):
                for cell in part.column(0):
                    np.add.at(total, np.frombuffer(cell.as_buffer(), "<i4"), 1)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "n"])

        found = self.links.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(n, np.int64)
        out[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
        return out

    def pair_counts(self) -> DataFrame:
        """``(a_id, b_id, n)``: how many links of the corpus hold the pair."""
        (codes, n_b), counts = self._pairs, self._counts
        at = np.flatnonzero(counts)
        rows = zip((codes[at] // n_b).tolist(), (codes[at] % n_b).tolist(), counts[at].tolist(), strict=True)
        return self.links.sparkSession.createDataFrame(list(rows), "a_id long, b_id long, n long")

    def scored(self) -> DataFrame:
        """``documents`` with ``n_links``, ``n_best`` (links whose pair is the commonest of its B id
        in the corpus, ties included) and ``count_sum`` (the pair's count, over links)."""
        (codes, n_b), counts = self._pairs, self._counts
        most = np.zeros(n_b, np.int64)
        np.maximum.at(most, codes % n_b, counts)
        held = self.links.sparkSession.sparkContext.broadcast((counts, (counts == most[codes % n_b]) & (counts > 0)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, best = held.value
            for part in slices(batches):
                pairs = [np.frombuffer(x.as_buffer(), "<i4") for x in part.column(1)]
                sums = [[len(x) for x in pairs], [int(best[x].sum()) for x in pairs], [int(counts[x].sum()) for x in pairs]]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in sums)], names=["key", "n_links", "n_best", "count_sum"])

        sums = self.links.mapInArrow(run, "key long, n_links long, n_best long, count_sum long")
        sums = sums.groupBy("key").agg(*(F.sum(x).alias(x) for x in ("n_links", "n_best", "count_sum")))
        return self.documents.join(sums, "key").drop("key")


def aligned(docs: DataFrame, a_path: str, b_path: str, work: int = PIECE_ENDS, digest: bool = False) -> Alignment:
    """The alignment of every row of ``docs`` (doc_id, text).

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` with decimal ids, or its SHA-256 in hex if ``digest``.
    Defined cases: a null or empty text, and one whose tokens of A or of B do not give back the
    bytes of ``space + text`` (as with U+2581, which B takes for a space), has no tokens and empty
    groups; very long texts are cut into pieces of ``work`` ends; equal ends never part; pairs as
    common as the commonest of a B id all count as best; repeated rows each count and give a row;
    a null doc_id gives a row; an empty table gives empty tables; other columns are ignored. Tokens
    of no bytes are not among those that tokenisers of these kinds give.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encoded(a_path, b_path, work, digest), _SCHEMA)
    rows = stored(rows, "encoded")
    pieces = rows.where("pieces > 1").drop("pieces", "n_groups", "groups", "links").repartition("key", "piece")
    pieces = stored(pieces.mapInArrow(_pieces_merged(a_path, b_path), _MERGED), "merged")
    short = rows.where("pieces = 1")
    long = pieces.drop("links").repartition("key").sortWithinPartitions("key", "piece")
    long = long.mapInArrow(_stitched(digest), "key long, doc_id long, n_a long, n_b long, n_groups long, groups binary")
    documents = short.select("key", "doc_id", "n_a", "n_b", "n_groups", "groups").unionByName(long)
    return Alignment(documents.withColumn("groups", F.decode("groups", "UTF-8")), short.select("key", "links").unionByName(pieces.select("key", "links")), a_path, b_path)

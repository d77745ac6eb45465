"""Documents whose sets of word n-grams are similar by Jaccard, by vertical partitioning.

1. Documents with equal sets form a class; a class is known by a digest of its set, of 64 bits, or
   by 64 other ones where two sets of the corpus share these.
2. A global order of the n-grams puts those that recur often last, the others by hash. Two sets of
   similarity t share an n-gram among the first n - ceil(t n) + 1 of each; so only those entries are
   shuffled, and all others of the region, the first 1 - t of the order. The order is cut into
   fragments, and a fragment finds the classes that share an entry (a bucket). An entry knows the
   largest partner that may first be met there. n-grams of the region that no other class has are
   missing from every partner: what is left of a set bounds its overlaps.
3. Candidate pairs come from the buckets. First every member is paired with two pivots of its bucket;
   components join what is found, and rounds of new pivots go on while buckets hold many pairs of
   different components. Then all members of different components are paired, which is exact, since
   a link within a component changes no component. A pair that has met in the n-gram just before in
   both sets is not formed again.
4. A parity map of each set (bit i is the parity of its n-grams that hash to i) rules pairs out
   before their sets are read: two maps differ in at most as many bits as the sets do in n-grams.
5. The sets of the candidates are cut into fragments of the order. A task holds one fragment of the
   sets of a block of pairs and counts their partial overlaps; the counts are summed per pair. A set
   travels once per block, and pairs that hang together share a block up to its fixed size.

The order only steers cost: any order that all tasks share gives the same links. Counted are
n-grams that recur within a block of documents, over all documents; the most frequent
``FREQUENT`` of them, a bound of the broadcast, are ordered by count. Their entries need no
fragment that looks for a second class, so no task gathers the entries of a frequent n-gram.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .kept import give_back, kept
from .staging import release, stored
from .vectors import small_batches

#: Most frequent n-grams that the order knows by count; 16 bytes each in the broadcast.
FREQUENT = 200_000
#: n-grams of a block of documents, within which recurrence is counted.
BLOCK_NGRAMS = 500_000
#: A block counts an n-gram that so many of its documents have.
RECURRENT = 4
#: Prefix entries of a fragment, entries packed at once, and bytes of text hashed at once.
FRAGMENT_ENTRIES, BLOCK_ENTRIES, SLICE_BYTES = 500_000, 250_000, 500_000
#: Fragments that candidates' sets are cut into, and n-grams of the sets of a block of pairs.
FRAGMENTS, PAIR_NGRAMS = 8, 8_000_000
#: Longs of a parity map, and those used within buckets.
MAP_LONGS, BUCKET_LONGS = 8, 4
#: Bits per class of a map of classes, the most such a map has, and those of one of its chunks: a
#: full map costs reading, not results.
CLASS_BITS, MOST_BITS, MAP_CHUNK_BITS = 32, 1 << 28, 1 << 16
#: Pivots of a bucket in a round, n-grams per class whose buckets have pivots in the first round,
#: about, and the most rounds.
PIVOTS, PIVOT_NGRAMS, ROUNDS = 2, 16, 8
#: Rounds go on while members of different components make more pairs than so many per entry, and
#: while the last one joined this share of the classes that are left.
CROSSING, JOINED = 2, 0.02
#: n-grams before the shared one in which a pair may have met already.
BEFORE = 4
#: Copies of a set that may be stored, and plausible partners of a class that are tried first.
COPIES, NEAREST = 8, 2
#: Bits of a class's first digest.
DIGEST_BITS = 64
#: Classes that a task remembers to have seen.
SEEN = 100_000
#: An entry: n-gram, class, set size, n-grams of the set in the region (-1 - that outside it), and
#: the largest set that may share it as its first n-gram. Within a fragment the low half of the
#: n-gram's hash is kept: n-grams taken for one another add candidates, and lose none.
_ENTRY = np.dtype([("h", "<u4"), ("c", "<i8"), ("n", "<i4"), ("r", "<i4"), ("t", "<i4")])


def _planes(entries: np.ndarray) -> bytes:
    """Entries as planes of bytes: those of small numbers are empty and take no room in a shuffle."""
    return entries.view(np.uint8).reshape(len(entries), _ENTRY.itemsize).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(_ENTRY.itemsize, -1).T).view(_ENTRY).ravel()


#: Texts sent to Python at once.
TEXT_ROWS = 1000
#: Entries of one stored row of buckets.
CHUNK_ENTRIES = 100_000
#: Places in a word whose letters' codes are tabulated.
_PLACES = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class NgramSets:
    """Sets of hashed word n-grams of texts in Arrow batches.

    Words are runs of bytes other than space and tab to carriage return, A-Z lower-cased. Fewer
    than ``size`` words count as one n-gram; null and wordless texts have the empty set.
    """

    def __init__(self, size: int):
        self.size = size
        self.base = np.uint64(0x9E3779B97F4A7C15 | 1)
        # 0 is a blank, so every other byte has one more than its own code
        self.kind = np.arange(1, 257, dtype=np.uint16)
        self.kind[65:91] += 32
        self.kind[[9, 10, 11, 12, 13, 32]] = 0
        self.table = self._code(np.arange(_PLACES)[:, None], np.arange(257)[None, :])

    @staticmethod
    def _code(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """A number for every letter at every place of a word, without a pattern between places."""
        with np.errstate(over="ignore"):
            return _mixed(_mixed(place.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) + letter.astype(np.uint64))

    def _words(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words of ``raw``, bytes whose blanks part the words: the mixed
        sum of the codes of its letters at their places."""
        byte = self.kind[raw]
        solid = np.zeros(len(raw) + 2, np.int8)
        np.not_equal(byte, 0, out=solid[1:-1].view(bool))
        edges = np.diff(solid)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        lengths = ends - starts
        letters = byte[byte != 0].astype(np.int64)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        codes = self.table[np.minimum(place, _PLACES - 1), letters]
        if (far := np.flatnonzero(place >= _PLACES)).size:
            codes[far] = self._code(place[far], letters[far])
        with np.errstate(over="ignore"):
            sums = np.zeros(len(letters) + 1, np.uint64)
            np.cumsum(codes, out=sums[1:])
            return starts, _mixed(sums[first + lengths] - sums[first] + np.uint64(1))

    def of(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Row and sorted distinct n-gram hashes of each text, in order."""
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        null = column.is_null().to_numpy(zero_copy_only=False)
        first = 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
            last = min(last, len(column))
            sizes = np.diff(offsets[first : last + 1])
            # a blank after every text keeps words of neighbours apart
            at = np.concatenate([[0], np.cumsum(sizes + 1)])
            raw = np.insert(data[offsets[first] : offsets[last]], (offsets[first + 1 : last + 1] - offsets[first]), 32)
            starts, words = self._words(raw)
            cuts = np.searchsorted(starts, at)
            for row in range(first, last):
                own = words[cuts[row - first] : cuts[row - first + 1]]
                yield row, self._set(own[:0] if null[row] else own)
            first = last

    def _set(self, words: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            n = len(words) - self.size + 1
            if n < 1 and len(words):
                out = np.full(1, np.uint64(len(words)))
                for word in words:
                    out = _mixed(out * self.base + word)
                return out
            out = np.zeros(max(n, 0), np.uint64)
            for i in range(self.size if n > 0 else 0):
                out = out * self.base + words[i : i + n]
        out = np.sort(_mixed(out))
        return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


def _digests(grams: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    first, second = (int.from_bytes(raw[i : i + 8], "little", signed=True) for i in (0, 8))
    return first & ((1 << DIGEST_BITS) - 1) if DIGEST_BITS < 64 else first, second


def _class(grams: np.ndarray, clashing: frozenset[int]) -> int:
    first, second = _digests(grams)
    return second if first in clashing else first


class _Seen(set):
    """What a task has seen lately."""

    def new(self, x: int) -> bool:
        if x in self:
            return False
        if len(self) >= SEEN:
            self.clear()
        self.add(x)
        return True


def _parity(grams: np.ndarray) -> np.ndarray:
    """The first longs fold all n-grams into few bits, the rest into all bits."""
    place = (grams >> np.uint64(32)).astype(np.int64)
    few, many = ((np.bincount(place % (64 * n), minlength=64 * n) & 1).astype(bool) for n in (BUCKET_LONGS, MAP_LONGS))
    return np.packbits(np.concatenate([few, many])).view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _classes(size: int):
    """Task: rows (0, doc_id, set size, both digests), and (1, n-gram, recurrences in a block)."""
    names = ["kind", "id", "n", "class", "second"]

    def counted(block: list[np.ndarray]) -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(block), return_counts=True)
        often = counts >= RECURRENT
        n = int(often.sum())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(n, np.int8)), pa.array(_signed(grams[often])), pa.array(counts[often].astype(np.int32)), *[pa.nulls(n, pa.int64())] * 2], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, block, held, seen = kept("ngrams", size, lambda: NgramSets(size)), [], 0, set()
        for batch in batches:
            sizes, classes = [], []
            for _, grams in sets.of(batch.column(1)):
                sizes.append(len(grams))
                classes.append(_digests(grams))
                if len(grams) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    block.append(grams)
                    held += len(grams)
                if held >= BLOCK_NGRAMS:
                    yield counted(block)
                    block, held, seen = [], 0, set()
            columns = [pa.array(np.zeros(len(sizes), np.int8)), batch.column(0), pa.array(sizes, pa.int32()), *(pa.array([x[i] for x in classes], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if block:
            yield counted(block)
        give_back()

    return run


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def least_overlap(m, n, percent: int):
    """The smallest intersection of similar sets of these sizes."""
    return -(-percent * (m + n) // (100 + percent))


def _entries(size: int, percent: int, frequent, clashing: frozenset[int], fragments: int):
    """Task: a row (fragment, packed entries) per block of documents and fragment; entries of
    frequent n-grams have fragments below 0, dealt by class."""
    edge = (1 << 64) * (100 - percent) // 100
    spread = fragments // 4 + 1

    def packed(block: list[tuple]) -> pa.RecordBatch:
        out = np.empty(sum(len(x[0]) for x in block), _ENTRY)
        out["h"] = np.concatenate([x[0] for x in block]) & np.uint64(0xFFFFFFFF)
        out["c"] = np.concatenate([np.full(len(x[0]), x[2]) for x in block])
        out["n"] = np.concatenate([np.full(len(x[0]), x[3]) for x in block])
        out["r"] = np.concatenate([x[4] for x in block])
        # the largest m of a pair n, m whose least overlap is n less the n-grams before this one
        rank = np.concatenate([np.arange(len(x[0])) for x in block])
        n = out["n"].astype(np.int64)
        out["t"] = np.clip((100 + percent) * (n - rank) // percent - n, -1, (1 << 31) - 1)
        place = np.concatenate([x[1] for x in block])
        order = np.argsort(place, kind="stable")
        out, place = out[order], place[order]
        cuts = np.flatnonzero(np.diff(place)) + 1
        parts = np.split(out, cuts)
        return pa.RecordBatch.from_arrays(
            [pa.array(place[np.concatenate([[0], cuts])].astype(np.int32)), pa.array([_planes(x) for x in parts], pa.binary())],
            names=["fragment", "entries"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, counts_of = frequent.value
        sets, block, held, seen = kept("ngrams", size, lambda: NgramSets(size)), [], 0, _Seen()
        for batch in batches:
            for _, grams in sets.of(batch.column(0)):
                if not len(grams) or not seen.new(own := _class(grams, clashing)):
                    continue
                count = np.zeros(len(grams), np.int64)
                if len(grams_of):
                    at = np.minimum(np.searchsorted(grams_of, grams), len(grams_of) - 1)
                    count = np.where(grams_of[at] == grams, counts_of[at], 0)
                n, region = len(grams), (grams < np.uint64(edge)) & (count == 0)
                r = int(region.sum())
                order = np.argsort(count, kind="stable")
                first = order[: max(prefix_length(n, percent), r)]
                inside, often, first = region[first], count[first] > 0, grams[first]
                # equal cuts of the region; what lies beyond is spread over a few more fragments
                near = ((first >> np.uint64(32)).astype(np.int64) * fragments) // (edge >> 32)
                place = np.where(inside, np.minimum(near, fragments - 1), fragments + (_mixed(first) % np.uint64(spread)).astype(np.int64))
                place = np.where(often, -1 - own % spread, place)
                block.append((first, place, own, n, np.where(inside, r, -1 - r)))
                held += len(first)
                if held >= BLOCK_ENTRIES:
                    yield packed(block)
                    block, held = [], 0
        if block:
            yield packed(block)
        give_back()

    return run


def _buckets(percent: int):
    """Group: entries of n-grams that two classes of fitting sizes share, as packed rows, and per
    class its size, the n-grams of its region, and how many of these are shared here."""
    names = ["fragment", "entries", "class", "n", "region", "shared"]

    def run(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        entries = np.concatenate([_from_planes(x.as_buffer()) for x in table.column("entries")])
        entries = entries[np.lexsort((entries["c"], entries["n"], entries["h"]))]
        again = (entries["h"][1:] == entries["h"][:-1]) & (entries["c"][1:] == entries["c"][:-1])
        entries = entries[np.concatenate([[True], ~again])]
        h, n = entries["h"], entries["n"].astype(np.int64)
        if fragment >= 0:
            # the next larger set of the bucket is not too large: both may have a partner
            fits = (h[1:] == h[:-1]) & (100 * n[:-1] >= percent * n[1:])
            entries = entries[np.concatenate([fits, [False]]) | np.concatenate([[False], fits])]
        c, first, which = np.unique(entries["c"], return_index=True, return_inverse=True)
        sizes, region = entries["n"][first], entries["r"][first].astype(np.int64)
        shared = np.bincount(which, entries["r"] >= 0, len(c)).astype(np.int32)
        # beyond the prefix an entry is counted, but no pair first meets there
        entries = entries[100 * entries["t"].astype(np.int64) >= percent * entries["n"].astype(np.int64)]
        h = entries["h"]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        cuts = starts[np.searchsorted(starts, np.arange(CHUNK_ENTRIES, len(h), CHUNK_ENTRIES), "right") - 1] if len(h) else starts
        chunks = [_planes(x) for x in np.split(entries, np.unique(cuts[cuts > 0])) if len(x)]
        k = len(chunks)
        columns = [
            pa.array(np.full(k + len(c), fragment, np.int32)),
            pa.array(chunks + [None] * len(c), pa.binary()),
            *(pa.concat_arrays([pa.nulls(k, kind), pa.array(x, kind)]) for x, kind in (
                (c, pa.int64()), (sizes, pa.int32()), (np.where(region < 0, -1 - region, region), pa.int32()), (shared, pa.int32())
            )),
        ]
        return pa.table(columns, names=names)

    return run


def _strong_buckets(percent: int, strong):
    """Task: bucket rows (h, class, n, top) of strong classes and of larger classes in their
    buckets; all rows of frequent n-grams, whose buckets lie in many chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = strong.value
        for batch in batches:
            for fragment, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = _from_planes(chunk)
                if fragment >= 0:
                    is_strong = _marked(bits, np.ascontiguousarray(x["c"]))
                    # by size within a bucket: the largest strong class up to each entry
                    n, rows = x["n"].astype(np.int64), np.arange(len(x))
                    start = np.flatnonzero(np.concatenate([[True], x["h"][1:] != x["h"][:-1]]))
                    bucket = np.repeat(start, np.diff(np.append(start, len(x))))
                    last = np.maximum.accumulate(np.where(is_strong, rows, -1))
                    partner = (last >= bucket) & (100 * n[np.maximum(last, 0)] >= percent * n)
                    keep = is_strong | partner
                    x = x[keep & (np.add.reduceat(keep.astype(np.int64), start)[np.searchsorted(start, bucket)] > 1)]
                columns = [pa.array((max(fragment, -1) << 32) + x["h"].astype(np.int64)), *(pa.array(np.ascontiguousarray(x[name])) for name in "cnt")]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "class", "n", "top"])

    return run


def _bit(digests: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(digests.view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def _marked(held: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Which classes a map may hold; never false for one that it holds."""
    at = _bit(digests, 8 * len(held))
    return (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _chunk(table: pa.Table) -> pa.Table:
    chunk = np.zeros(MAP_CHUNK_BITS, bool)
    chunk[table.column("bit").to_numpy() % MAP_CHUNK_BITS] = True
    return pa.table([pa.array([table.column("chunk")[0].as_py()], pa.int32()), pa.array([np.packbits(chunk).tobytes()], pa.binary())], names=["chunk", "bits"])


def _class_map(classes: DataFrame) -> np.ndarray:
    """Bits for the classes, by their number up to a fixed size."""
    bits = MAP_CHUNK_BITS
    while bits < min(CLASS_BITS * classes.count(), MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bit(batch.column(0).to_numpy().astype(np.int64), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // MAP_CHUNK_BITS).astype(np.int32)), pa.array(at)], names=["chunk", "bit"])

    out = np.zeros(bits // 8, np.uint8)
    for row in classes.mapInArrow(run, "chunk int, bit long").groupBy("chunk").applyInArrow(_chunk, "chunk int, bits binary").collect():
        at = row["chunk"] * MAP_CHUNK_BITS // 8
        out[at : at + MAP_CHUNK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _is_in(key: Column, classes: DataFrame) -> Column:
    """Whether a class may be among ``classes``."""
    held = classes.sparkSession.sparkContext.broadcast(_class_map(classes))
    return F.arrow_udf(lambda x: pa.array(_marked(held.value, x.to_numpy().astype(np.int64))), "boolean")(key)


_SET = "class long, fragment int, grams binary, map array<long>, copied boolean"


def _sets(size: int, wanted, copied, clashing: frozenset[int]):
    """Task: the sets of wanted classes, cut into fragments of the order; the first one of a class
    is never missing and carries its parity map. Marked are classes of many copies."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=["class", "fragment", "grams", "map", "copied"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sets, seen = wanted.value, kept("ngrams", size, lambda: NgramSets(size)), _Seen()
        for batch in batches:
            rows, held = [], 0
            for _, grams in sets.of(batch.column(0)):
                if not len(grams):
                    continue
                own = _class(grams, clashing)
                if not _marked(bits, np.array([own], np.int64))[0] or not seen.new(own):
                    continue
                many = bool(_marked(copied.value, np.array([own], np.int64))[0])
                cuts = np.searchsorted((grams >> np.uint64(32)) * np.uint64(FRAGMENTS) >> np.uint64(32), np.arange(FRAGMENTS + 1).astype(np.uint64))
                for i in range(FRAGMENTS):
                    if not i or cuts[i] < cuts[i + 1]:
                        rows.append((own, i, grams[cuts[i] : cuts[i + 1]].tobytes(), None if i else _parity(grams), many))
                held += len(grams)
                if held >= BLOCK_ENTRIES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)
        give_back()

    return run


def _overlaps(table: pa.Table) -> pa.Table:
    """Group: one fragment of the sets of a block, and its pairs: n-grams that each pair shares."""
    is_set = table.column("grams").is_valid().to_numpy()
    own, pairs = table.filter(pa.array(is_set)), table.filter(pa.array(~is_set))
    names = ["a", "b", "na", "nb", "shared"]
    a, b = (pairs.column(x).to_numpy() for x in ("a", "b"))
    classes, order = np.unique(own.column("a").to_numpy(), return_index=True)
    grams = [np.frombuffer(own.column("grams")[int(i)].as_buffer(), np.uint64) for i in order]
    lengths = np.array([len(x) for x in grams], np.int64)
    first = np.cumsum(lengths) - lengths
    ids = np.unique(np.concatenate(grams), return_inverse=True)[1] if len(grams) else np.zeros(0, np.int64)
    shared = np.zeros(len(a), np.int64)
    known = lambda x: np.searchsorted(classes, x).clip(max=max(len(classes) - 1, 0))
    at_a, at_b = known(a), known(b)
    there = (classes[at_a] == a) & (classes[at_b] == b) if len(classes) else np.zeros(len(a), bool)
    by_b = np.flatnonzero(there)
    by_b = by_b[np.argsort(at_b[by_b], kind="stable")]
    mark = np.zeros(len(ids) + 1, bool)
    for of_one in np.split(by_b, np.flatnonzero(np.diff(at_b[by_b])) + 1):
        if not len(of_one):
            continue
        y = at_b[of_one[0]]
        held = ids[first[y] : first[y] + lengths[y]]
        mark[held] = True
        x = at_a[of_one]
        sizes = lengths[x]
        places = np.repeat(first[x] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        hits = np.concatenate([[0], np.cumsum(mark[ids[places]])])
        ends = np.cumsum(sizes)
        shared[of_one] = hits[ends] - hits[ends - sizes]
        mark[held] = False
    return pa.table([pa.array(a), pa.array(b), pairs.column("na"), pairs.column("nb"), pa.array(shared)], names=names)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links ``(a, b)`` among ``pairs`` (a, b, na, nb): partial overlaps, summed per pair."""
    clusters = connected_components(pairs).select(F.col("node").alias("a"), F.col("component").alias("cluster"))
    weighed = pairs.join(clusters, "a")
    weights = stored(weighed.groupBy("cluster").agg(F.sum(F.col("na").cast("long") + F.col("nb")).alias("grams")), "weights")
    blocks = 1 + (weights.agg(F.sum("grams")).first()[0] or 0) // PAIR_NGRAMS
    parts = F.ceil(F.col("grams") / PAIR_NGRAMS)
    block = F.pmod(F.xxhash64("cluster", F.pmod(F.xxhash64("b"), parts)), F.lit(blocks))
    blocked = stored(weighed.join(weights, "cluster").select("a", "b", "na", "nb", block.alias("block")), "blocked")
    classes = blocked.select("block", F.explode(F.array("a", "b")).alias("class")).distinct()
    nothing = lambda kind: F.lit(None).cast(kind)
    # sets of other classes do not move
    held = sets.where(_is_in(F.col("class"), classes.select("class"))).select("class", "fragment", "grams").join(classes, "class")
    held = held.select("block", "fragment", F.col("class").alias("a"), nothing("long").alias("b"), nothing("int").alias("na"), nothing("int").alias("nb"), "grams")
    asked = blocked.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1)))).withColumn("grams", nothing("binary"))
    partial = held.unionByName(asked).groupBy("block", "fragment").applyInArrow(_overlaps, "a long, b long, na int, nb int, shared long")
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    linked = total.where(F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("shared")))
    found = stored(linked.select("a", "b"), "found")
    release(weights, blocked)
    return found


def _apart(left: str, right: str, longs: int) -> Column:
    return reduce(operator.add, (F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(longs)))


def _near(apart: Column, m: str, n: str, percent: int) -> Column:
    """Similar sets differ in at most (100 - percent) / (100 + percent) of their summed sizes."""
    return F.lit(100 + percent) * apart <= F.lit(100 - percent) * (F.col(m) + F.col(n))


def _may_link(percent: int) -> Column:
    """What sizes and places in the order allow of c and d."""
    fitting = F.lit(100) * F.least("cn", "dn") >= F.lit(percent) * F.greatest("cn", "dn")
    return fitting & (F.col("cn") <= F.col("dtop")) & (F.col("dn") <= F.col("ctop"))


def _enough(u: str, v: str, m: str, n: str, percent: int) -> Column:
    """n-grams that others have too bound the overlap."""
    return F.lit(100 + percent) * F.least(u, v).cast("long") >= F.lit(percent) * (F.col(m).cast("long") + F.col(n))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs ``(a, b, na, nb)`` with the lower class first, without repeats."""
    swap = F.col("c") > F.col("d")
    pick = lambda x, y: F.when(swap, F.col(x)).otherwise(F.col(y))
    return pairs.select(pick("d", "c").alias("a"), pick("c", "d").alias("b"), pick("dn", "cn").alias("na"), pick("cn", "dn").alias("nb")).distinct()


def _plausible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs that n-grams without partner and full parity maps allow, with the bits in which these differ."""
    of = lambda key, name: maps.select(F.col("class").alias(key), F.col("u").alias(f"{name}u"), *(F.col("map")[BUCKET_LONGS + i].alias(f"{name}{i}") for i in range(MAP_LONGS)))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b")
    both = both.where(_enough("xu", "yu", "na", "nb", percent)).select("a", "b", "na", "nb", _apart("x", "y", MAP_LONGS).alias("apart"))
    return both.where(_near(F.col("apart"), "na", "nb", percent))


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    columns = {"class": "", "n": "n", "top": "top", "component": "c"} | {x: x for x in more}
    return rows.select("h", *(F.col(x).alias(f"{name}{short}") for x, short in columns.items()))


def _pivot_pairs(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """Members of each bucket with its pivot, where components differ; one global priority keeps
    the pairs few. Every other turn draws a component first, so that small ones get pivots too."""
    drawn = F.col("component") if turn % 2 else F.col("class")
    priority = F.struct(F.xxhash64(drawn, F.lit(turn)).alias("priority"), F.xxhash64("class").alias("then"), "class", "n", "top", "component")
    pivots = rows.groupBy("h").agg(F.min(priority).alias("pivot")).select("h", "pivot.*").drop("priority", "then")
    pairs = _side(rows, "c").join(_side(pivots, "d"), "h").where((F.col("cc") != F.col("dc")) & _may_link(percent))
    return _ordered(pairs)


def _mixed_buckets(buckets: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Rows of buckets of several components, with ``component``."""
    if not links:
        rows = buckets.withColumn("component", F.col("class"))
    else:
        labels = connected_components(reduce(DataFrame.unionByName, links)).select(F.col("node").alias("class"), "component")
        rows = buckets.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    ends = rows.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("h")
    return stored(rows.join(ends, "h", "left_semi"), "mixed")


def _crossing_pairs(mixed: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that lie in different components and that small parity maps allow;
    members of the largest component of a bucket are only paired with the rest."""
    few = [F.col("map")[i].alias(f"m{i}") for i in range(BUCKET_LONGS)]
    # in the order of n-grams: whoever meets here and met before may link by what is known there too
    before = Window.partitionBy("class").orderBy(F.desc("top"), "h")
    rows = mixed.withColumn("before", F.array(*(F.lag("h", i).over(before) for i in range(1, BEFORE + 1))))
    # there are about as many classes as documents that recur: their maps are never broadcast
    rows = rows.join(maps.select("class", "u", *few).hint("merge"), "class")
    sizes = mixed.groupBy("h", "component").agg(F.count("*").alias("size"))
    major = sizes.groupBy("h").agg(F.max(F.struct("size", "component"))["component"].alias("major"))
    rows = rows.join(major, "h")
    more = ["before", "u", *(f"m{i}" for i in range(BUCKET_LONGS))]
    c, d = _side(rows.where("component != major"), "c", *more), _side(rows.withColumn("is_major", F.col("component") == F.col("major")), "d", "is_major", *more)
    once = F.col("dis_major") | (F.col("cc") < F.col("dc"))
    near = _near(_apart("cm", "dm", BUCKET_LONGS), "cn", "dn", percent)
    # nulls are no n-grams: a pair that has met before was formed there
    met = F.coalesce(F.arrays_overlap("cbefore", "dbefore"), F.lit(False))
    return _plausible(_ordered(c.join(d, (c["h"] == d["h"]) & (F.col("cc") != F.col("dc")) & once & _may_link(percent) & _enough("cu", "du", "cn", "dn", percent) & near & ~met)), maps, percent)


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (doc_id long, text).

    Two documents link when 100 x intersection >= ``percent`` x union of their sets of ``size``
    words; ``component_id`` is the smallest doc_id that links reach. Defined cases: null, empty
    and wordless texts have size 0 and link with nothing; fewer than ``size`` words are one
    n-gram; repeated rows link like any equal texts and each gives a row; a null doc_id takes
    part and gets the component of its group, null where the group has no other id; an empty
    table gives an empty table; other columns are ignored.
    """
    with small_batches(docs.sparkSession, TEXT_ROWS):
        rows, links = _classes_and_links(docs.select("doc_id", "text"), size, percent)
    labels = connected_components(links).select(F.col("node").alias("class"), "component")
    rows = rows.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "component", "left")
    return out.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def _classes_and_links(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, n_shingles, class)``, and links between classes that connect all that are similar."""
    spark = docs.sparkSession
    first = stored(docs.mapInArrow(_classes(size), "kind byte, id long, n int, class long, second long"), "classes")
    # of 1e11 sets a few hundred pairs share 64 bits, as expected
    clashing = first.where("kind = 0 AND n > 0").groupBy("class").agg(F.min("second").alias("lo"), F.max("second").alias("hi")).where("lo != hi")
    clashing = frozenset(r["class"] for r in clashing.select("class").collect())
    own = F.when(F.col("class").isin(list(clashing)), F.col("second")).otherwise(F.col("class")) if clashing else F.col("class")
    rows = first.where("kind = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, own).alias("class"))

    often = first.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(FREQUENT).toPandas()
    often = often.assign(gram=often["id"].to_numpy(np.int64).view(np.uint64)).sort_values("gram")
    frequent = spark.sparkContext.broadcast((often["gram"].to_numpy(np.uint64), often["n"].to_numpy(np.int64)))
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    fragments = 8 + total * (100 - percent) // 100 // FRAGMENT_ENTRIES

    text = docs.select("text")
    entries = text.mapInArrow(_entries(size, percent, frequent, clashing, fragments), "fragment int, entries binary")
    shared = entries.groupBy("fragment").applyInArrow(_buckets(percent), "fragment int, entries binary, class long, n int, region int, shared int")
    shared = stored(shared, "shared")
    lone = shared.where("entries IS NULL").groupBy("class").agg(F.max("n").alias("n"), (F.max("region") - F.sum("shared")).alias("lone"))
    use = stored(lone.select("class", (F.col("n") - F.col("lone")).cast("int").alias("u"), "n"), "use")
    # classes that can be the smaller one of a similar pair
    strong = spark.sparkContext.broadcast(_class_map(use.where(F.lit(100 + percent) * F.col("u") >= F.lit(2 * percent) * F.col("n").cast("long")).select("class")))
    with small_batches(spark, 8):
        buckets = shared.where("entries IS NOT NULL").select("fragment", "entries").mapInArrow(_strong_buckets(percent, strong), "h long, class long, n int, top int")
        buckets = stored(buckets, "buckets")
    release(shared)
    wanted = spark.sparkContext.broadcast(_class_map(buckets.select("class").distinct()))
    copies = rows.where("class IS NOT NULL").groupBy("class").agg(F.count("*").alias("copies"))
    copied = spark.sparkContext.broadcast(_class_map(copies.where(F.col("copies") > COPIES).select("class")))
    # only sets of many copies move to become one: of the others a few may stay
    found = stored(text.mapInArrow(_sets(size, wanted, copied, clashing), _SET), "sets")
    once = stored(found.where("copied").dropDuplicates(["class", "fragment"]), "sets")
    sets = found.where("NOT copied").unionByName(once).drop("copied")
    maps = stored(sets.where("map IS NOT NULL").select("class", "map").dropDuplicates(["class"]).join(use.select("class", "u"), "class"), "maps")
    release(use)

    links, tried = [], []
    # a set of n has n (100 - percent) / 100 n-grams in the region, evenly spread by hash
    few = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") * F.col("n") < float((PIVOT_NGRAMS << 32) * 100 // (100 - percent))
    mixed = _mixed_buckets(buckets.where(few), [])
    for turn in range(ROUNDS):
        pairs = reduce(DataFrame.unionByName, (_pivot_pairs(mixed, PIVOTS * turn + i, percent) for i in range(PIVOTS))).distinct()
        links.append(_tested(_plausible(pairs, maps, percent), tried, sets, percent))
        left = mixed
        mixed = _mixed_buckets(left.drop("component"), links)
        release(left)
        sizes = mixed.groupBy("h", "component").agg(F.count("*").alias("size")).groupBy("h").agg(F.sum("size").alias("size"), F.sum(F.col("size") * F.col("size")).alias("inner"))
        n, pairs = sizes.agg(F.sum("size"), F.sum((F.col("size") * F.col("size") - F.col("inner")) / 2)).first()
        if not n or pairs <= CROSSING * n or links[-1].count() < JOINED * mixed.select("class").distinct().count():
            break
    release(mixed)
    mixed = _mixed_buckets(buckets, links)
    release(buckets)
    pairs = stored(_untried(_crossing_pairs(mixed, maps, percent), tried), "crossing")
    release(mixed, maps, *tried)
    nearest = NEAREST
    while not pairs.isEmpty():
        # the most alike first: what they join needs no other pair
        by_class = [F.row_number().over(Window.partitionBy(x).orderBy("apart", "a", "b")) for x in ("a", "b")]
        ranked = pairs.withColumn("of_a", by_class[0]).withColumn("of_b", by_class[1])
        chosen = stored(ranked.where(F.least("of_a", "of_b") <= nearest).select(pairs.columns), "pairs")
        links.append(_verified(chosen, sets, percent))
        labels = connected_components(reduce(DataFrame.unionByName, links))
        of = lambda key: labels.select(F.col("node").alias(key), F.col("component").alias(f"{key}_in"))
        rest = _untried(pairs, [chosen]).join(of("a"), "a", "left").join(of("b"), "b", "left")
        rest = rest.where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select(pairs.columns)
        before, pairs = pairs, stored(rest, "crossing")
        release(before, chosen, labels)
        nearest *= 8
    release(pairs, found, once)
    return rows, reduce(DataFrame.unionByName, links)


def _untried(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    return reduce(lambda rest, before: rest.join(before.select("a", "b"), ["a", "b"], "left_anti"), tried, pairs)


def _tested(pairs: DataFrame, tried: list[DataFrame], sets: DataFrame, percent: int) -> DataFrame:
    """The links among pairs not in ``tried``, which then has them too."""
    tried.append(stored(_untried(pairs, tried), "pairs"))
    return _verified(tried[-1], sets, percent)

"""Language identification by interpolated Kneser-Ney character models.

A text is lower-cased and reduced to letters, everything between becoming one space. An n-gram
of ``ORDER`` characters packs twelve bits per character into a 64-bit key. A model holds, per
order, a sorted array of keys with counts (raw for the highest order, continuation counts below)
and one of contexts; a probability is found by binary search and interpolated downwards. The
prediction is the language of lowest cross-entropy per character. A text is rejected when even
that lies nearer to uniform noise than to what held-back documents of the language reach.

The models are fit on a bounded sample: documents of the learning part by hash of their id, about
``SAMPLE_CHARS`` characters over all languages, a tenth of them held back for calibration. Only
the n-gram counts of that sample reach the driver. Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import kept
from .texts import slices

ORDER, BITS = 4, 12
#: Characters of the sample over all languages, and the share of its documents held back.
SAMPLE_CHARS, HELD_BACK = 6_000_000, 0.1
#: Share of held-back documents that stay under the calibrated cross-entropy.
CALIBRATED = 0.999
#: Characters at a time of which the evidence for the score is counted.
EVIDENCE_CHARS = 12
UNDETERMINED = "und"


class Letters:
    """Codes of the letters of a text: a letter, or one space for what lies between."""

    SPACE = 1

    def __init__(self):
        points = np.arange(0x110000, dtype=np.int32)
        letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        # twelve bits, distinct for the first 4093 code points
        self.table = np.where(letter, 2 + points % ((1 << BITS) - 3), 0).astype(np.uint16)

    def codes(self, text: str) -> np.ndarray:
        codes = self.table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        codes = codes[keep]
        return codes if codes.any() else codes[:0]

    def grams(self, text: str) -> np.ndarray:
        """Keys of the n-gram that ends at each character, the text padded with spaces."""
        codes = self.codes(text)
        if not len(codes):
            return codes.astype(np.int64)
        padded = np.concatenate([np.full(ORDER - 1, self.SPACE), np.where(codes == 0, self.SPACE, codes)]).astype(np.int64)
        key = padded[: len(codes)]
        for i in range(1, ORDER):
            key = (key << BITS) | padded[i : i + len(codes)]
        return key


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    return keys[first], np.diff(np.append(first, len(keys)))


def found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys``, and which of them are there."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class KneserNey:
    """One language: sorted arrays of n-grams and contexts for every order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.orders = []
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                keys, counts = counted(keys & ((1 << BITS * order) - 1))
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and ones + twos else 0.5
            contexts, first = np.unique(keys >> BITS, return_index=True)
            totals = np.add.reduceat(counts, first).astype(float)
            types = np.diff(np.append(first, len(keys)))
            where = np.searchsorted(contexts, keys >> BITS)
            own = np.maximum(counts - discount, 0) / totals[where]
            self.orders.append((keys, own, contexts, discount * types / totals))
        self.uniform = 1.0 / (len(keys) + 1)

    def probability(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), self.uniform)
        for order in range(1, ORDER + 1):
            grams, own, contexts, weight = self.orders[ORDER - order]
            short = keys & ((1 << BITS * order) - 1)
            at, seen = found(grams, short)
            there, known = found(contexts, short >> BITS)
            p = np.where(known, np.where(seen, own[at], 0) + np.where(known, weight[there], 0) * p, p)
        return p


class Identifier:
    """All languages: the n-grams of any of them in one sorted array, with every log-probability."""

    def __init__(self, languages: list[str], grams: list[tuple[np.ndarray, np.ndarray]], limits: dict[str, float] | None = None):
        self.languages, self.limits, self.letters = languages, limits or {}, kept("langid", "letters", Letters)
        self.models = [KneserNey(*x) for x in grams]
        self.keys = np.unique(np.concatenate([x[0] for x in grams])) if grams else np.zeros(0, np.int64)
        self.logs = self._logs(self.keys)

    def _logs(self, keys: np.ndarray) -> np.ndarray:
        return np.log(np.stack([m.probability(keys) for m in self.models], axis=1)) if self.models else np.zeros((len(keys), 0))

    def entropies(self, text: str | None) -> tuple[int, np.ndarray]:
        """Characters scored, and nats per character for every language."""
        keys, counts = counted(self.letters.grams(text or ""))
        n = int(counts.sum())
        if not n or not self.languages:
            return 0, np.zeros(len(self.languages))
        at, seen = found(self.keys, keys)
        total = counts[seen] @ self.logs[at[seen]]
        if not seen.all():
            total = total + counts[~seen] @ self._logs(keys[~seen])
        return n, -total / n

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, cross-entropy, rejected. Ties go to the language first in order."""
        n, nats = self.entropies(text)
        if not n:
            return UNDETERMINED, 0.0, None, True
        best = int(np.argmin(nats))
        score = 1.0 / float(np.exp(-min(n, EVIDENCE_CHARS) * (nats - nats[best])).sum())
        limit = self.limits.get(self.languages[best])
        return self.languages[best], score, float(nats[best]), limit is not None and float(nats[best]) > limit


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = kept("langid", "letters", Letters)
    for part in slices(batches):
        by_lang: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(letters.grams(text))
        for lang, keys in by_lang.items():
            grams, counts = counted(np.concatenate(keys))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])


def learned(docs: DataFrame) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]], dict[str, float]]:
    """Languages, their n-gram counts and rejection limits, from documents (doc_id, text, lang)."""
    spark = docs.sparkSession
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("doc_id", F.lit(3)).alias("hash"))
    sizes = {row["lang"]: row["n"] or 0 for row in known.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    languages = sorted(lang for lang, n in sizes.items() if n)
    if not languages:
        return [], [], {}
    share = {lang: min(1.0, SAMPLE_CHARS / len(languages) / sizes[lang]) for lang in languages}
    draw = (F.pmod("hash", F.lit(1_000_003)) / 1_000_003.0) / F.create_map(*(F.lit(x) for pair in share.items() for x in pair))[F.col("lang")]
    sample = known.where(draw < 1)
    fit = sample.where(draw < 1 - HELD_BACK).select("lang", "text").mapInArrow(_gram_counts, "lang string, gram long, n long")
    counts = fit.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    grams = {lang: rows.sort_values("gram") for lang, rows in counts.groupby("lang")}
    languages = [lang for lang in languages if lang in grams]
    arrays = [(grams[lang]["gram"].to_numpy(np.int64), grams[lang]["n"].to_numpy(np.int64)) for lang in languages]
    model = spark.sparkContext.broadcast((languages, arrays))

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(*model.value)
        for part in slices(batches):
            rows = [identifier.predict(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[2] for r in rows], pa.float64())], names=["lang", "nats"])

    held = sample.where(draw >= 1 - HELD_BACK).select("text").mapInArrow(calibrate, "lang string, nats double")
    reached = held.where("nats IS NOT NULL").groupBy("lang").agg(F.percentile_approx("nats", CALIBRATED, 10_000).alias("nats")).collect()
    usual = {row["lang"]: row["nats"] for row in reached}
    noise = {lang: -np.log(KneserNey(*x).uniform) for lang, x in zip(languages, arrays, strict=True)}
    return languages, arrays, {lang: float(max(usual[lang], (usual[lang] + noise[lang]) / 2)) for lang in usual if lang in noise}


def identified(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """The columns of ``docs``, with ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``.

    Only ``text`` is an input of a prediction. ``learn_from`` (doc_id, text, lang) is what models
    learn from. Defined cases: of languages with equal cross-entropy the first by name counts; very
    long texts are scored whole; a text that is null or has no letter is ``und`` with score 0 and
    rejected; so is every text if nothing can be learned, but not rejected; rows without language
    or text teach nothing; repeated rows each give a row; an empty table gives an empty table;
    columns named like the new ones are replaced.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learned(learn_from))
    new = ["lang_pred", "score", "cross_entropy", "rejected"]
    docs = docs.drop(*new)
    kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, grams, limits = model.value
        identifier = Identifier(languages, grams, limits)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            rows = [identifier.predict(x) for x in texts] if languages else [(UNDETERMINED, 0.0, None, False)] * len(texts)
            columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *new])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double, cross_entropy double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    """Documents that no model learns from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))

"""URL filter: rules first, then the ratio of two character models.

A URL is read as characters of ``CLASSES`` classes. Two variable-order Markov models, of the URLs
that rules allow and of those they block, give the probability of a character after up to
``ORDER - 1`` others, each order smoothed into the next lower one by Witten-Bell. The verdict
without a rule is whether the difference of the log-likelihoods per character reaches a threshold,
calibrated on a tenth of the ruled URLs that the models have not seen. All other ruled URLs are
counted; a model is an array of CLASSES ** ORDER counts, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import slices, strings

ORDER = 4
#: Characters with a class of their own; digits share one, other ASCII and all else one each.
_OWN = "abcdefghijklmnopqrstuvwxyz/.-_?=&#%:~+"
CLASSES = len(_OWN) + 4
#: Steps of the calibration per nat and character, and the largest difference told apart.
STEPS, WIDEST = 200, 8
Rule = tuple[str, str]


def _codes(text: str) -> np.ndarray:
    table = np.full(129, len(_OWN) + 2)
    table[128] = len(_OWN) + 3
    for i, x in enumerate(_OWN):
        table[ord(x)] = table[ord(x.upper())] = i + 1
    table[48:58] = len(_OWN) + 1
    return table[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 128)]


def grams(text: str) -> np.ndarray:
    """Keys of the n-gram that ends at each character; class 0 stands before the text."""
    codes = np.concatenate([np.zeros(ORDER - 1, np.int64), _codes(text)])
    n = len(codes) - ORDER + 1
    return reduce(lambda key, i: key * CLASSES + codes[i : i + n], range(1, ORDER), codes[:n])


class Markov:
    """log P(character | up to ORDER - 1 before it), for every n-gram."""

    def __init__(self, counts: np.ndarray):
        counts = counts.reshape((CLASSES,) * ORDER).astype(float)
        p = np.full(CLASSES, 1.0 / CLASSES)
        for order in range(1, ORDER + 1):
            own = counts.sum(axis=tuple(range(ORDER - order)))
            total, types = own.sum(axis=-1, keepdims=True), (own > 0).sum(axis=-1, keepdims=True)
            p = np.where(total > 0, (own + types * p) / np.maximum(total + types, 1), p)
        self.logs = np.log(p).ravel()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty where the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substr(rest, F.length(raw) + 1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(raw, letters, letters.lower()), F.regexp_extract(after, "^[^?#]*", 0)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule (host and path prefix, verdict) that fits, and its verdict; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, prefix = text.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(f"/{prefix}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for part in slices(batches):
        for verdict, url in zip(part.column(0).to_pylist(), strings(part.column(1)), strict=True):
            counts = held.setdefault(verdict, np.zeros(CLASSES**ORDER, np.int64))
            np.add.at(counts, grams(url), 1)
    for verdict, counts in held.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([verdict] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], names=["verdict", "gram", "n"])


def _scorer(models):
    def score(urls: pa.Array) -> pa.Array:
        difference = models.value
        out = []
        for url in strings(urls):
            keys = grams(url) if difference is not None else ()
            out.append(float(difference[keys].sum()) / len(keys) if len(keys) else 0.0)
        return pa.array(out, pa.float64())

    return F.arrow_udf(score, "double")


def calibrated_threshold(steps: list[tuple[str, int, int]]) -> float:
    """The step that parts (verdict, step, urls) with the highest mean of both hit rates; of
    equals the one nearest to 0."""
    total = {v: sum(n for verdict, _, n in steps if verdict == v) for v in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    best = (-1.0, 0.0, 0)
    for edge in sorted({s for _, s, _ in steps} | {s + 1 for _, s, _ in steps} | {0}):
        kept = sum(n for v, s, n in steps if v == "allow" and s >= edge) / total["allow"]
        cut = sum(n for v, s, n in steps if v == "block" and s < edge) / total["block"]
        best = max(best, (kept + cut, -abs(edge), edge))
    return best[2] / STEPS


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for every row of ``pages`` (page_id, url).

    Defined cases: a null url, or one without ``://``, has an empty host and path and meets no
    rule; a null or empty url scores 0; very long URLs are read whole; a score equal to the threshold
    is allowed; if no rule allows or none blocks any URL of the table, the
    method has nothing to compare: scores and threshold are 0 and it allows; repeated rows each
    count and give a row; an empty table gives an empty table; other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    rule, says = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("says", says)
    ruled = rows.where("rule IS NOT NULL").select("says", "url", (F.pmod(F.xxhash64("url"), F.lit(10)) == 0).alias("held"))

    counts = ruled.where("NOT held").select("says", "url").mapInArrow(_gram_counts, "verdict string, gram long, n long")
    counts = counts.groupBy("verdict", "gram").agg(F.sum("n").alias("n")).toPandas()
    difference = None
    if set(counts["verdict"]) == {"allow", "block"}:
        logs = {}
        for verdict, own in counts.groupby("verdict"):
            dense = np.zeros(CLASSES**ORDER, np.int64)
            dense[own["gram"].to_numpy(np.int64)] = own["n"].to_numpy(np.int64)
            logs[verdict] = Markov(dense).logs
        difference = (logs["allow"] - logs["block"]).astype(np.float32)
    score = _scorer(spark.sparkContext.broadcast(difference))
    step = F.floor(F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), score("url"))) * STEPS)
    steps = ruled.where("held").select("says", step.alias("step")).groupBy("says", "step").count()
    threshold = calibrated_threshold([tuple(row) for row in steps.collect()])
    rows = rows.withColumn("score", score("url"))
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), "score")

"""Quality rules: word statistics of a text, then a hashed n-gram likelihood ratio.

Two multinomials over ``BUCKETS`` buckets are counted: hashed words and pairs of neighbouring words
of a trusted target, and those of the whole raw corpus. Each bucket weighs the logarithm of its
smoothed probability in the target over that in the raw corpus, in whole units of 1 / ``UNITS``
nat. A text's score is the sum of its n-grams' weights, by length the mean; sums of whole numbers
do not depend on the order of rows, so every document meets the threshold in the same way on every
run. The threshold is calibrated on a part of the trusted documents, held back from the target: as
far below their first percentile as half the way from there to their median.

The target is every document that the labels call good, but those held back; the raw corpus is
counted whole. Up to ``BROADCAST_IDS`` ids of the target are broadcast, more of them meet the texts by
a shuffle. Only DataFrame functions: higher-order functions on a text's array of words, and one
aggregation by bucket.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stored

#: Buckets of hashed n-grams, units of a weight per nat, counts added to each bucket.
BUCKETS, UNITS, SMOOTHING = 1 << 16, 1 << 16, 1.0
#: A pair's hash is its first word's times this, plus its second word's.
PAIR_FACTOR = 8191
#: Every how many trusted documents one is held back, and up to how many ids are broadcast.
HELD_BACK, BROADCAST_IDS = 10, 500_000
#: Base rules: fewest words, and largest share of words (in percent) in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Words of a window that may repeat.
WINDOW = 3
_OTHER_BLANKS = "\t\n\x0b\x0c\r"
_SYMBOLS = "[#*$%&|<>]"
#: A window's key: the high bits of its hash, then its place.
_PLACE_BITS = 31
_PLACE = (1 << _PLACE_BITS) - 1


def words_of(text: Column) -> Column:
    spaced = reduce(lambda x, blank: F.replace(x, F.lit(blank), F.lit(" ")), _OTHER_BLANKS, text)
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words``, and ``hashes``, a CRC-32 of each."""
    docs = docs.withColumn("words", words_of(F.coalesce("text", F.lit(""))))
    return docs.withColumn("hashes", F.transform("words", lambda w: F.crc32(w.cast("binary"))))


def with_repeated_words(df: DataFrame, name: str) -> DataFrame:
    """``df`` (words, hashes) with the number of words in windows that the text has twice or more.

    Windows are sorted by a hash with their place in its low bits; only those whose hash recurs are
    then compared as words, so equal hashes of different windows change nothing.
    """
    windows = F.slice("hashes", 1, F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))
    hashed = lambda x, i: F.xxhash64(x, *(F.get("hashes", i + k) for k in range(1, WINDOW)))
    keys = F.transform(windows, lambda x, i: hashed(x, i).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    df = df.withColumn("_keys", F.sort_array(keys))
    alike = lambda x, y: F.shiftright(x.bitwiseXOR(y), _PLACE_BITS) == 0
    again = F.filter("_keys", lambda x, i: alike(F.get("_keys", i + 1), x) | alike(F.get("_keys", i - 1), x))
    df = df.withColumn("_again", again)
    window = lambda p: F.struct(*(F.get("words", p + k).alias(f"w{k}") for k in range(WINDOW)))
    place = lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int")
    df = df.withColumn("_maybe", F.sort_array(F.transform("_again", lambda x: F.struct(window(place(x)).alias("window"), place(x).alias("place")))))
    same = F.filter("_maybe", lambda x, i: (F.get("_maybe", i - 1)["window"] == x["window"]) | (F.get("_maybe", i + 1)["window"] == x["window"]))
    df = df.withColumn("_places", F.sort_array(F.transform(same, lambda x: x["place"])))
    reach = F.transform("_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW))))
    return df.withColumn(name, F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)).drop("_keys", "_again", "_maybe", "_places")


def _pair(first: Column, second: Column) -> Column:
    return (first * PAIR_FACTOR + second) % BUCKETS


def trusted(labels: DataFrame) -> DataFrame:
    """``(trusted_id, held)``: documents that all labels call good and none toxic, and which of
    them are held back."""
    rows = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("trusted_id"))
    good = rows.agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality = 1 AND coalesce(toxic, 0) = 0")
    return good.select("trusted_id").withColumn("held", F.crc32(F.col("trusted_id").cast("string").cast("binary")) % HELD_BACK == 0)


def _ids(target: DataFrame, which: str) -> DataFrame:
    """The ids of ``target`` that are ``which``, to be joined with rows of any size: those rows stay
    in place, or are shuffled and, as only the ids are held, not sorted."""
    ids = target.where(which).select("trusted_id")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return ids.hint("broadcast" if few else "shuffle_hash")


def bucket_counts(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``(bucket, raw, target)``: n-grams of all documents, and of those of ``target``."""
    ids = _ids(target, "NOT held")
    rows = with_words(docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("trusted_id"), "left"))
    # two hashes in a long, so that one array serves words and pairs; 0 follows the last word
    both = F.transform("hashes", lambda x, i: F.shiftleft(x, 32).bitwiseOR(F.coalesce(F.get("hashes", i + 1) + 1, F.lit(0))))
    rows = rows.select(F.col("trusted_id").isNotNull().cast("int").alias("good"), F.explode(both).alias("both"))
    word, follower = F.shiftrightunsigned("both", 32), F.col("both").bitwiseAND(F.lit(0xFFFFFFFF))
    rows = rows.select("good", F.explode(F.array(word % BUCKETS, F.when(follower > 0, _pair(word, follower - 1)))).alias("bucket")).where("bucket IS NOT NULL")
    return rows.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))


def weights(counts: DataFrame) -> Column:
    """Every bucket's weight as a literal array; zeros where there is no target."""
    found = {row["bucket"]: (row["raw"], row["target"]) for row in counts.collect()}
    n_raw, n_target = (sum(x[i] for x in found.values()) + SMOOTHING * BUCKETS for i in (0, 1))
    if not any(x[1] for x in found.values()):
        return F.split(F.lit(",".join(["0"] * BUCKETS)), ",").cast("array<int>")
    smooth = lambda x, n: (x + SMOOTHING) / n
    pairs = (found.get(i, (0, 0)) for i in range(BUCKETS))
    own = (round(UNITS * math.log(smooth(target, n_target) / smooth(raw, n_raw))) for raw, target in pairs)
    return F.split(F.lit(",".join(map(str, own))), ",").cast("array<int>")


def measured(docs: DataFrame, bucket_weights: Column) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_grams, points)``:
    the statistics of every text, and the summed weights of its n-grams."""
    rows = with_repeated_words(with_words(docs.select("doc_id", "text")), "n_repeat_words")
    text, zero = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    weight = lambda bucket: F.get(bucket_weights, bucket.cast("int"))
    points = F.transform("hashes", lambda x, i: weight(x % BUCKETS) + F.coalesce(weight(_pair(x, F.get("hashes", i + 1))), F.lit(0)))
    n_words = F.size("words").cast("long")
    return rows.select(
        "doc_id",
        n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines(text).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.greatest(2 * n_words - 1, zero).alias("n_grams"),
        F.aggregate(points, zero, lambda total, x: total + x).alias("points"),
    )


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``measured`` for every row of ``docs`` (doc_id, text), with ``base_failed`` and ``kept``.

    ``labels`` (doc_id, quality, toxic) names the trusted target. Defined cases: a null, empty or
    wordless text has zeros and fails the base; very long texts are read whole; a score equal to
    the threshold is kept; without a target, or without held-back documents that pass the base, the
    base alone decides; rows without doc_id are measured and never trusted; repeated rows each count
    and give a row; an empty table gives an empty table; other columns are ignored.
    """
    target = stored(trusted(labels), "trusted")
    found = measured(docs, weights(bucket_counts(docs, target)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    found = stored(found.withColumn("base_failed", failed), "measured")
    held = found.where("NOT base_failed").join(_ids(target, "held"), F.col("doc_id") == F.col("trusted_id"))
    held = held.select(F.floor(F.col("points") / F.col("n_grams")).alias("score"))
    least, usual = held.selectExpr("percentile_disc(0.01) WITHIN GROUP (ORDER BY score)", "percentile_disc(0.5) WITHIN GROUP (ORDER BY score)").first()
    kept = ~F.col("base_failed")
    if least is not None:
        kept &= 2 * F.col("points") >= F.lit(3 * int(least) - int(usual)) * F.col("n_grams")
    return found.withColumn("kept", kept)

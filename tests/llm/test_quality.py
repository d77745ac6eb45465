"""Quality rules against plain Python."""

import collections
import math
import random
import re
import zlib

from pyspark.sql import functions as F

from tenureline.llm import quality

from .conftest import DOCUMENTS, rows


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def plain_grams(text):
    hashes = [zlib.crc32(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return [h % 65536 for h in hashes] + [(a * 8191 + b) % 65536 for a, b in zip(hashes, hashes[1:], strict=False)]


def corpus_of():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(1, 3)))
    clean = lambda n: "\n".join(" ".join(word() for _ in range(9)) for _ in range(n // 9 + 1))
    texts = [clean(draw.randint(60, 200)) for _ in range(120)]
    texts += [re.sub(" ", "*** ", t.upper()) for t in texts[:20]]
    texts += ["a a a a", "a b c d a b c", "x\ty\x0bz\x0cw\rv\nx\n\n x", "one\ntwo\none\n \n", "w " * 300, "#|<>", None, "", " \n", "\0 a  b c " * 20, clean(30_000)]
    return texts + texts[:2]


def test_quality_equals_plain_python(spark):
    texts = corpus_of()
    labels = [(i, 1, 0) for i in range(100)] + [(100, 1, 1), (101, None, 0), (102, 0, 0), (102, 1, 0), (None, 1, 0), (7, 1, None)]
    docs = spark.createDataFrame(rows(texts), DOCUMENTS).withColumn("words", F.lit("x")).withColumn("kept", F.lit("x")).repartition(4)
    got = {r["doc_id"]: r for r in quality.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == len(texts)
    trusted = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in range(100)}
    raw, target = collections.Counter(), collections.Counter()
    for i, text in enumerate(texts):
        raw.update(plain_grams(text))
        if trusted.get(i) is False:
            target.update(plain_grams(text))
    n_raw, n_target = sum(raw.values()) + 65536, sum(target.values()) + 65536
    weight = lambda b: round(65536 * math.log(((target[b] + 1) / n_target) / ((raw[b] + 1) / n_raw)))
    points = [sum(map(weight, plain_grams(t))) for t in texts]
    base = [plain_base(t) for t in texts]
    failed = [b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base]
    held = sorted(points[i] // len(plain_grams(texts[i])) for i, out in trusted.items() if out and not failed[i])
    least, usual = (held[max(0, math.ceil(q * len(held)) - 1)] for q in (0.01, 0.5))
    for i, r in got.items():
        assert tuple(r[x] for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base[i], texts[i]
        assert (r["points"], r["base_failed"]) == (points[i], failed[i])
        assert r["kept"] == (not failed[i] and 2 * points[i] >= (3 * least - usual) * len(plain_grams(texts[i])))
    assert sum(got[i]["kept"] for i in range(120)) >= 117 and not any(got[i]["kept"] for i in range(120, 140))


def test_without_a_target_the_base_decides(spark, corpus, no_documents):
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judged(no_documents, nothing).collect() == []
    got = quality.judged(corpus, nothing).collect()
    assert len(got) == corpus.count() and all(r["kept"] != r["base_failed"] for r in got)


def test_colliding_hashes_change_no_repeats(spark, monkeypatch):
    monkeypatch.setattr(quality, "_PLACE_BITS", 62)
    monkeypatch.setattr(quality, "_PLACE", (1 << 62) - 1)
    texts = ["a b c d e f a b c g", "a b c d e f g h", "b b b b a b"]
    df = quality.with_repeated_words(quality.with_words(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "n")
    assert [r["n"] for r in df.orderBy("doc_id").collect()] == [plain_base(t)[4] for t in texts]


def test_plan_has_no_python(spark, corpus):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = quality.measured(corpus, quality.weights(quality.bucket_counts(corpus, quality.trusted(labels))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_good_label_is_trusted(spark):
    """More of them than were taken once, whose ids meet the texts by a shuffle."""
    n = 90_000
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "IF(id % 3 = 0, 1, 0) AS toxic")
    assert quality.trusted(labels).count() == n - n // 3


def test_ids_that_are_not_broadcast_give_the_same(spark, monkeypatch):
    texts = corpus_of()
    docs = spark.createDataFrame(rows(texts) + [(None, *rows(texts)[0][1:])], DOCUMENTS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    few = sorted(map(tuple, quality.judged(docs, labels).collect()), key=repr)
    monkeypatch.setattr(quality, "BROADCAST_IDS", 5)
    counts = quality.bucket_counts(docs, quality.trusted(labels))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, quality.judged(docs, labels).collect()), key=repr) == few

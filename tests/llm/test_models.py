"""Character models against plain ones over dictionaries."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenureline.llm import langid, urlfilter


def plain_kneser_ney(texts):
    """log P of the last character of a 4-gram, by dictionaries of tuples."""
    letters = lambda t: "".join(x if x.isalpha() else " " for x in t.lower())
    squeezed = lambda t: letters(t).lstrip().replace("  ", " ") if t else t
    grams = lambda t: [tuple(("   " + t)[i : i + 4]) for i in range(len(t))]
    counts = {4: collections.Counter(g for t in texts for g in grams(squeezed(t)))}
    for order in (3, 2, 1):
        counts[order] = collections.Counter(g[1:] for g in counts[order + 1])
    uniform = 1 / (len(counts[1]) + 1)

    def probability(gram, order=4):
        if not order:
            return uniform
        own, lower = counts[order], probability(gram[1:], order - 1)
        same = [n for g, n in own.items() if g[:-1] == gram[:-1]]
        if not same:
            return lower
        ones, twos = (sum(n == k for n in own.values()) for k in (1, 2))
        discount = ones / (ones + 2 * twos) if ones else 0.5
        return max(own.get(gram, 0) - discount, 0) / sum(same) + discount * len(same) / sum(same) * lower

    return lambda t: -sum(math.log(probability(g)) for g in grams(t)) / len(t)


def test_cross_entropies_equal_plain_kneser_ney():
    draw = random.Random(1)
    learn = {"x": ["abc abd cab", "bad cab dab abc"], "y": ["eff fee effe", "fed beef feed eff"]}
    letters = langid.Letters()
    grams = [langid.counted(np.concatenate([letters.grams(t) for t in learn[lang]])) for lang in sorted(learn)]
    identifier = langid.Identifier(sorted(learn), grams)
    plain = [plain_kneser_ney(learn[lang]) for lang in sorted(learn)]
    for _ in range(60):
        text = " ".join("".join(draw.choice("abcdefz") for _ in range(draw.randint(1, 5))) for _ in range(draw.randint(1, 6)))
        n, nats = identifier.entropies(text)
        assert n == len(text) and nats == pytest.approx([p(text) for p in plain], abs=1e-9)


def test_ties_go_to_the_first_language():
    letters = langid.Letters()
    same = langid.counted(letters.grams("abc abc bca"))
    found = langid.Identifier(["b", "a"], [same, same]).predict("abc")
    assert found[0] == "b" and found[1] == pytest.approx(0.5)


def plain_witten_bell(urls):
    counts = collections.Counter(g for u in urls for g in urlfilter.grams(u).tolist())
    base = urlfilter.CLASSES
    digits = lambda g: tuple(g // base**k % base for k in range(urlfilter.ORDER - 1, -1, -1))
    by_order = [collections.Counter() for _ in range(urlfilter.ORDER + 1)]
    for g, n in counts.items():
        for order in range(1, urlfilter.ORDER + 1):
            by_order[order][digits(g)[-order:]] += n

    def probability(gram, order):
        if not order:
            return 1 / base
        lower = probability(gram, order - 1)
        same = [n for g, n in by_order[order].items() if g[:-1] == gram[-order:-1]]
        return (by_order[order][gram[-order:]] + len(same) * lower) / (sum(same) + len(same)) if same else lower

    return lambda u: [math.log(probability(digits(g), urlfilter.ORDER)) for g in urlfilter.grams(u).tolist()]


def test_url_scores_equal_plain_witten_bell(spark):
    draw = random.Random(2)
    path = lambda: "".join(draw.choice("abcxyz/-019é") for _ in range(draw.randint(0, 12)))
    urls = [f"http://{host}/{path()}" for host in ("good.org", "bad.net", "other.com") for _ in range(60)]
    urls += [None, "", "no scheme", "http://bad.net", "x://a/" + "longpath/" * 2000, urls[0], urls[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("score", F.lit("x"))
    rules = [("org/", "allow"), ("net/", "block")]
    rows = {r["page_id"]: r for r in urlfilter.judged(pages, rules).collect()}
    held = {r["page_id"] for r in pages.where(F.pmod(F.xxhash64("url"), F.lit(10)) == 0).collect()}
    fit = lambda verdict: plain_witten_bell([urls[i] for i, r in rows.items() if r["rule"] and r["verdict"] == verdict and i not in held])
    allow, block = fit("allow"), fit("block")
    assert len(rows) == len(urls)
    steps = collections.Counter()
    for i, r in rows.items():
        if i % 7 == 0 or r["rule"] and i in held or i >= 180:
            a, b = ((allow(urls[i] or ""), block(urls[i] or "")) if len(urls[i] or "") < 500 else ([], []))
            if a:
                assert r["score"] == pytest.approx(sum(a) / len(a) - sum(b) / len(b), abs=1e-4)
        if r["rule"] and i in held:
            steps[r["verdict"], math.floor(r["score"] * urlfilter.STEPS)] += 1
    threshold = urlfilter.calibrated_threshold([(v, s, n) for (v, s), n in steps.items()])
    for r in rows.values():
        assert r["rule"] or r["verdict"] == ("allow" if r["score"] >= threshold else "block")


def test_a_score_at_the_threshold_is_allowed():
    assert urlfilter.calibrated_threshold([("allow", 3, 5), ("block", 1, 5)]) == 2 / urlfilter.STEPS
    assert urlfilter.calibrated_threshold([("allow", 3, 5)]) == 0.0

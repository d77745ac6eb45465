"""Alignment of two tokenisations against a plain merge of their ends."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenureline.llm import alignment

from .conftest import DOCUMENTS, rows

A_PATH, B_PATH = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain(texts):
    """Per text: counts, links and groups, by dictionaries of ends."""
    a_model, b_model = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_model.encode_special_tokens = True
    a_bytes, b_bytes = alignment.a_bytes(A_PATH), alignment.b_bytes(B_PATH)
    out = []
    for text in texts:
        a, b = a_model.encode(f" {text or ''}", add_special_tokens=False).ids, b_model.encode(text or "")
        raw = f" {text or ''}".encode()
        if not text or any(b"".join(table[i] for i in ids) != raw for table, ids in ((a_bytes, a), (b_bytes, b))):
            a, b = [], []
        ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((a_bytes, a), (b_bytes, b))]
        at_b = {end: j for j, end in enumerate(ends[1])}
        cuts = [(i, at_b[end]) for i, end in enumerate(ends[0]) if end in at_b]
        groups, i0, j0 = [], 0, 0
        for i, j in cuts:
            groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
            i0, j0 = i + 1, j + 1
        out.append((len(a), len(b), ";".join(groups), [(a[i], b[j]) for i, j in cuts]))
    return out


def texts_of():
    draw = random.Random(9)
    parts = [*"abcdefg", " ", " ", "  ", "\n", "\t", "é", "中文", "🙂", "don't", " 123", "<|endoftext|>", "<s>", "<0x41>", "\0", "thhe", ".", "—", "ﬁ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    return [None, "", " ", "a", "has ▁ in it", "x" * 3000, "plain words of prose, " * 300, *texts, *texts[:3]]


@pytest.mark.parametrize("work", [7, alignment.PIECE_ENDS])
def test_alignment_equals_the_plain_merge(spark, work):
    texts = texts_of()
    expected = plain(texts)
    counts = collections.Counter(link for *_, links in expected for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    docs = spark.createDataFrame(rows(texts), DOCUMENTS).withColumn("groups", F.lit("x")).withColumn("key", F.lit("x")).repartition(3)
    found = alignment.aligned(docs, A_PATH, B_PATH, work=work)
    got = {r["doc_id"]: r for r in found.scored().collect()}
    assert len(got) == len(texts)
    for i, (n_a, n_b, groups, links) in enumerate(expected):
        r = got[i]
        assert (r["n_a"], r["n_b"], r["groups"]) == (n_a, n_b, groups), texts[i]
        sums = (len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
        assert (r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == (len(links), *sums)
    assert {(r["a_id"], r["b_id"]): r["n"] for r in found.pair_counts().collect()} == counts
    if work == 7:
        digests = alignment.aligned(docs, A_PATH, B_PATH, work=work, digest=True).documents.collect()
        for r in digests:
            groups = expected[r["doc_id"]][2]
            assert r["groups"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_alignment_of_odd_rows(spark, no_documents):
    assert alignment.aligned(no_documents, A_PATH, B_PATH).scored().collect() == []
    docs = spark.createDataFrame([(None, "same words"), (5, "same words"), (5, "same words")], "doc_id long, text string")
    got = alignment.aligned(docs, A_PATH, B_PATH).scored().collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in got) == [(0, 2, 6), (5, 2, 6), (5, 2, 6)]


def test_diagonals_cut_the_merge_path_into_equal_work():
    draw = random.Random(2)
    for _ in range(300):
        a, b = (np.array(sorted(draw.sample(range(200), draw.randint(0, 60))), np.int64) for _ in range(2))
        work = draw.randint(1, 20)
        i, j = alignment.diagonals(a, b, work)
        shared = []
        for k in range(len(i) - 1):
            x, y = alignment.merged(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
            shared += a[i[k] + x].tolist()
            assert (i[k + 1] - i[k]) + (j[k + 1] - j[k]) <= work + 1
        assert shared == sorted(set(a.tolist()) & set(b.tolist()))
        assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()


def test_short_model_equals_the_library_on_latin_texts():
    both = alignment.Tokenisers(A_PATH, B_PATH)
    assert both.short_model is not None
    pairs = [f" a{chr(x)}{chr(y)}b 1{chr(y)} {chr(x)}" for x in range(0, 256, 3) for y in range(256)]
    library = both.a_model.encode_batch(pairs, add_special_tokens=False)
    assert all(x.tolist() == y.ids for x, y in zip(both.a_ids(pairs), library, strict=True))

"""Operators on pairs, groups and searches, against brute force."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenureline.llm import chat, components, near_vectors, ngram_join, topk, urlfilter
from tenureline.llm.queries import CONTROL_TURNS, URL_RULES

from .conftest import DOCUMENTS, rows


def joined(pairs, nodes):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("bound", [0, 500_000])
def test_components(spark, monkeypatch, bound):
    monkeypatch.setattr(components, "TASK_LINKS", bound)
    draw = random.Random(1)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = joined(pairs, {x for p in pairs for x in p})
    assert got == {x: expected[x] for x in got}
    assert {x for a, b in pairs if a != b for x in (a, b)} <= set(got)


def plain_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_copies():
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(draw.randint(5, 120))]
        for _ in range(draw.randint(1, 12)):
            own = list(base)
            for _ in range(draw.randint(0, 6)):
                own[draw.randrange(len(own))] = word()
            texts.append(" ".join(own))
    texts += [" ".join([*passage, *(word() for _ in range(draw.randint(0, 40)))]) for _ in range(60)]
    return texts + texts[:20]


def test_ngram_join_equals_all_pairs(spark, corpus):
    for docs in (corpus.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), spark.createDataFrame(rows(near_copies()), DOCUMENTS).repartition(5)):
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        sets = {i: plain_sets(t) for i, t in texts.items()}
        pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
        expected = joined(pairs, sets)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(docs).collect()}
        assert got == {i: (len(sets[i]), expected[i]) for i in sets}


def test_ngram_join_cases(corpus, no_documents):
    got = ngram_join.similar_documents(corpus).collect()
    assert len(got) == corpus.count()
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [6]
    assert ngram_join.similar_documents(no_documents).collect() == []


def test_nul_is_a_letter_of_words(spark):
    texts = ["a\0b c d e f", "a b c d e f", "\0 b c d e", "b c d e", "a\0 b c d e", "a b c d e", "\0\0 b c d e"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(spark.createDataFrame(rows(texts), DOCUMENTS)).collect()}
    sets = {i: plain_sets(t) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    groups = joined(links, sets)
    assert got == {i: (len(sets[i]), groups[i]) for i in sets}


def test_words_that_collide_in_polynomial_hashes(spark):
    letters = "a"
    for _ in range(10):
        letters += letters.translate(str.maketrans("ab", "ba"))
    other = letters.translate(str.maketrans("ab", "ba"))
    texts = [f"one {x} two three four five" for x in (letters, other, letters.upper())]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(spark.createDataFrame(rows(texts), DOCUMENTS)).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def test_classes_that_share_a_digest_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "DIGEST_BITS", 2)
    docs = spark.createDataFrame(rows(near_copies()[:60]), DOCUMENTS)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    sets = {i: plain_sets(t) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(docs).collect()}
    assert got == joined(links, sets)


def vectors(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(25, 16))
    data = []
    for i in range(300):
        v = base[i % 25] + draw.normal(size=16) * (0.02 if i % 3 else 0.3)
        data.append((i, v.astype(float).tolist(), int(i % 4) if i % 11 else None))
    data += [(400, None, 1), (401, [0.0] * 16, 1), (402, [1.0, None] * 8, 1), (403, [float("nan")] * 16, 1), (404, [], 1), (405, [float("inf")] * 16, 2), (406, data[1][1], 1), (407, data[1][1], 1)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), data


def test_near_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(near_vectors, "TILE", 16)
    df, data = vectors(spark)
    usable = {i: np.array(v) for i, v, label in data if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    labels = {i: label for i, _, label in data}
    pairs = [(a, b) for a, b in itertools.combinations(usable, 2) if labels[a] == labels[b] and usable[a] @ usable[b] >= 0.93 * np.linalg.norm(usable[a]) * np.linalg.norm(usable[b])]
    expected = joined(pairs, labels)
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(df.withColumn("copies", F.lit("x"))).collect()}
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (sum(i in p for p in pairs), expected[i], expected[i] == i) for i in labels}
    assert near_vectors.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("cell_bytes", [0, 1 << 16])
def test_near_vectors_in_cells(spark, monkeypatch, cell_bytes):
    # 30 blocks, alone in their cells and three on a side; one cluster over all of them, one label
    monkeypatch.setattr(near_vectors, "BLOCK_VECTORS", 10)
    monkeypatch.setattr(near_vectors, "CELL_BYTES", cell_bytes)
    assert near_vectors._cell_blocks(30, 16) == (3 if cell_bytes else 1)
    draw = np.random.default_rng(8)
    center = draw.normal(size=16)
    data = [(i, (center + draw.normal(size=16) * (0.05 if i % 2 else 0.25)).tolist(), 1) for i in range(300)]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in data}
    pairs = [(a, b) for a, b in itertools.combinations(unit, 2) if unit[a] @ unit[b] >= 0.93]
    expected = joined(pairs, unit)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(pairs) > 5000 and got == {i: (sum(i in p for p in pairs), expected[i]) for i in unit}


def test_near_vectors_of_odd_rows(spark):
    # null ids, rows repeated under one id, vectors of different length
    data = [(None, [1.0, 0.0], 1), (3, [2.0], 1), (4, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], 1), (5, [0.0, 1.0], 1), (None, [0.0, 1.0], 2), (6, [1.0, 0.0], None)]
    rows = near_vectors.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()
    none = lambda x: (x is None, x or 0)
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows), key=lambda r: (none(r[0]), r[1]))
    assert got == [(3, 3, 3, True), (4, 3, 3, False), (4, 3, 3, False), (5, 0, 5, True), (6, 0, 6, True), (None, 0, None, False), (None, 3, 3, False)]


@pytest.mark.parametrize("block", [16, 8192])
def test_top_k_equals_full_scoring(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    df, data = vectors(spark)
    ok = {i: np.floor(64 * np.array(v + [0.0] * (16 - len(v)))).astype(int) for i, v, _ in data if v is not None and None not in v and np.isfinite(v).all()}
    expected = []
    for q in (i for i in ok if i % 20 == 0):
        best = sorted(((-int(ok[q] @ ok[c]), c) for c in ok if c != q))[:20]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    named = df.withColumn("rank", F.lit("x"))
    got = [tuple(r) for r in topk.top_k(named, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted(expected)
    # rows that share a vec_id: other vectors, and an equal one
    more = df.where("vec_id IN (40, 41, 42)").withColumn("vec_id", F.lit(7).cast("long"))
    shared = df.unionByName(more).unionByName(df.where("vec_id IN (20, 7)")).unionByName(df.where("vec_id = 60").withColumn("vec_id", F.lit(20).cast("long")))
    rows = [(r["vec_id"], np.floor(64 * np.array(list(r["embedding"]) + [0.0] * (16 - len(r["embedding"])))).astype(int)) for r in shared.collect() if r["vec_id"] in ok]
    expected = []
    for q in {i for i, _ in rows if i % 20 == 0}:
        best = sorted((-int(x @ y), c) for i, x in rows if i == q for c, y in rows if c != q)[:20]
        expected += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    got = [tuple(r) for r in topk.top_k(shared, F.col("vec_id") % 20 == 0).select("query_id", "rank", "vec_id", "score").collect()]
    assert sorted(got) == sorted(expected)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).collect() == []


def test_rows_under_one_vec_id_are_candidates(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.1, 0.0]), (1, [0.9, 0.0]), (2, [0.5, 0.0]), (None, [9.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 20).select("vec_id", "score").collect()]
    assert sorted(got, reverse=True) == [(2, 2048), (1, 3648), (1, 384)]


def test_adding_stops_early_and_results_stay(spark):
    draw = np.random.default_rng(4)
    x = np.floor(64 * draw.normal(size=(4000, 32)) * 2.0 ** -np.arange(32))
    ids, queries = np.arange(4000), x[:50]
    blocks = [topk.ImpactIndex(ids[i : i + 1000], x[i : i + 1000]) for i in range(0, 4000, 1000)]
    a, found, scores = topk.searched(blocks, queries, ids[:50], 20)
    assert all(block.added < len(block.levels) for block in blocks)
    for q in range(50):
        best = sorted((-int(queries[q] @ x[c]), c) for c in range(4000) if c != q)[:20]
        assert list(zip((-scores[a == q]).tolist(), found[a == q].tolist(), strict=True)) == best


def test_scores_beyond_64_bits_raise():
    with pytest.raises(OverflowError):
        topk.ImpactIndex(np.arange(2), np.full((2, 4), 2.0**32)).best(np.full((1, 4), 2.0**32), np.array([9]), 1)


def turns(spark):
    data = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < c % 4 else f"own {c} {t}") for c in range(30) for t in range(1 + c % 5)]
    data += [(50, 0, None, None), (50, 1, "assistant", None), (51, 0, "assistant", "<s>\\[/INST] [\\INST] < s>"), (51, 0, "assistant", "<s>\\[/INST] [\\INST] < s>"), (None, 0, "user", "turn 0"), *CONTROL_TURNS]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), data


def test_chat_round_trip_and_tree(spark):
    df, data = turns(spark)
    nodes, members = chat.formatted(df.withColumn("piece", F.lit("x")))
    got = {r["conv_id"]: r for r in chat.conversations_of(nodes, members).collect()}
    for conv_id in {c for c, *_ in data}:
        own = [(r or "", t or "") for c, _, r, t in data if c == conv_id]
        loss = "".join(t for r, t in own if r == "assistant")
        expected = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(chat.rendered(r, t)) for r, t in own))
        assert tuple(got[conv_id])[1:] == expected, conv_id
    tree = {r["node"]: r for r in nodes.collect()}
    assert len(tree) == nodes.count() == members.select("node").distinct().count()
    ordered = sorted(tree.values(), key=lambda r: r["start"])
    assert ordered[0]["start"] == 0 and all(a["start"] + a["length"] == b["start"] for a, b in itertools.pairwise(ordered))
    for r in ordered:
        above, at = [], r
        while at["parent"] is not None:
            at = tree[at["parent"]]
            above.insert(0, (at["start"], at["start"] + at["length"]))
        covered = []
        for a, b in above:
            chat._lengthened(covered, a, b)
        assert [list(x) for x in r["attends"]] == covered
        assert r["position"] == sum(b - a for a, b in above) and r["depth"] == len(above)


def test_chat_paths_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(chat, "PATH_ROWS", 3)
    test_chat_round_trip_and_tree(spark)


def test_chat_of_a_long_conversation(spark):
    # one conversation of 5000 turns, one that leaves it half way, one very long text
    data = [(1, t, "user", f"t{t}") for t in range(5000)] + [(2, t, "user", f"t{t}" if t < 2500 else "x") for t in range(3000)] + [(3, 0, "assistant", "y" * 2_000_000)]
    nodes, members = chat.formatted(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.conversations_of(nodes, members).collect()}
    assert got == {1: (5000, 0), 2: (3000, 0), 3: (1, 2_000_000)}
    most = nodes.agg(F.count("*").alias("n"), F.max(F.size("attends")).alias("most")).first()
    assert (most["n"], most["most"]) == (5501, 2)


def test_chat_reading_back_needs_the_intervals(spark):
    nodes, members = chat.formatted(turns(spark)[0])
    for wrong in (nodes.withColumn("start", F.col("start") + F.col("depth")), nodes.withColumn("position", F.col("position") + 1), nodes.withColumn("attends", F.slice("attends", 2, 100))):
        with pytest.raises(Exception, match="attends to|has position"):
            chat.conversations_of(wrong, members).collect()


def test_chat_escapes():
    draw = random.Random(4)
    for _ in range(3000):
        role, text = ("".join(draw.choice(["<", "/", "s>", "[", "INST]", "\\", "a", "</s>", "<s>", "[/INST]"]) for _ in range(draw.randint(0, 8))) for _ in range(2))
        assert chat.parsed(chat.rendered(role, text)) == (role, text)
        assert not re.search(r"</?s>|\[/?INST\]", chat.escaped(text))


def test_chat_empty(spark):
    df, _ = turns(spark)
    assert chat.conversations_of(*chat.formatted(df.limit(0))).collect() == []


def test_url_rules(spark):
    urls = [
        "http://a.example.net/en/1", "HTTP://A.EXAMPLE.NET/en/1", "http://example.net/de/", "http://x.net", "http://net/", "http://badexample.com/de/", "https://example.com/de/?q#f",
        "https://w.org/fr/x?y=/z", "nothing", None, "", "http://", "http://café.org/fr/", "ftp://u@h:80#a/b",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in urlfilter.judged(df, URL_RULES).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("a.example.net", "/en/1", "example.net/en/"), ("example.net", "/de/", "net/"), ("x.net", "", None), ("net", "/", "net/"),
        ("badexample.com", "/de/", None), ("example.com", "/de/", "example.com/de/"), ("w.org", "/fr/x", "org/fr/"), ("", "", None), ("", "", None), ("", "", None), ("", "", None),
        ("café.org", "/fr/", "org/fr/"), ("u@h:80", "", None),
    ]
    assert urlfilter.judged(df.limit(0), URL_RULES).collect() == []


def test_url_models_tell_unseen_urls_apart(spark):
    data = [(i, f"http://{'good' if i % 2 else 'evil'}{i}.{'org/fr' if i % 2 else 'net/de'}/{'news' if i % 2 else 'casino'}/{i}") for i in range(400)]
    data += [(1000, "http://x.com/news/17"), (1001, "http://x.com/casino/17")]
    got = {r["page_id"]: r for r in urlfilter.judged(spark.createDataFrame(data, "page_id long, url string"), URL_RULES).collect()}
    assert (got[1000]["verdict"], got[1001]["verdict"]) == ("allow", "block")
    counts = np.zeros(urlfilter.CLASSES**urlfilter.ORDER, np.int64)
    np.add.at(counts, urlfilter.grams("http://a.b/c"), 1)
    p = np.exp(urlfilter.Markov(counts).logs).reshape(-1, urlfilter.CLASSES)
    assert np.allclose(p.sum(axis=1), 1)

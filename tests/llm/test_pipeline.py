"""The pipeline's stages, each against a plain version on its own input."""

import itertools
import struct

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tenureline.llm import packing, pii
from tenureline.llm.staging import stored

from .test_groups import joined, plain_sets

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    inputs, names = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(stored(stage(spark, inputs[-1], SMALL), name.replace(" ", "-")))
    rows = [{r["doc_id"]: r for r in df.collect()} for df in inputs[:-1]]
    assert all(df.columns == names for df in inputs[:-1])

    assert set(rows[1]) == {i for i, r in rows[0].items() if any(x.isalpha() for x in r["text"] or "")}
    assert all(rows[1][i]["text"] == rows[0][i]["text"] for i in rows[1])

    sets = {i: plain_sets(r["text"]) for i, r in rows[1].items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert set(rows[2]) == set(joined(links, sets).values())

    finder = pii.Finder()
    for i, r in rows[3].items():
        text = rows[2][i]["text"]
        assert (r["text"], r["n_chars"]) == (pii.masked(text, finder.spans(text)), len(r["text"]))
    assert set(rows[3]) == set(rows[2])

    library, total = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    for r in inputs[-1].collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    assert total == {i: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for i, r in rows[3].items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "ids_crc32").collect())) == sorted(map(tuple, inputs[-1].select("doc_id", "ids_crc32").collect()))


def test_places_outlast_another_split_of_the_scan(spark, monkeypatch, tmp_path):
    data = [(i, f"word{i} of many in text {i} here" if i % 2 else "the same six words as before", "en", "s", 30) for i in range(200)]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(16).write.parquet(str(tmp_path / "docs"))
    similar = corpus_pipeline.ngram_join.similar_documents

    def slots(n):
        # the split of a scan follows the slots registered at that moment
        spark.conf.set("spark.sql.files.minPartitionNum", str(n))

    def cluster_shrinks(*args, **kwargs):
        out = similar(*args, **kwargs)
        slots(1)
        return out

    monkeypatch.setattr(corpus_pipeline.ngram_join, "similar_documents", cluster_shrinks)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    slots(16)
    try:
        kept = corpus_pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "docs")), SMALL).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r["doc_id"] for r in kept) == [0, *range(1, 200, 2)]


def test_result_holds_the_training_sequences(spark):
    data = [(i, "the owls watch the barn " * (i % 7 + 1), "en", "s", 30) for i in range(40)] + [(40, "barn owl " * 3000, "en", "s", 27000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    placed = stored(corpus_pipeline.best_fit_packing(spark, docs, SMALL), "best-fit-packing")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(text, add_special_tokens=False).ids, 0] for i, text, *_ in data}
    pieces = {(r["sequence_id"], r["offset"]): ids[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in placed.collect()}
    for r in packing.sequences(placed).collect():
        own = [x for at in sorted(at for at in pieces if at[0] == r["sequence_id"]) for x in pieces[at]]
        assert list(struct.unpack(f"<{r['length']}I", r["ids"])) == own


def test_odd_rows(spark, corpus):
    """Nulls in any column, empty and long texts, repeated rows, columns with the stages' own names."""
    docs = corpus.unionByName(corpus.where("doc_id = 8")).withColumn("source", F.when(F.col("doc_id") > 3, "s"))
    for name in ("place", "lang_pred", "rejected", "held_out", "piece", "sequence_id", "offset", "ids", "spans", "own_id"):
        docs = docs.withColumn(name, F.lit("x"))
    docs = stored(docs, "odd")
    rows = docs.collect()
    run = lambda i: [tuple(r) for r in stored(corpus_pipeline.STAGES[i][1](spark, docs, SMALL), "odd-out").collect()]
    order = lambda xs: sorted(xs, key=repr)

    kept = run(0)
    assert order((r[0], r[1]) for r in kept) == order((r["doc_id"], r["text"]) for r in rows if any(x.isalpha() for x in r["text"] or "") and any(r["text"] == k[1] for k in kept))
    assert all(any(k[1] == r["text"] for k in kept) for r in rows if len(r["text"] or "") > 200)

    sets = {i: plain_sets(r["text"]) for i, r in enumerate(rows)}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    groups = {}
    for i, group in joined(links, sets).items():
        groups.setdefault(group, []).append(rows[i]["doc_id"])
    first = [min(ids, key=lambda x: (x is None, x or 0)) for ids in groups.values()]
    assert order(r[0] for r in run(1)) == order(first)

    finder = pii.Finder()
    plain = [(r["text"] if r["text"] is None else pii.masked(r["text"], finder.spans(r["text"]))) for r in rows]
    assert order((r[0], r[1], r[4]) for r in run(2)) == order((r["doc_id"], text, text if text is None else len(text)) for r, text in zip(rows, plain, strict=True))

    library, total = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {}
    for r in stored(corpus_pipeline.best_fit_packing(spark, docs, SMALL), "odd-packed").collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
    wanted = {}
    for r in rows:
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    assert total == wanted


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), name.replace(" ", "-"))
        assert docs.count() == 0

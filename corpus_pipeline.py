"""A training corpus from documents, in four stages; each works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureline.llm import langid, ngram_join, packing, pii
from tenureline.llm.staging import stored
from tenureline.sources.publish import fresh_path, remove, scratch, stage_at

#: Words whose ids a worker remembers: fewer than alone, as workers hold memory of earlier stages.
REMEMBERED_WORDS = 60_000
#: Rows sent to Python at once, unless the session asks for a number of its own: texts are long, and
#: the tasks of an executor share its memory.
ARROW_ROWS = 500
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _small_batches(spark: SparkSession) -> None:
    """Results are lazy, so the setting has to outlast a stage; ``run`` takes it back."""
    if spark.conf.get(_BATCH) == _DEFAULT:
        spark.conf.set(_BATCH, str(ARROW_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; where ``lang`` is null, the predicted one fills it.

    Texts that are null, have no letter, or are nearer to noise than to any language go.
    """
    _small_batches(spark)
    found = langid.identified(docs, docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    return found.where("NOT rejected").withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that of the smallest doc_id, null last.

    Rows are told apart by their place, stored with them, since a scan may be split anew each time;
    so repeated rows and rows without doc_id are documents like any other; documents without words
    are all kept.
    """
    placed = stored(docs.withColumn("place", F.monotonically_increasing_id()), "placed")
    groups = ngram_join.similar_documents(placed.select(F.col("place").alias("doc_id"), "text"), size=5, percent=75)
    rows = groups.join(placed.select(F.col("place").alias("doc_id"), F.col("doc_id").alias("own_id")), "doc_id")
    first = F.struct(F.col("own_id").isNull().alias("no_id"), "own_id", F.col("doc_id").alias("place"))
    kept = rows.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first.place").alias("place"))
    return placed.join(kept, "place", "left_semi").select(COLUMNS)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; ``n_chars`` follows the new text.

    A null text stays null, with null ``n_chars``; an empty one, and one without spans, stay as they
    are; repeated rows and rows without doc_id are treated alike; an empty table stays empty.
    """
    _small_batches(spark)
    return docs.withColumn("text", pii.without_spans()).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their token ids and their places in sequences of 2048 tokens.

    A null or empty text has the end token alone; longer documents are cut; repeated rows are
    packed like any others; a null doc_id stays null; an empty table gives no pieces.
    """
    _small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenised_pieces(docs, path, capacity=2048, end_id=0, remembered=REMEMBERED_WORDS)
    return packing.packed(pieces, capacity=2048)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", without_pii),
    ("best-fit packing", best_fit_packing),
]

#: Language models, similarity groups and tokenisation have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stores for itself goes when its result is written, and
    that result when the next one is."""
    batch = spark.conf.get(_BATCH)
    try:
        return _run(spark, sf_dir)
    finally:
        spark.conf.set(_BATCH, batch)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            docs = stage_at(stage(spark, docs, sf_dir), path)
        if held:
            remove(spark, held)
        held = path
    return docs

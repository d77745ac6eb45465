"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, langid, licenses, near_vectors, ngram_join, packing, pii, quality, topk, urlfilter, whitening

#: Rules of the URL filter: host and path prefix, verdict.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: A conversation whose texts hold the template's control strings.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found_spans(_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encoded(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    back = bpe.decoded(ids, ranks)
    digest = lambda name: F.sha2(name, 256)
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return back.select("doc_id", n_tokens.alias("n_tokens"), digest("ids").alias("ids_sha256"), digest("bytes").alias("decoded_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    found = langid.identified(docs.select("doc_id", "held_out", "text"), docs.where("NOT held_out AND doc_id IS NOT NULL"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenised_pieces(_table(spark, sf_dir, "documents"), path, capacity=2048, end_id=0, keep_ids=False)
    return packing.packed(pieces, capacity=2048)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return licenses.scanned(docs.select(licenses.document_path().alias("path"), "text"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.conversations_of(*chat.formatted(turns.unionByName(extra)))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"), size=5, percent=75)


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"), k=4, scale=256.0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = alignment.aligned(_table(spark, sf_dir, "documents"), *paths, digest=True).scored()
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_byte_bpe, op3_language_id, op4_url_filter, op5_top_k, op6_packing, op7_license_scan, op8_chat_format, op9_ngram_join, op10_near_vectors, op11_quality_rules, op12_whitening, op13_token_alignment)
}

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_TOP_K = f"""
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 20"""

#: The template of chat.rendered: its control strings, and the escape after their first character.
_CHAT = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    rendered AS (
        SELECT *, 13 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g'))
                     + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS chars
        FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM rendered GROUP BY conv_id"""

#: Groups under links (a, b) of nodes: the smallest node that links reach.
_REACHED = """
    reached(node, root) AS (
        SELECT node, node FROM nodes
        UNION
        SELECT reached.node, b FROM reached JOIN links ON a = root),
    grouped AS (SELECT node, min(root) AS component FROM reached GROUP BY node)"""

_NGRAMS = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    grams AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
            ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS gram
        FROM words),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
        WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
    nodes AS (SELECT DISTINCT doc_id AS node FROM documents),
    {_REACHED}
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN grouped ON node = d.doc_id"""

_NEAR_VECTORS = f"""
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE label IS NOT NULL AND {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id
        WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
    nodes AS (SELECT vec_id AS node FROM embeddings),
    {_REACHED}
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component AS component_id, vec_id = component AS kept
    FROM embeddings JOIN grouped ON node = vec_id"""

#: CRC-32 of words, bit by bit for its table. The bound of the target is above the labels of this size.
_QUALITY = r"""
    WITH RECURSIVE bits(i, k, c) AS (
        SELECT i, 0, i FROM range(256) AS t(i)
        UNION ALL
        SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
    crc_table AS (SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8),
    texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    lists AS (SELECT r, doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM texts),
    words AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(len(w))) AS place FROM lists),
    hashed AS (
        SELECT word, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, CAST(octet_length(encode(word)) AS BIGINT) + 1), lambda i: CAST('0x' || hex(encode(word))[2 * i - 1:2 * i] AS BIGINT))),
                   lambda c, b: xor(c >> 8, steps[xor(c % 256, b) + 1]))) AS h
        FROM (SELECT DISTINCT word FROM words), crc_table),
    placed AS (
        SELECT r, doc_id, place, word, h, lead(h) OVER own AS next_h, lead(word) OVER own AS w1, lead(word, 2) OVER own AS w2
        FROM words JOIN hashed USING (word) WINDOW own AS (PARTITION BY r ORDER BY place)),
    grams AS (
        SELECT r, doc_id, h % 65536 AS bucket FROM placed
        UNION ALL
        SELECT r, doc_id, (h * 8191 + next_h) % 65536 FROM placed WHERE next_h IS NOT NULL),
    trusted AS (
        SELECT doc_id AS trusted_id FROM labels WHERE doc_id IS NOT NULL
        GROUP BY doc_id HAVING min(quality) = 1 AND coalesce(max(toxic), 0) = 0),
    id_bytes AS (
        SELECT trusted_id, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(range(1, len(CAST(trusted_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(trusted_id AS VARCHAR)[i]) AS BIGINT))),
                   lambda c, b: xor(c >> 8, steps[xor(c % 256, b) + 1]))) % 10 = 0 AS held
        FROM trusted, crc_table),
    counts AS (
        SELECT bucket, count(*) AS raw, count(trusted_id) AS good
        FROM grams LEFT JOIN id_bytes ON doc_id = trusted_id AND NOT held GROUP BY bucket),
    totals AS (SELECT sum(raw) + 65536.0 AS n_raw, sum(good) + 65536.0 AS n_good FROM counts),
    weights AS (
        SELECT bucket, CAST(round_even(65536 * ln(((good + 1.0::DOUBLE) / n_good::DOUBLE) / ((raw + 1.0::DOUBLE) / n_raw::DOUBLE)), 0) AS BIGINT) AS weight FROM counts, totals),
    points AS (SELECT r, count(*) AS n_grams, CAST(sum(weight) AS BIGINT) AS points FROM grams JOIN weights USING (bucket) GROUP BY r),
    again AS (SELECT r, unnest(list(place)) AS place FROM placed WHERE w2 IS NOT NULL GROUP BY r, word, w1, w2 HAVING count(*) > 1),
    repeated AS (SELECT r, count(DISTINCT place + k) AS n_repeat_words FROM again, range(3) AS t(k) GROUP BY r),
    lines AS (
        SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    measured AS (
        SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
               len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_grams, 0) AS n_grams, coalesce(points, 0) AS points,
               len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
        FROM texts JOIN lists USING (r, doc_id) LEFT JOIN points USING (r) LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
    edge AS (
        SELECT quantile_disc(score, 0.01) AS least, quantile_disc(score, 0.5) AS usual
        FROM (SELECT CAST(floor(points / n_grams) AS BIGINT) AS score FROM measured JOIN id_bytes ON doc_id = trusted_id AND held WHERE NOT base_failed))
    SELECT measured.*, NOT base_failed AND coalesce(2 * points >= (3 * least - usual) * n_grams, true) AS kept FROM measured, edge"""

#: Where SQL has no form (spans, tokens, language and URL models, packing, TF-IDF rounding),
#: tests/llm compares with brute force, a library or held-out documents.
ORACLE_SQL: dict[str, str] = {
    "op5_top_k": _TOP_K,
    "op8_chat_format": _CHAT,
    "op9_ngram_join": _NGRAMS,
    "op10_near_vectors": _NEAR_VECTORS,
    "op11_quality_rules": _QUALITY,
}

"""The operators of this package as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.llm import conversation_sql
from formlake.llm.byte_bpe import encode_and_decode
from formlake.llm.conversation_repair import report_damage
from formlake.llm.exact_dedup import exact_duplicates
from formlake.llm.hard_negatives import mine_hard_negatives
from formlake.llm.language_id import predict_language
from formlake.llm.main_text import extract_main_text
from formlake.llm.packing import pack_documents
from formlake.llm.quality import score_quality
from formlake.llm.simhash import simhash_components
from formlake.llm.token_counts import count_tokens
from formlake.llm.token_files import read_token_files, write_token_files
from formlake.llm.toxicity import score_toxicity
from formlake.llm.vector_topk import top_k
from formlake.llm.workers import share_package
from formlake.session import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def _query(function):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        share_package(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of every document, read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)
    return read_token_files(spark, path, with_ids=False)


@_query
def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document, and their bytes again."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_and_decode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@_query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Piece counts of every document."""
    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of every document among those with equal texts."""
    groups = exact_duplicates(_table(spark, folder, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op1_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY length(text) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY length(text) DESC, doc_id) AS kept,
       sha256(body) AS text_sha256
FROM d
"""


@_query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document, and its component of near-duplicates."""
    return simhash_components(_table(spark, folder, "documents"))


@_query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2,048 tokens."""
    return pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), added_tokens=True)


@_query
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(_table(spark, folder, "pages"))


@_query
def op5_vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best vectors for every hundredth one."""
    return top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op5_vector_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@_query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, with the labelled examples it rests on."""
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document."""
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


# All pages of these tables mark their article, so SQL can cut it out.
ORACLES["op10_main_text"] = r"""
WITH articles AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages
), blocks AS (
    SELECT page_id, url, list_transform(
        string_split_regex(body, '</?(?:p|h1)>'),
        lambda x: trim(regexp_replace(replace(replace(replace(replace(
            regexp_replace(x, '<[^>]*>', ' ', 'g'),
            '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))
    ) AS parts
    FROM articles
), texts AS (
    SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') AS text
    FROM blocks
)
SELECT page_id, url, text, length(text) AS n_chars FROM texts
"""


@_query
def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, and whether the answer is sure enough."""
    return predict_language(_table(spark, folder, "documents"))


@_query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """What was wrong with every damaged conversation, and its cheapest repair."""
    return report_damage(_table(spark, folder, "conversations"))


ORACLES["op12_conversation_repair"] = conversation_sql.ORACLE


@_query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, with one label in seven moved on."""
    vectors = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
           CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

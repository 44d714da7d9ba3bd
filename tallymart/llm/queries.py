"""The operators of this package as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.chat_format import conversation_digests, format_conversations
from tallymart.llm.exact_topk import top_k
from tallymart.llm.fingerprints import fingerprint_documents
from tallymart.llm.hard_negatives import mine
from tallymart.llm.language_id import identify
from tallymart.llm.merge_replay import decoded_digests, encode_documents
from tallymart.llm.packing import pack
from tallymart.llm.secret_scan import scan_documents
from tallymart.llm.shingle_join import link_documents
from tallymart.llm.spelling_variants import spelling_variants
from tallymart.llm.substring_dedup import remove_repeats
from tallymart.llm.support import table
from tallymart.llm.token_records import token_records
from tallymart.llm.warc_io import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, capacity=2048)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A conversation whose texts imitate the marks of a template.
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversation_digests(format_conversations(conversations.unionByName(tricky)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op9_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return decoded_digests(encoded, BYTE_RANKS, public_tokenizers.PATTERN)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Labels of some rows are wrong on purpose.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)
    return mined.drop("positive_rank")


def queries() -> dict[str, Query]:
    return {
        "op1_token_records": op1_token_records,
        "op2_secret_scan": op2_secret_scan,
        "op3_exact_topk": op3_exact_topk,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_language_id": op5_language_id,
        "op6_shingle_join": op6_shingle_join,
        "op7_chat_format": op7_chat_format,
        "op8_warc": op8_warc,
        "op9_merge_replay": op9_merge_replay,
        "op10_fingerprints": op10_fingerprints,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_substring_dedup": op12_substring_dedup,
        "op13_hard_negatives": op13_hard_negatives,
    }


OP3_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


# The template's marks, and how texts are escaped, as in chat_format.
OP7_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped AS (
    SELECT *, regexp_replace(replace(text, '\', '\\'), marks, '\1\\\2', 'g') AS inside,
        regexp_replace(replace(role, '\', '\\'), marks, '\1\\\2', 'g') AS named
    FROM turns, (SELECT '([<\[])(/?s>|image>|audio>|document>|/?SYS\]|/?INST\]|/?ROLE\])' AS marks)
),
formatted AS (
    SELECT conv_id, turn, role, text, '<s>' || CASE role
        WHEN 'system' THEN '[SYS] ' || inside || ' [/SYS]'
        WHEN 'user' THEN '[INST] ' || inside || ' [/INST]'
        WHEN 'assistant' THEN inside
        ELSE '[ROLE]' || named || '[/ROLE] ' || inside END || '</s>' AS formatted
    FROM escaped
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
    CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id
"""

# Base32 of a SHA-1: five hexadecimal digits are four of its digits.
OP8_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha
    FROM pages
),
named AS (
    SELECT *, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS response FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(sha, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT))
            & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> response THEN response END AS refers_to
FROM named
"""

OP12_SQL = """
WITH words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
    FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM documents)
),
followed AS (
    SELECT doc_id, pos, word,
        list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS run
    FROM words
),
ranked AS (
    SELECT doc_id, pos, word, len(run) = 20
        AND row_number() OVER (PARTITION BY array_to_string(run, ' ') ORDER BY doc_id, pos) > 1 AS again
    FROM followed
),
covered AS (
    SELECT doc_id, pos, word,
        max(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM ranked
),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
    FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

OP13_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM whole a JOIN whole c ON c.vec_id <> a.vec_id
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
near AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM near WHERE place <= 5
"""


def oracle_sql() -> dict[str, str]:
    """Queries that SQL can express."""
    return {"op3_exact_topk": OP3_SQL, "op7_chat_format": OP7_SQL, "op8_warc": OP8_SQL, "op12_substring_dedup": OP12_SQL,
        "op13_hard_negatives": OP13_SQL}

"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, htmltext, langid, media, packing, simhash, toxicity, urlfilter, warc
from .common import table


def op1_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_media_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_corpus(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(chat.streamed_events(turns)))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


OPERATORS = (
    op1_warc_bundles, op2_simhash_components, op3_decontamination, op4_media_container, op5_main_text,
    op6_language_id, op7_toxicity, op8_packing, op9_chat_format, op10_url_filter,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


OP1_SQL = """
WITH base AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS top,
         row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST) AS rank FROM base
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::INTEGER >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31) + 1 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN rank = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rank = 1 THEN NULL ELSE top END AS refers_to
FROM ranked
"""

OP9_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'),
    '(<)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|system\|>|\|user\|>|\|assistant\|>|/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\.\2\4', 'g') AS body FROM said
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(body) + 12 + 10 + 2) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_bundles": OP1_SQL, "op9_chat_format": OP9_SQL}

"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import align, exact_dedup, html_text, langid, mixing, periods, pieces, ppm, repetition, secret_scan, simhash, topk, urls
from tallyhouse.llm.common import table

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip_digests(table(spark, folder, "documents"), Path(TOKENIZER).read_bytes())


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(table(spark, folder, "documents")))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.digests(simhash.near_groups(table(spark, folder, "documents"), width=3, bits=2))


def op9_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"))


def op10_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judge(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(table(spark, folder, "documents"), Path(BYTE_TOKENIZER).read_bytes(), Path(TOKENIZER).read_bytes())


def op12_periods(spark: SparkSession, folder: str) -> DataFrame:
    return periods.digests(periods.find_runs(periods.with_planted_runs(table(spark, folder, "documents"))))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sentencepiece,
            op2_topk,
            op3_url_filter,
            op4_secret_scan,
            op5_language,
            op6_main_text,
            op7_mixing,
            op8_simhash,
            op9_ppm,
            op10_repetition,
            op11_alignment,
            op12_periods,
            op13_exact_dedup,
        )
    }


#: All inner products of whole numbers, the best ten of each query.
TOPK_SQL = """
    WITH usable AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scores)
    SELECT * FROM ranked WHERE rank <= 10"""

#: Groups of texts that are equal without blanks, and of each the longest text, then the smallest id.
EXACT_SQL = r"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
           row_number() OVER best = 1 AS kept, sha256(bare) AS text_sha256
    FROM texts WINDOW best AS (PARTITION BY bare ORDER BY length(text) DESC, doc_id)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express on whole tables; the tests hold the others against brute force."""
    return {"op2_topk": TOPK_SQL, "op13_exact_dedup": EXACT_SQL}

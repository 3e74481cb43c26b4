"""The registered queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, html, langid, pii, quality, simhash, suffix, urlfilter, warc
from .common import stage_path

#: The vocabulary that the registered queries read.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), VOCABULARY, with_ids=False)


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"), with_kept=False)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "archive")
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_bpe": op2_bpe,
    "op3_suffix": op3_suffix,
    "op4_pii": op4_pii,
    "op5_warc": op5_warc,
    "op6_langid": op6_langid,
    "op7_urlfilter": op7_urlfilter,
    "op8_html": op8_html,
    "op9_quality": op9_quality,
    "op10_decontam": op10_decontam,
}

#: Payload digests in base32: 20 bits at a time, taken from five hex digits of the SHA-1.
_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first,
         sha1(encode(coalesce(html, ''))) AS hexed
  FROM pages
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(hexed, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p
"""

ORACLES: dict[str, str] = {"op5_warc": _WARC}

"""The thin queries over the driver's tables, one for each text operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import audio, bagminhash, decontam, html_text, langid, pieces, pii, quality, token_store, url_rules
from .shared import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.tokenised(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.features(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_language_id": op2_language_id,
    "op8_decontamination": op8_decontamination,
    "op10_near_dedup": op10_near_dedup,
    "op3_html_text": op3_html_text,
    "op4_url_rules": op4_url_rules,
    "op5_pii": op5_pii,
    "op6_token_store": op6_token_store,
    "op7_sentencepiece": op7_sentencepiece,
    "op9_audio": op9_audio,
}

_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, coalesce({_WORDS}, []) ws FROM documents),
  i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') item, coalesce({_WORDS}, []) ws FROM benchmark),
  iw AS (SELECT item, ws, least(len(ws), 10) size, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) k FROM i WHERE len(ws) > 0),
  win AS (SELECT DISTINCT item, size, ws[k:k+size-1] q FROM iw),
  dw AS (SELECT r, size, k, ws[k:k+size-1] q FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) k FROM d, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size)),
  ex AS (SELECT r, k, dw.size, item FROM dw JOIN win ON win.size = dw.size AND win.q = dw.q),
  hit AS (SELECT r, count(DISTINCT p) n FROM (SELECT r, unnest(range(k, k + size)) p FROM ex) GROUP BY r),
  its AS (SELECT r, list_sort(list(DISTINCT item)) items FROM ex GROUP BY r),
  full_win AS (SELECT row_number() OVER () w, item, q FROM win WHERE size = 10),
  ww AS (SELECT w, unnest(q) word, unnest(range(10)) j FROM full_win),
  dword AS (SELECT r, unnest(ws) word, unnest(range(1, len(ws) + 1)) p FROM d),
  pair AS (SELECT r, w FROM (SELECT DISTINCT r, word FROM dword) JOIN ww USING (word) GROUP BY r, w HAVING count(*) >= 8),
  vote AS (SELECT r, w, p - j + s AS place, j FROM pair JOIN ww USING (w) JOIN dword USING (r, word), (SELECT unnest(range(-2, 3)) s)),
  near AS (SELECT DISTINCT r, item FROM (SELECT r, w FROM vote GROUP BY r, w, place HAVING count(DISTINCT j) >= 8) JOIN full_win USING (w)),
  nn AS (SELECT r, count(*) n FROM (SELECT r, item FROM near EXCEPT SELECT r, item FROM ex) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) n_words, coalesce(hit.n, 0) n_hit, coalesce(len(items), 0) n_items, sha256(coalesce(array_to_string(items, ','), '')) items_sha256,
  coalesce(hit.n, 0) > 0 contaminated, coalesce(nn.n, 0) n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r) LEFT JOIN nn USING (r)
"""
ORACLE_SQL: dict[str, str] = {"op8_decontamination": _OP8_SQL}

"""The registered queries of this package (QUERIES) and their DuckDB SQL (ORACLE_SQL)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, htmlcut, isomedia, linededup, pii, sharding, simhash, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op3_benchmark_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
runs AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows))),
found AS (SELECT runs.r, runs.i, runs.n, windows.item_id FROM runs JOIN windows USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@_query
def op5_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placement(_table(spark, sf_dir, "documents"), [1.0] * 16, [1.0] * 17)


@_query
def op6_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isomedia.round_trip(_table(spark, sf_dir, "documents"))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.removed_units(_table(spark, sf_dir, "documents"))


@_query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("target_uri")


ORACLE_SQL["op9_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM r
"""


@_query
def op10_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcut.extract(_table(spark, sf_dir, "pages"))


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))

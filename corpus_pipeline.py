"""The corpus pipeline: stages in order, each over what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of documents; other columns of docs go. In every stage null and empty texts, rows without doc_id and
repeated rows are rows like others, an empty table gives an empty one, and texts of any length are read as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pktloom.llm import bpe, decontaminate, nearcopies, pii, toxicity
from pktloom.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. Null and empty texts are scored like others; without usable labels every document stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id: similarity 0.8 or more on 5-word shingles.

    Texts without words are copies of one another. Rows without doc_id rank last, and the first of equal rows stays.
    """
    return nearcopies.one_of_each(docs).select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and wordless texts hold none, and null and wordless items have none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.cleaned(docs, benchmark).select(COLUMNS)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the names of their kinds; n_chars follows the text. A null text stays null, and has no n_chars."""
    return pii.masked(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text that they decode to. A null text has no tokens, as an empty one."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", pii_masking),
    ("byte_bpe", tokens),
]

#: The stages' models, hashes and merges are beyond SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

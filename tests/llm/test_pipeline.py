import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from pktloom.llm import bpe, toxicity

from .test_decontaminate import slow as slow_scan
from .test_nearcopies import slow_kept
from .test_pii import slow as slow_spans

KINDS = ["EMAIL", "IP", "CARD", "PHONE"]


def slow_mask(text):
    out, at = "", 0
    for s, _, e, k in sorted((s, k, e, k) for k, s, e in slow_spans(text)):
        if s >= at:
            out += text[at:s] + f"[{KINDS[k]}]"
        at = max(at, e)
    return out + text[at:]


def test_run_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rejected = {r["row"].doc_id for r in toxicity.score(docs, model).where("score >= 0.5").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in rejected}
    # the stage links texts by their 5-word shingles, with a similarity of 0.8 or more
    kept = {i: t for i, t in slow_kept(sorted(texts.items())) if not slow_scan(t, bench)[4]}
    ranks = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ranks
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(kept) and len(kept) < len(texts)
    for i, t in kept.items():
        assert got[i].ids == other.encode_ordinary(slow_mask(t)) and got[i].n_tokens == len(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256(slow_mask(t).encode()).hexdigest()


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = [(None, "no id here at all", "en", "s", 3), (None, "no id here at all", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (7, "a copy of a text that stays", "en", "s", 1), (7, "a copy of a text that stays", "en", "s", 1), (9, "mail me at a@b.co", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns == corpus_pipeline.COLUMNS
        docs = after
    left = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert left == sorted([(None, "no id here at all"), (1, None), (7, "a copy of a text that stays"), (9, "mail me at [EMAIL]")], key=str)

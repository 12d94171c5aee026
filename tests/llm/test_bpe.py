import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pktloom.llm import bpe

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def both(name):
    mine = bpe.load(public_tokenizers.path(name), public_tokenizers.PATTERN)
    return mine, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})


@pytest.mark.parametrize("name", FILES)
def test_every_token_encodes_to_itself(name):
    mine, _ = both(name)
    assert all(mine.tree(b) == [i] for b, i in mine.ranks.items())


@pytest.mark.parametrize("name", FILES)
def test_long_matches_and_mixed_texts(name):
    mine, other = both(name)
    rnd = random.Random(3)
    letters = "abcdeéßñthsiong"
    texts = ["", " ", "\n\n  x", "a" * 5000, "ab" * 3000, "".join(rnd.choices(letters, k=20000)), "0123456789" * 500, "!" * 999, " \t\n" * 400 + "x", "<|endoftext|>", "日本語テキスト" * 50, "🙂🙃" * 30]
    texts += [" ".join("".join(rnd.choices(letters, k=rnd.randint(1, 40))) for _ in range(200)) for _ in range(30)]
    for t in texts:
        ids = mine.encode(t)
        assert ids == other.encode_ordinary(t)
        assert mine.decode(ids) == t.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    mine, other = both(FILES[0])
    assert mine.encode(text) == other.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abABést hi", max_size=60), st.integers(0, 60))
def test_join_is_the_encoding_of_the_whole(text, at):
    mine, _ = both(FILES[0])
    data = text.encode()
    left, right = data[:at], data[at:]
    assert mine.joined(mine.merged(left), mine.merged(right)) == mine.merged(data)


def test_long_text_in_parts(monkeypatch):
    mine, other = both(FILES[0])
    monkeypatch.setattr(bpe, "MATCHES", 10)
    text = "one two  three\n\nfour " * 20
    assert mine.encode(text) == other.encode_ordinary(text)


def test_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "héllo wörld"), (3, "x " * 50000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n_tokens", "'z' AS ids")
    got = bpe.round_trip(df, public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN).collect()
    _, other = both(FILES[0])
    want = []
    for i, t in rows:
        ids = other.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] or -1, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe.round_trip(df.where("false"), public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN).count() == 0


def test_query_against_library(spark):
    from pktloom.llm.queries import QUERIES

    _, other = both(FILES[0])
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op7_byte_bpe"](spark, "/root/testdata/sf0.001").collect():
        ids = other.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(ids)

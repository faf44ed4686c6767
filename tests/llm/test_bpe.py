"""BPE against tiktoken, exact round trips, offsets, defined cases."""

import hashlib
import json

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import bpe, queries

RANKS = public_tokenizers.path(bpe.RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(*bpe.vocabulary(RANKS), public_tokenizers.PATTERN)


def test_vocabulary_equals_the_library_file():
    vocab, merges = bpe.vocabulary(RANKS)
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
        model = json.load(f)["model"]
    assert vocab == {k: v for k, v in model["vocab"].items() if k in vocab}
    assert [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]] == merges


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sd1é漢🙂")), max_size=60))
def test_ids_bytes_and_offsets(coder, reference, text):
    ids, spans = coder.encode([text])
    assert ids[0].tolist() == reference.encode_ordinary(text)
    assert coder.decode(ids[0]) == text.encode()
    assert len(spans[0]) == len(ids[0])
    for i, (start, end) in zip(ids[0], spans[0].tolist()):
        assert coder.bytes_of[i] in text[start:end].encode() and 0 <= start < end <= len(text)


def test_query_on_the_table(spark, sf, reference):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_bpe(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_split_characters_specials_nulls_and_long_texts(spark, reference):
    texts = [None, "", "🙂", "<|endoftext|>", "漢" * 50_000, "a" * 200_000, " ", "same", "same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("own", F.lit("x"))
    rows = bpe.decode(bpe.encode(df), text_col="back").orderBy("doc_id").collect()
    for text, r in zip(texts, rows):
        assert r["ids"] == reference.encode_ordinary(text or "")
        assert bytes(r["decoded"]) == (text or "").encode() and r["back"] == (text or "") and r["own"] == "x"
        assert len(r["ids_starts"]) == len(r["ids_ends"]) == len(r["ids"])
    both = bpe.encode(df, offsets=False, decoded_col="own").orderBy("doc_id").collect()
    assert [bytes(r["own"]) for r in both] == [bytes(r["decoded"]) for r in rows]
    half = spark.createDataFrame([(reference.encode_ordinary("🙂")[:1],), (None,), ([],)], "ids array<int>")
    got = bpe.decode(half, text_col="back").collect()
    assert got[0]["back"] == "�" and bytes(got[0]["decoded"]) == "🙂".encode()[:len(got[0]["decoded"])]
    assert [bytes(r["decoded"]) for r in got[1:]] == [b"", b""]


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(b"a\xff",)], "b binary").select(F.col("b").cast("string").alias("text"))
    assert bytes(bpe.decode(bpe.encode(df).select("ids")).collect()[0]["decoded"]) == "a�".encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df)).collect() == []

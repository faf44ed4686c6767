"""Packing: every id once, in place, and the ids of the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import packing, queries


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        return packing.WordCoder(file.read())


def check(coder, library, texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [library.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]


AWKWARD = ["", " ", "don't I'LL we've", "<|endoftext|>a <|startoftext|> <|endof text|>", "é ́x e ́",
           "İstanbul ΣΣ Σ", "a b c\x85d\x1ce", "世界 12345 ก́",
           "\U0001f600‍\U0001f600 x\x00y �", "한 ᄒ ᅡ", "| |a|b||", "ﬁ Å KK"]


def test_awkward_texts(coder, library):
    check(coder, library, AWKWARD)
    check(coder, library, [" ".join(AWKWARD), "\n".join(AWKWARD)])


chars = st.sampled_from(list("abAB'sltre1 .|<>\n\t́İΣé世 \U0001f600\x1c"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(chars, max_size=40), st.text(st.characters(codec="utf-8"), max_size=20)), max_size=4))
def test_ids_of_the_library(coder, library, texts):
    check(coder, library, texts)


def test_words_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as file:
        small = packing.WordCoder(file.read())
    for _ in range(2):
        check(small, library, ["one two three four five six " + "x" * 100, "six seven"])
        assert len(small.ids_of) <= 3


def rows():
    return ([(i, f"text number {i} " * (i % 7)) for i in range(200)] + [(500, "a b c " * 5000), (None, "null id"),
            (501, None), (502, ""), (3, "text number 3 " * 3), (3, "text number 3 " * 3)])


def verify(pieces, docs, library, window):
    """Pieces cover each document's ids once, and windows without gaps."""
    want = {}
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        want.setdefault(doc, []).append(ids)
    places, total = {}, sum(len(x) for v in want.values() for x in v)
    for p in pieces:
        assert 0 < p["length"] and p["offset"] + p["length"] <= window
        at = p["sequence_id"] * window + p["offset"]
        places[at] = p
        ids = want[p["doc_id"]][0]  # repeated rows are equal here
        part = ids[p["start"]:p["start"] + p["length"]]
        assert len(part) == p["length"] and p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    at, seen = 0, []
    while at < total:
        p = places[at]
        if p["start"]:
            assert seen[-1][0] == p["doc_id"] and seen[-1][1] == p["start"]
            seen[-1] = (p["doc_id"], p["start"] + p["length"])
        else:
            seen.append((p["doc_id"], p["length"]))
        at += p["length"]
    assert len(places) == len(pieces)
    key = lambda x: (x[0] is None, x)
    assert sorted(seen, key=key) == sorted(((d, len(x)) for d, v in want.items() for x in v), key=key)


def test_query(spark, library, tmp_path):
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(5)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    verify(queries.op12_packing(spark, str(tmp_path)).collect(), rows(), library, packing.WINDOW)


def test_sequences(spark, library):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    pieces = packing.pack(docs, window=64)
    found = sorted(packing.sequences(pieces).collect(), key=lambda r: r["sequence_id"])
    assert [r["n_tokens"] for r in found[:-1]] == [64] * (len(found) - 1)
    assert [r["sequence_id"] for r in found] == list(range(len(found)))
    ids = [i for r in found for i in r["ids"]]
    order = [(d["doc_id"], d["start"]) for r in found for d in r["documents"]]
    texts, flat = dict(rows()), []
    for doc, start in order:
        if not start:
            flat += library.encode(texts[doc] or "", add_special_tokens=False).ids + [packing.END]
    assert ids == flat
    cut = [d for r in found for d in r["documents"] if d["cut"]]
    assert cut and all(d["offset"] + d["length"] == 64 or d["offset"] == 0 for d in cut)


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(7, "a b", 1, 2)], "doc_id long, text string, n int, ids int")
    row = packing.pack(docs).first()
    assert (row["doc_id"], row["start"], row["sequence_id"], row["cut"]) == (7, 0, 0, False)
    assert packing.pack(docs.limit(0)).collect() == []
    assert packing.sequences(packing.pack(docs.limit(0))).collect() == []

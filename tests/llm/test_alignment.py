"""Alignment against whole texts, cumulated bytes and plain counts."""

import hashlib
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedloom.llm import alignment, queries
from feedloom.llm.bpe import byte_characters

CASES = ["", "a", "hello  world", " lead and  trail ", "line\nbreak\r\n\ttab", "世界 ก́ 한글",
         "\U0001f600\U0001f9ff x\U0001f468‍\U0001f469", "<0x0A> <s> </s> <unk> <|endoftext|>",
         "a▁b", "nbsp\xa0x \x1c y\x85z", "né\u0301e ﬁ Å İ", "\x00\x01", "12345 67,890.12", "…—“q”",
         "x" * 200, "don't WE'LL", "\ufffd \u200b\ufeff", "ᄒ ᅡ ꙮ 𐍈"]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTES_VOCABULARY))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES_VOCABULARY))
        self.byte = {c: b for b, c in enumerate(byte_characters())}

    def groups(self, text):
        """[(A ids, B ids)] of a whole text."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        bytes_a = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i in b for p in [self.b.id_to_piece(i)]]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return []
        ends_a = {e: n + 1 for n, e in enumerate(accumulate(map(len, bytes_a)))}
        ends_b = {e: n + 1 for n, e in enumerate(accumulate(map(len, bytes_b)))}
        out, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            out.append((a[i:ends_a[e]], b[j:ends_b[e]]))
            i, j = ends_a[e], ends_b[e]
        return out

    def table(self, rows):
        """The rows of the query."""
        links = [Counter((x, y) for xs, ys in self.groups(t) for x in xs for y in ys) for _, t in rows]
        held = Counter(p for c in links for p in c)
        most = {}
        for (a, _), n in held.items():
            most[a] = max(most.get(a, 0), n)
        out = []
        for (doc, text), c in zip(rows, links):
            groups = self.groups(text)
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            out.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
                        sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]),
                        sum(n * held[p] for p, n in c.items()),
                        hashlib.sha256(said.encode()).hexdigest() if groups else ""))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    with open(public_tokenizers.path(alignment.BYTES_VOCABULARY), encoding="utf-8") as file:
        bytes_json = file.read()
    with open(public_tokenizers.path(alignment.PIECES_VOCABULARY), "rb") as file:
        return alignment.Aligner(bytes_json, file.read())


def check(aligner, plain, texts):
    for text, (counts, groups, links) in zip(texts, aligner.documents(texts)):
        want = plain.groups(text)
        assert groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want), repr(text)
        linked = Counter((x << 32) | y for xs, ys in want for x in xs for y in ys)
        assert dict(links.tolist()) == linked
        assert counts == [sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), sum(linked.values())]


def test_awkward_texts(aligner, plain):
    assert not aligner.whole
    check(aligner, plain, CASES)
    check(aligner, plain, [" ".join(CASES), "\n".join(c for c in CASES if "\u2581" not in c)])
    assert plain.groups(CASES[5]) and not plain.groups("a\u2581b")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(st.sampled_from(list("ab. \n\t'é世\U0001f600\u0301\xa0\x1c1")), max_size=30),
                          st.text(st.characters(codec="utf-8"), max_size=20)), max_size=4))
def test_groups_of_whole_texts(aligner, plain, texts):
    check(aligner, plain, texts)


def test_split_characters_are_refined(aligner):
    # Both tokenizers take the emoji apart; the bytes of its parts end together in places.
    (counts, groups, _), = aligner.documents(["\U0001f9ff"])
    assert counts[2] > 1 and counts[0] > 1 and counts[1] > 1 and groups.count(";") == counts[2] - 1


@pytest.fixture
def rows():
    return [*enumerate(CASES), (100, None), (None, "null id here"), (101, "the cat sat " * 300),
            (102, "the dog and the cat"), (102, "the dog and the cat"), *[(200 + i, f"the cat number {i}") for i in range(60)]]


def test_query(spark, plain, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain.table(rows)


@pytest.mark.parametrize("most", [0, 3, 40])
def test_held_pairs_change_nothing(spark, plain, rows, most):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.alignment(df, most=most).select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain.table(rows)


def test_parts_are_forgotten(aligner, plain, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT_PARTS", 2)
    check(aligner, plain, ["one two three " + "y" * 90, "four five"])
    check(aligner, plain, ["one two three " + "y" * 90, "four five"])


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, TIMES int, _align_text string")
    row = alignment.align(docs, groups_col="groups").first()
    assert row["_align_text"] == "x" and row["groups"].count("|") == row["n_groups"] == 2 and row["times"] == [1, 1]
    assert alignment.alignment(docs.limit(0)).collect() == []

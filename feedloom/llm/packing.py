"""Packing: concatenate all documents' tokens and cut at fixed places.

The documents follow each other in the order in which they are stored once their
tokens are known: by partition, and within it by place.  A task adds up its own
tokens as it encodes, which gives each document its offset in its partition; the
partitions' totals, one row each, are added up next.  The sum of both is the
document's place among all tokens, and from it follow the windows of ``WINDOW``
tokens that it lies in.  A piece is what one window holds of one document; where
a document crosses a border, its pieces on both sides record the cut.  All windows
are full but the last.

Tokens are those of the tokenizers library for the whole text, then ``END``.  The
vocabulary's texts part at white space, so each distinct word is encoded once per
batch, frequent ones once per Python worker.  Words of Latin letters, digits and
marks are put into lower case and cut into runs of letters, single digits and runs
of marks here, as the library's rules for them say, and share what is known of their
runs; the library does the same for all other words.

Nothing is grouped and no text is shuffled, so neither a very long document nor one
repeated very often lands in one task.  Stored tokens make the order fixed: a lost
executor's pieces are computed again from the same places.

Defined cases: a null or empty text has one token, ``END``; repeated rows are
documents of their own; a null id is an id like any other; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import held, map_batches, slices, written

VOCABULARY = "word_bpe_49k.json"
WINDOW, END = 2048, 1
#: Words and runs that a Python worker keeps with their ids, the longest of them, and
#: the rows and bytes of text that are encoded together.
KEPT_WORDS, KEPT_RUNS, KEPT_BYTES = 700_000, 250_000, 40
ROWS_AT_ONCE, TEXT_AT_ONCE = 2048, 4 << 20


#: The characters of words that are cut here: Latin ones, whose classes are the same in
#: every version of Unicode.  U+0130 becomes two characters in lower case.
LATIN = [chr(i) for i in range(0x250) if i != 0x130]


def _class(kind: str) -> str:
    return re.escape("".join(c for c in LATIN if unicodedata.category(c)[0] == kind))


#: What the vocabulary's own pattern splits from a word, in this order.
ENDINGS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]
SPACE = "\x09-\x0d\x20\x85\xa0"
RUNS = re.compile(f"{'|'.join(ENDINGS)}|[{_class('L')}]+|[{_class('N')}]|[^{SPACE}{_class('L')}{_class('N')}]+")


class WordCoder:
    """The encoder of one Python worker: words to little-endian 32-bit ids."""

    def __init__(self, tokenizer_json: str) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        known = json.loads(tokenizer_json)
        special = "|".join(re.escape(t["content"]) for t in known["added_tokens"])
        latin = f"[{re.escape(''.join(LATIN))}]+"
        self.latin = re.compile(f"(?!.*(?:{special})){latin}" if special else latin, re.DOTALL)
        # The same merges, for runs of characters that are cut already.
        self.runs = Tokenizer.from_str(json.dumps(known | {
            "added_tokens": [], "normalizer": None, "pre_tokenizer": {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}))
        self.ids_of: dict[bytes, bytes] = {}
        self.ids_of_run: dict[str, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        latin = [self.latin.fullmatch(t) is not None for t in texts]
        self._learn_by_runs([(w, t) for w, t, own in zip(words, texts, latin) if own])
        self._learn_whole([(w, t) for w, t, own in zip(words, texts, latin) if not own])

    def _learn_by_runs(self, words: list[tuple[bytes, str]]) -> None:
        cut = [RUNS.findall(t.lower()) for _, t in words]
        new = list(set(chain.from_iterable(cut)).difference(self.ids_of_run))
        if new:
            found = self.runs.encode(new, is_pretokenized=True, add_special_tokens=False)
            cuts = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(new) + 1))).tolist()
            ids = np.array(found.ids, "<u4").tobytes()
            self.ids_of_run.update({r: ids[a:b] for r, a, b in zip(new, cuts, cuts[1:])})
        ids_of = self.ids_of_run
        self.ids_of.update({w: ids_of[rs[0]] if len(rs) == 1 else b"".join([ids_of[r] for r in rs])
                            for (w, _), rs in zip(words, cut)})
        _forget(self.ids_of_run, new, KEPT_RUNS)

    def _learn_whole(self, words: list[tuple[bytes, str]]) -> None:
        """Encode words as one text, and cut the tokens where the words end."""
        if not words:
            return
        found = self.tokenizer.encode(" ".join(t for _, t in words), add_special_tokens=False)
        begins = np.cumsum([0, *[len(t) + 1 for _, t in words]])
        starts = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
        cuts = (4 * np.searchsorted(starts, begins)).tolist()
        ids = np.array(found.ids, "<u4").tobytes()
        self.ids_of.update((w, ids[a:b]) for (w, _), a, b in zip(words, cuts, cuts[1:]))

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text, ``END`` included."""
        # bytes.split parts at the white space of ASCII only; the rest the library knows.
        split = [(t or b"").split() for t in texts]
        new = list(set().union(*split).difference(self.ids_of))
        self._learn(new)
        end = END.to_bytes(4, "little")
        ids = [b"".join([*map(self.ids_of.__getitem__, words), end]) for words in split]
        _forget(self.ids_of, new, KEPT_WORDS)
        return ids


def _forget(known: dict, new: list, most: int) -> None:
    """Long words go, and as many of the others as there is no room for."""
    over = len(known) - most
    for w in new:
        if over > 0 or len(w) > KEPT_BYTES:
            del known[w]
            over -= 1


def _coder(shared: Broadcast) -> WordCoder:
    return held((__name__, shared.value[0]), lambda: WordCoder(shared.value[1]))


def encoded(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, n, at, part), stored: the tokens of each document as 32-bit
    integers, their number, and the tokens before it in its partition ``part``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast((path, file.read()))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, before = _coder(shared), 0
        for batch in batches:
            for part in slices(batch, "t", ROWS_AT_ONCE, TEXT_AT_ONCE):
                ids = coder.encode(part.column("t").to_pylist())
                n = np.array([len(x) // 4 for x in ids], np.int64)
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(n), pa.array(at)],
                    ["doc_id", "ids", "n", "at"])

    schema = T.StructType([source.schema["doc_id"], T.StructField("ids", T.BinaryType(), False),
                           *[T.StructField(c, T.LongType(), False) for c in ("n", "at")]])
    return written(map_batches(source, run, schema).withColumn("part", F.spark_partition_id()), "tokens")


def offsets(stored: DataFrame) -> DataFrame:
    """(part, before): the tokens of all earlier partitions; a row for each partition."""
    totals = stored.groupBy("part").agg(F.sum("n").alias("_n"))
    return totals.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("before"))


def _piece(w: Column, place: Column, window: int) -> Column:
    """What window ``w`` holds of the document at ``place``."""
    start = F.greatest(w * window - place, F.lit(0).cast("bigint"))
    length = F.least((w + 1) * window - place, F.col("n")) - start
    ids = F.substring(F.col("ids"), (start * 4 + 1).cast("int"), (length * 4).cast("int"))
    return F.struct(start.alias("start"), length.alias("length"), w.alias("sequence_id"),
                    (place + start - w * window).alias("offset"), ids.alias("ids"))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocabulary: str | None = None) -> DataFrame:
    """(doc_id, doc_tokens, start, length, sequence_id, offset, ids, cut): a row for
    each piece; ``cut`` tells whether a border parts it from more of its document."""
    stored = encoded(docs, id_col=id_col, text_col=text_col, vocabulary=vocabulary)
    place = F.col("before") + F.col("at")
    placed = stored.join(F.broadcast(offsets(stored)), "part").select("doc_id", "n", "ids", place.alias("place"))
    windows = F.sequence(F.floor(F.col("place") / window), F.floor((F.col("place") + F.col("n") - 1) / window))
    pieces = F.transform(windows, lambda w: _piece(w, F.col("place"), window))
    return placed.select("doc_id", F.col("n").alias("doc_tokens"), F.inline(pieces)).withColumn(
        "cut", F.col("length") < F.col("doc_tokens"))


def numbers(ids: Column) -> Column:
    """32-bit ids as an array of numbers."""
    digits = F.hex(ids)
    def at(i: Column) -> Column:
        parts = [F.substring(digits, i * 8 + k, F.lit(2)) for k in (7, 5, 3, 1)]
        return F.conv(F.concat(*parts), 16, 10).cast("bigint")
    return F.when(F.length(ids) > 0, F.transform(F.sequence(F.lit(0), (F.length(ids) / 4 - 1).cast("int")), at)
                  ).otherwise(F.array().cast("array<bigint>"))


def sequences(pieces: DataFrame, doc_col: str = "doc_id") -> DataFrame:
    """(sequence_id, n_tokens, ids, documents): each window whole, with the pieces it
    is made of; a window holds at most as many pieces as tokens."""
    entry = F.struct("offset", F.col(doc_col).alias("doc_id"), "start", "length", "cut", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(entry)).alias("_p"),
                                                F.sum("length").alias("n_tokens"))
    documents = F.transform("_p", lambda p: p.dropFields("ids"))
    joined = F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return grouped.select("sequence_id", "n_tokens", numbers(joined).alias("ids"), documents.alias("documents"))

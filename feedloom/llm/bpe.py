"""Byte-level BPE over Arrow batches: ids, offsets and the way back to bytes.

The vocabulary is a rank file (base64 token, rank).  Ranks become the vocabulary
and merges of the tokenizers library: every byte is written as one printable
character, and the merge that makes a token is the last one of merging its own
bytes by rank.  Texts are cut by the split pattern; each distinct piece is
encoded once per batch, frequent ones once per Python worker.

Decoding turns ids back into characters, characters into bytes, and joins the
bytes before they become text, so characters that tokens split come back whole;
``offsets`` give each token the code points that it touches.

Defined cases: a null text is empty; an empty text has no tokens; special tokens
are ordinary text; bytes that are not UTF-8 are replaced by U+FFFD before
encoding; in decoding, a null list is empty and ids that form no valid UTF-8
keep their bytes and show U+FFFD in ``text``; an unknown id is an error; empty
tables give no rows; other columns stay as they are, but for those named like
the new ones, which are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import decoded_texts, free_name, held, map_batches, slices, with_columns

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces that a Python worker keeps with their ids, and the longest such piece.
KEPT_PIECES = 250_000
KEPT_CHARS = 32
TOKENS_AT_ONCE, TEXT_AT_ONCE = 262_144, 2 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable and no space, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes a token: merge by rank until two are left."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        _, i = min((ranks.get(parts[i] + parts[i + 1], len(ranks) + i), i) for i in range(len(parts) - 1))
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def vocabulary(path: str) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """(token as characters -> id, merges in order) of a rank file."""
    ranks, char = read_ranks(path), byte_characters()

    def spell(token: bytes) -> str:
        return "".join(char[b] for b in token)

    merges = [tuple(map(spell, _parts(token, ranks)))
              for token in sorted(ranks, key=ranks.__getitem__) if len(token) > 1]
    return {spell(token): rank for token, rank in ranks.items()}, merges


class Coder:
    """The encoder and decoder of one Python worker."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], pattern: str,
                 offsets: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = regex.compile(pattern)
        self.offsets = offsets
        #: Of each known piece its ids and, for offsets, its spans, as bytes of 32-bit integers.
        self.ids_of: dict[str, bytes] = {}
        self.spans_of: dict[str, bytes] = {}
        byte = {c: b for b, c in enumerate(byte_characters())}
        table = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            table[i] = bytes(byte[c] for c in token)
        self.bytes_of = table
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.length = np.fromiter(map(len, table), np.int64, len(table))
        self.start = np.cumsum(self.length) - self.length

    def _learn(self, pieces: list[str]) -> None:
        if not pieces:
            return
        encoding = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        cuts = np.searchsorted(np.array(encoding.word_ids), np.arange(len(pieces) + 1)).tolist()
        ids = np.array(encoding.ids, np.int32).tobytes()
        self.ids_of.update((p, ids[4 * a:4 * b]) for p, a, b in zip(pieces, cuts, cuts[1:]))
        if self.offsets:
            spans = np.array(encoding.offsets, np.int32).tobytes()
            self.spans_of.update((p, spans[8 * a:8 * b]) for p, a, b in zip(pieces, cuts, cuts[1:]))

    def _forget(self, pieces: list[str]) -> None:
        """Long pieces go, and as many of the others as there is no room for."""
        over = len(self.ids_of) - KEPT_PIECES
        for p in pieces:
            if over > 0 or len(p) > KEPT_CHARS:
                del self.ids_of[p]
                self.spans_of.pop(p, None)
                over -= 1

    def _spans(self, pieces: list[str]) -> np.ndarray:
        """The code points that each token of a text touches."""
        lengths = np.fromiter(map(len, pieces), np.int32, len(pieces))
        counts = np.fromiter((len(self.ids_of[p]) // 4 for p in pieces), np.int64, len(pieces))
        spans = np.frombuffer(b"".join(map(self.spans_of.__getitem__, pieces)), np.int32).reshape(-1, 2)
        return spans + np.repeat(np.cumsum(lengths) - lengths, counts)[:, None]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text, and its tokens' (start, end) if offsets are asked for."""
        pieces = [self.split.findall(t) for t in texts]
        new = list(set(filterfalse(self.ids_of.__contains__, chain.from_iterable(pieces))))
        self._learn(new)
        ids = [np.frombuffer(b"".join(map(self.ids_of.__getitem__, ps)), np.int32) for ps in pieces]
        spans = [self._spans(ps) for ps in pieces] if self.offsets else []
        self._forget(new)
        return ids, spans

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of tokens."""
        if len(ids) and ids.min() < 0:
            raise IndexError("negative token id")
        out = []
        for at in range(0, len(ids), TOKENS_AT_ONCE):
            some = ids[at:at + TOKENS_AT_ONCE]
            size = self.length[some]
            ends = np.cumsum(size)
            place = np.repeat(self.start[some] - (ends - size), size) + np.arange(ends[-1])
            out.append(self.flat[place].tobytes())
        return b"".join(out)


def _coder(shared: Broadcast, offsets: bool) -> Coder:
    """The worker's coder for a vocabulary; a worker serves many tasks."""
    name, *parts = shared.value
    return held((__name__, name, offsets), lambda: Coder(*parts, offsets))


def shared_vocabulary(docs: DataFrame, ranks_path: str | None, pattern: str | None) -> Broadcast:
    """The vocabulary, whose size is fixed, for every executor, under its digest."""
    vocab, merges = vocabulary(ranks_path or public_tokenizers.path(RANKS))
    pattern = pattern or public_tokenizers.PATTERN
    name = hashlib.sha256(json.dumps([vocab, merges, pattern]).encode()).hexdigest()
    return docs.sparkSession.sparkContext.broadcast((name, vocab, merges, pattern))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate([*rows, np.empty(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _decoded(coder: Coder, lists: pa.ListArray) -> list[bytes]:
    """The bytes of each list of ids: all tokens at once, then cut by row."""
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    data = coder.decode(ids)
    cuts = np.concatenate([[0], np.cumsum(coder.length[ids])])[np.concatenate([[0], ends])].tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def encode(docs: DataFrame, *, text_col: str = "text", ids_col: str = "ids", offsets: bool = True,
           decoded_col: str | None = None, ranks_path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, and with ``ids_starts`` and ``ids_ends`` if asked for:
    the code points from start to end (exclusive) that each token touches.

    ``decoded_col`` adds what :func:`decode` makes of the ids, in the same worker.
    """
    shared = shared_vocabulary(docs, ranks_path, pattern)
    names = [ids_col, *([f"{ids_col}_starts", f"{ids_col}_ends"] if offsets else [])]
    docs = docs.drop(*names, *([decoded_col] if decoded_col else []))
    raw = free_name("_bpe_text", docs.columns)
    source = docs.withColumn(raw, F.col(text_col).cast("string").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, offsets)
        for batch in batches:
            for part in slices(batch, raw, size=TEXT_AT_ONCE):
                ids, spans = coder.encode(decoded_texts(part.column(raw)))
                made = [_lists(ids), *([_lists([s[:, k] for s in spans]) for k in (0, 1)] if offsets else [])]
                new = dict(zip(names, made))
                if decoded_col:
                    new[decoded_col] = pa.array(_decoded(coder, made[0]), pa.binary())
                yield with_columns(part, [raw], new)

    kind = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, kind, False) for n in names],
                           *([T.StructField(decoded_col, T.BinaryType(), False)] if decoded_col else [])])
    return map_batches(source, run, schema)


def decode(tokens: DataFrame, *, ids_col: str = "ids", bytes_col: str = "decoded",
           text_col: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``tokens`` with the bytes that the ids stand for, and as text if asked for."""
    shared = shared_vocabulary(tokens, ranks_path, None)
    tokens = tokens.drop(bytes_col, *([text_col] if text_col else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, False)
        for batch in batches:
            for part in slices(batch):
                rows = _decoded(coder, part.column(ids_col))
                made = {bytes_col: pa.array(rows, pa.binary())}
                if text_col:
                    made[text_col] = pa.array([r.decode("utf-8", "replace") for r in rows], pa.string())
                yield with_columns(part, [], made)

    fields = [T.StructField(bytes_col, T.BinaryType(), False)]
    fields += [T.StructField(text_col, T.StringType(), False)] if text_col else []
    return map_batches(tokens, run, T.StructType([*tokens.schema.fields, *fields]))

"""Cross-tokenizer alignment: groups of tokens that cover the same bytes.

Tokenizer A is byte-level BPE (the tokenizers library), tokenizer B is BPE with byte
fallback (sentencepiece).  Both read a space and the text.  A's character offsets and
the spans of B's pieces are coarse cuts: where a token of each ends with a whole
character.  Between coarse cuts, where tokens split a character or stand for single
bytes, the decoded bytes of the tokens refine them.  (The installed sentencepiece has
no immutable proto any more; its offset mapping holds the same spans.)  The bytes up to which tokens of
both end cut a text into groups; all tokens of A in a group are linked with all of B.

No token of either goes over a space that stands alone between two other characters
(B's vocabulary is checked for it), so a text parts there, and each distinct part is
aligned once per batch, frequent ones once per Python worker.

The number of documents that hold a pair of linked ids is counted over the whole
table.  Workers hold the counts of the most frequent pairs, ``HELD_PAIRS`` at most in
whole frequency classes; rows of rarer pairs are joined with the stored counts.  What
is held changes the work, not the result, and no frequent pair is ever a join key.

Defined cases: a null or empty text, and one of which joined bytes of A or B differ
from a space and the text, has no tokens: zeros and an empty string of groups; special
tokens' strings are plain text; repeated rows count as documents each; a null id is an
id like any other; an empty table gives no rows; other columns stay, but for those
named like the new ones; bytes that are not UTF-8 are replaced by U+FFFD first.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.bpe import byte_characters
from feedloom.llm.common import decoded_texts, free_name, held, map_batches, slices, with_columns, written

BYTES_VOCABULARY, PIECES_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
HELD_PAIRS = 200_000
#: Parts of texts that a Python worker keeps, the longest such part, and the bytes of
#: text that are aligned together.
KEPT_PARTS, KEPT_CHARS, TEXT_AT_ONCE = 350_000, 40, 2 << 20
#: A space that stands alone, for every notion of white space that the libraries have.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def ends_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes, dtype=np.int64)


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Up to which byte each token reaches.

    A span (start, end) ends with a whole character where no later token has begun
    before its end; there it counts as it is.  The other tokens hold a part of a
    character, and reach as far past the last such place as their decoded bytes say.
    """
    coarse = (starts < ends) & (ends <= np.append(starts[1:], ends[-1:]))
    index = np.maximum.accumulate(np.where(coarse, np.arange(len(ends)), -1))
    decoded = ends_of(sizes)
    place = np.where(index < 0, 0, ends[index])
    return place + decoded - np.where(index < 0, 0, decoded[index])


class Aligner:
    """Both tokenizers of one Python worker.

    ``known`` has of each part its four counts as bytes of 64-bit integers, its groups,
    each followed by a semicolon, and its linked pairs as bytes of 64-bit integers; or
    nothing where the tokens' bytes differ from it.
    """

    def __init__(self, bytes_json: str, pieces_model: bytes) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(bytes_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces_model)
        byte = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        #: Ids as text, A's in a group and at the end of their side of it, then B's.
        numbers_a, numbers_b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.said = [f"{i}{mark}" for ids, marks in ((numbers_a, ",|"), (numbers_b, ",;")) for mark in marks for i in ids]
        #: Whether a piece goes on after a space: then texts are taken whole.
        self.whole = any("▁" in p.lstrip("▁") for p in pieces)
        self.known: dict[str, tuple | None] = {}

    def parts(self, text: str) -> list[str]:
        """The parts of a text, each of which a space precedes."""
        if not text or self.whole:
            return [text] if text else []
        parts = text.split(" ")
        if all(p and p.strip() == p for p in dict.fromkeys(parts)):
            return parts
        first, *others = LONE_SPACE.split(f" {text}")
        return [first[1:], *others]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and reached bytes of A's and B's tokens for a space and ``text``; none
        where the tokens' bytes are others."""
        spaced = f" {text}"
        encoding = self.a.encode(spaced, add_special_tokens=False)
        mapping = self.b.encode(text, return_type="offset_mapping")
        data = spaced.encode()
        if b"".join(map(self.bytes_a.__getitem__, encoding.ids)) != data or b"".join(
                map(self.bytes_b.__getitem__, mapping["ids"])) != data:
            return None
        code = np.frombuffer(spaced.encode("utf-32-le"), np.uint32)
        widths = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        place = np.concatenate([[0], ends_of(widths)])

        def spans(offsets: list[tuple[int, int]]) -> np.ndarray:
            return np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)

        a, b = np.array(encoding.ids, np.int64), np.array(mapping["ids"], np.int64)
        in_a, in_b = spans(encoding.offsets), spans(mapping["offsets"]) + 1
        in_b[:1, 0] = 0  # B's spans leave out the space that it puts before the text
        return (a, refined(*place[in_a].T, self.size_a[a]), b, refined(*place[in_b].T, self.size_b[b]))

    def learn(self, parts: list[str]) -> None:
        """Align parts as one text; where that fails, halve it down to the parts that do.

        Parts that begin or end with white space, as the first and last of a text can,
        are taken one by one: joined, they would not part again.
        """
        alone = [p for p in parts if self.whole or p.strip() != p]
        joined = [p for p in parts if not self.whole and p.strip() == p]
        waiting = [[p] for p in alone] + ([joined] if joined else [])
        while waiting:
            some = waiting.pop()
            found = self.tokens(" ".join(some))
            if found is not None:
                self._keep(some, *found)
            elif len(some) == 1:
                self.known[some[0]] = None
            else:
                waiting += [some[:len(some) // 2], some[len(some) // 2:]]

    def _keep(self, parts: list[str], a: np.ndarray, reach_a: np.ndarray, b: np.ndarray, reach_b: np.ndarray) -> None:
        """Cut the tokens of joined parts into groups, and the groups by part."""
        # Every token has bytes, so both ascend.
        ends = reach_a[reach_b[np.minimum(np.searchsorted(reach_b, reach_a), len(reach_b) - 1)] == reach_a]
        at_a, at_b = np.searchsorted(reach_a, ends, "right"), np.searchsorted(reach_b, ends, "right")
        n_a, n_b = np.diff(at_a, prepend=0), np.diff(at_b, prepend=0)
        from_a, from_b, links = at_a - n_a, at_b - n_b, n_a * n_b
        group = np.repeat(np.arange(len(ends)), links)
        nth = np.arange(len(group)) - np.repeat(ends_of(links) - links, links)
        pairs = (a[from_a[group] + nth // n_b[group]] << 32 | b[from_b[group] + nth % n_b[group]]).tobytes()
        # The ids of each group in order, A's before B's, each with the mark that follows it.
        said = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[at_a - 1], last_b[at_b - 1] = 1, 1
        said[np.arange(len(a)) + np.repeat(from_b, n_a)] = a + last_a * len(self.bytes_a)
        said[np.arange(len(b)) + np.repeat(at_a, n_b)] = b + last_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        texts = list(map(self.said.__getitem__, said.tolist()))
        last = np.searchsorted(ends, ends_of(np.array([len(p.encode()) + 1 for p in parts]))) + 1
        sums = np.stack([at_a, at_b, np.arange(1, len(ends) + 1), ends_of(links)], axis=1)[last - 1]
        counts = np.diff(sums, axis=0, prepend=np.zeros((1, 4), np.int64)).tobytes()
        n, at, link = 0, 0, 0
        for part, (to_a, to_b, _, to_link) in zip(parts, sums.tolist()):
            self.known[part] = (counts[32 * n:32 * n + 32], "".join(texts[at:to_a + to_b]), pairs[8 * link:8 * to_link])
            n, at, link = n + 1, to_a + to_b, to_link

    def forget(self, parts: list[str]) -> None:
        over = len(self.known) - KEPT_PARTS
        for p in parts:
            if over > 0 or len(p) > KEPT_CHARS:
                del self.known[p]
                over -= 1

    def documents(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray]]:
        """Of each text its counts, its groups, and (id pair, how often) by pair."""
        split = [self.parts(t) for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(split)) if p not in self.known]
        self.learn(new)
        none = [0, 0, 0, 0], "", np.empty((0, 2), np.int64)
        for ps in split:
            times = Counter(ps)
            found = [self.known[p] for p in times]
            if not ps or None in found:
                yield none
                continue
            often = np.fromiter(times.values(), np.int64, len(times))
            counts = np.frombuffer(b"".join([f[0] for f in found]), np.int64).reshape(-1, 4)
            links = np.frombuffer(b"".join([f[2] for f in found]), np.int64)
            order = np.argsort(links)
            links, weight = links[order], np.repeat(often, counts[:, 3])[order]
            first = np.flatnonzero(np.concatenate([[True], links[1:] != links[:-1]]))
            said = {p: f[1] for p, f in zip(times, found)}
            yield ((counts * often[:, None]).sum(axis=0).tolist(), "".join(map(said.__getitem__, ps))[:-1],
                   np.stack([links[first], np.add.reduceat(weight, first)], axis=1))
        self.forget(new)


def _aligner(shared: Broadcast) -> Aligner:
    return held((__name__, shared.value[0]), lambda: Aligner(*shared.value[1:]))


def shared_vocabularies(docs: DataFrame, bytes_path: str | None, pieces_path: str | None) -> Broadcast:
    """Both vocabularies, whose sizes are fixed, for every executor, under their digest."""
    with open(bytes_path or public_tokenizers.path(BYTES_VOCABULARY), encoding="utf-8") as file:
        bytes_json = file.read()
    with open(pieces_path or public_tokenizers.path(PIECES_VOCABULARY), "rb") as file:
        pieces_model = file.read()
    name = hashlib.sha256(bytes_json.encode() + pieces_model).hexdigest()
    return docs.sparkSession.sparkContext.broadcast((name, bytes_json, pieces_model))


def _int_lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int32)))


def align(docs: DataFrame, *, text_col: str = "text", groups_col: str | None = None,
          bytes_path: str | None = None, pieces_path: str | None = None) -> DataFrame:
    """``docs`` without the text, with the counts n_a, n_b, n_groups and n_links, the
    digest ``groups_sha256``, and the distinct linked pairs as three arrays: ``a_ids``,
    ``b_ids`` and ``times``.  ``groups_col`` adds the groups themselves."""
    shared = shared_vocabularies(docs, bytes_path, pieces_path)
    names = [*COUNTS, "groups_sha256", *([groups_col] if groups_col else []), "a_ids", "b_ids", "times"]
    raw = free_name("_align_text", docs.columns)
    text = F.col(text_col).cast("string").cast("binary").alias(raw)
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in [*names, text_col]}]
    source = docs.select(*kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared)
        for batch in batches:
            for part in slices(batch, raw, size=TEXT_AT_ONCE):
                counts, digests, groups, pairs = [], [], [], []
                for count, group, links in aligner.documents(decoded_texts(part.column(raw))):
                    counts.append(count)
                    digests.append(hashlib.sha256(group.encode()).hexdigest() if group else "")
                    if groups_col:
                        groups.append(group)
                    pairs.append(links)
                table = np.array(counts, np.int64).reshape(-1, len(COUNTS))
                made = {c: pa.array(table[:, i]) for i, c in enumerate(COUNTS)}
                made["groups_sha256"] = pa.array(digests, pa.string())
                if groups_col:
                    made[groups_col] = pa.array(groups, pa.string())
                made["a_ids"] = _int_lists([p[:, 0] >> 32 for p in pairs])
                made["b_ids"] = _int_lists([p[:, 0] & 0xFFFFFFFF for p in pairs])
                made["times"] = _int_lists([p[:, 1] for p in pairs])
                yield with_columns(part, [raw], made)

    lists = T.ArrayType(T.IntegerType(), False)
    kinds = {**{c: T.LongType() for c in COUNTS}, "groups_sha256": T.StringType(),
             **({groups_col: T.StringType()} if groups_col else {}), "a_ids": lists, "b_ids": lists, "times": lists}
    fields = [f for f in source.schema.fields if f.name != raw]
    return map_batches(source, run, T.StructType([*fields, *[T.StructField(n, kinds[n], False) for n in names]]))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): how many documents hold each pair, and whether no pair with the
    same id of A is held by more."""
    pairs = aligned.select(F.inline(F.arrays_zip(F.col("a_ids").alias("a"), F.col("b_ids").alias("b"))))
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    counted = written(counted, "pairs")
    highest = counted.groupBy(F.col("a").alias("_a")).agg(F.max("n").alias("_most"))
    return counted.join(highest, F.col("a") == F.col("_a")).select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best"))


def frequent(counts: DataFrame, most: int) -> tuple[int, pa.Table]:
    """(least, pairs): the pairs that ``least`` documents or more hold, ``most`` at most.

    Counts fall into classes, sixteen to a doubling, and whole classes are taken from
    the top: the driver receives no more than ``most`` rows, and one row per class.
    """
    level = F.floor(F.log2("n") * 16).alias("level")
    sizes = counts.groupBy(level).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least")).collect()
    least, rows = None, 0
    for size in sorted(sizes, key=lambda r: -r["level"]):
        rows += size["rows"]
        if rows > most:
            break
        least = size["least"]
    if least is None:
        return 1 << 62, counts.limit(0).toArrow()
    return least, counts.where(F.col("n") >= least).toArrow()


def score(aligned: DataFrame, counts: DataFrame, most: int = HELD_PAIRS) -> DataFrame:
    """``aligned``, a stored table, without the pairs and with ``n_best`` and
    ``count_sum``; ``counts`` is the stored table of :func:`pair_counts`."""
    least, table = frequent(counts, most)
    keys = table["a"].to_numpy().astype(np.int64) << 32 | table["b"].to_numpy()
    order = np.argsort(keys)
    best = table["best"].to_numpy(zero_copy_only=False)[order]
    shared = aligned.sparkSession.sparkContext.broadcast((keys[order], table["n"].to_numpy()[order], best))
    kept = [c for c in aligned.columns if c not in ("a_ids", "b_ids", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            for part in slices(batch):
                lists = part.column("a_ids")
                lengths = np.diff(lists.offsets.to_numpy())
                a, b, times = (part.column(c).flatten().to_numpy().astype(np.int64) for c in ("a_ids", "b_ids", "times"))
                row, pair = np.repeat(np.arange(part.num_rows), lengths), a << 32 | b
                at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
                known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
                held, at, rest = known.nonzero()[0], at[known], (~known).nonzero()[0]
                sums, bests = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
                np.add.at(sums, row[held], times[held] * n[at])
                np.add.at(bests, row[held], times[held] * best[at])
                cuts = np.searchsorted(row[rest], np.arange(part.num_rows + 1)).astype(np.int32)
                entries = pa.StructArray.from_arrays([pa.array(x[rest].astype(np.int32)) for x in (a, b, times)],
                                                     ["a", "b", "times"])
                yield with_columns(part, ["a_ids", "b_ids", "times"], {
                    "_best": pa.array(bests), "_sum": pa.array(sums),
                    "_rest": pa.ListArray.from_arrays(pa.array(cuts), entries)})

    fields = [aligned.schema[c] for c in kept]
    entry = T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "b", "times")])
    schema = T.StructType([*fields, T.StructField("_best", T.LongType()), T.StructField("_sum", T.LongType()),
                           T.StructField("_rest", T.ArrayType(entry))])
    partly = written(map_batches(aligned, run, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = counts.where(F.col("n") < least).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "n", "best")
    rest = (partly.select("_row", F.inline("_rest")).join(rare, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
            .groupBy(F.col("_row").alias("_of")).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_more_best"),
                                                     F.sum(F.col("n") * F.col("times")).alias("_more")))
    more = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return partly.join(rest, F.col("_row") == F.col("_of"), "left").select(
        *kept, more("_best", "_more_best").alias("n_best"), more("_sum", "_more").alias("count_sum"))


def alignment(docs: DataFrame, *, text_col: str = "text", most: int = HELD_PAIRS, bytes_path: str | None = None,
              pieces_path: str | None = None) -> DataFrame:
    """``docs`` without the text, with all counts and the digest of the groups."""
    aligned = written(align(docs, text_col=text_col, bytes_path=bytes_path, pieces_path=pieces_path), "aligned")
    return score(aligned, written(pair_counts(aligned), "pair-counts"), most)

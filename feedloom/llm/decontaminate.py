"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and underscores, in lower case.  Karp-Rabin
hashes of ``MIN_MATCH`` words, run over a document and looked up among those of
the benchmark, give seeds; equal words confirm them.  Seeds next to each other
on one diagonal form a maximal match.  For each document and item with a seed,
the longest match is marked again and again, what overlaps with marked words is
cut off, until no match of ``MIN_MATCH`` words is left.  An item is contained if
the marked words cover at least ``MIN_COVERAGE`` of it, in whatever order its
passages come.  Long texts of few words have too many pairs of equal seeds to list
them; there, hashes of falling width are compared, which needs no list.

Documents are never shuffled: every task has the benchmark, in blocks of at most
``BLOCK_BYTES`` of text (or one item); a larger benchmark takes more passes.

Defined cases: null texts have no words; an item with fewer than ``MIN_MATCH``
words is contained in nothing; ties take the earliest place in the document,
then in the item; repeated items and documents are answered each; an empty
benchmark or table gives no hits; other columns stay.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import decoded_texts, free_name, held, map_batches, slices, with_columns

MIN_MATCH, MIN_COVERAGE = 5, 0.5
BLOCK_BYTES = 16 << 20
#: Pairs of equal seeds of a document and an item that are listed; more, as long texts of
#: few words have, are tiled by :func:`running_tiles`, with the same result.
PAIRS = 1 << 16
WORD = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType()),
                    T.StructField("longest", T.IntegerType()), T.StructField("spans", T.ArrayType(SPAN))])
_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("longest", pa.int32()),
                            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def words_of(text: str) -> list[str]:
    """The words in lower case; as many as the pattern finds in the text itself."""
    found = WORD.findall(text)
    return "\n".join(found).lower().split("\n") if found else []


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``width`` word numbers."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * BASE + ids[k:k + n].astype(np.uint64) + np.uint64(1)
    return out


def tiles(matches: list[tuple[int, int, int]], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, length) out of maximal matches.

    The longest match is taken if none of its words is marked; otherwise its
    unmarked stretches, as far as they are long enough, compete in its place.
    """
    heap = [(-n, d, p) for d, p, n in matches]
    heapq.heapify(heap)
    in_doc, in_item, out = set(), set(), []
    while heap:
        size, d, p = heapq.heappop(heap)
        free = [d + k not in in_doc and p + k not in in_item for k in range(-size)]
        if all(free):
            out.append((d, p, -size))
            in_doc.update(range(d, d - size))
            in_item.update(range(p, p - size))
            continue
        run = 0
        for k, ok in enumerate([*free, False]):
            if ok:
                run += 1
            elif run:
                if run >= min_match:
                    heapq.heappush(heap, (-run, d + k - run, p + k - run))
                run = 0
    return out


class Windows:
    """Karp-Rabin hashes of all windows of a sequence, for any width, by prefix sums."""

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((ids + 1).astype(np.uint64) * powers[:n], dtype=np.uint64)])

    def of(self, width: int, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of each window whose words are all free."""
        used = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(used[width:] == used[:-width])
        return at, (self.sums[at + width] - self.sums[at]) * self.back[at]


def running_tiles(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """The greedy tiles of :func:`tiles` without a list of matches, in memory of both texts' length.

    Running Karp-Rabin: the longest width at which free windows of both sides have
    equal hashes is found by halving, as shorter windows agree where longer ones do.
    At this width the tiles are taken by place; then the next smaller width follows.
    Equal words confirm each tile; hashes that only seem equal make the width too
    large, never too small, and it goes down by one then.
    """
    in_doc, in_item = Windows(doc), Windows(item)
    free_doc, free_item = doc >= 0, np.ones(len(item), bool)
    out = []

    def agree(width: int) -> bool:
        return bool(np.isin(in_item.of(width, free_item)[1], in_doc.of(width, free_doc)[1]).any())

    largest = min(len(doc), len(item))
    while largest >= min_match and agree(min_match):
        low, high = min_match, largest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if agree(middle) else (low, middle - 1)
        width = low
        at, hashes = in_item.of(width, free_item)
        left: dict[int, list[int]] = {}
        for p, h in zip(at.tolist(), hashes.tolist()):
            left.setdefault(h, []).append(p)
        at, hashes = in_doc.of(width, free_doc)
        shared = np.isin(hashes, np.fromiter(left, np.uint64, len(left)))
        end = 0
        for d, h in zip(at[shared].tolist(), hashes[shared].tolist()):
            if d < end or h not in left:
                continue
            left[h] = [p for p in left[h] if free_item[p:p + width].all()]
            if not left[h]:
                del left[h]
                continue
            p = next((p for p in left[h] if np.array_equal(doc[d:d + width], item[p:p + width])), None)
            if p is not None:
                out.append((d, p, width))
                free_doc[d:d + width] = free_item[p:p + width] = False
                end = d + width
        largest = width - 1
    return out


class Items:
    """A block of benchmark items with the index of their seeds."""

    def __init__(self, items: list[tuple[int, str]], min_match: int) -> None:
        self.min_match = min_match
        split = [words_of(text or "") for _, text in items]
        self.ids = [i for i, _ in items]
        self.number = {w: n for n, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        self.words = [np.array([self.number[w] for w in ws], np.int64) for ws in split]
        lengths = np.array([len(ws) for ws in self.words], np.int64)
        self.flat, self.offset = np.concatenate([*self.words, np.empty(0, np.int64)]), np.cumsum(lengths) - lengths
        hashes = [rolling(ws, min_match) for ws in self.words]
        flat = np.concatenate([*hashes, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])[order]
        self.at = np.concatenate([*[np.arange(len(h)) for h in hashes], np.empty(0, np.int64)]).astype(np.int64)[order]
        self.distinct = np.unique(self.hashes)

    def shared(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Where the document's hashes are those of items, not yet as pairs of places.

        Gives the document's places grouped by hash; for each item (sorted) its places
        with the group of equal document places, as (first, count) and item place; and
        the items.  All of it is as large as document and block together at most.
        """
        hashes = rolling(ids, self.min_match)
        none = np.empty(0, np.int64)
        if not len(hashes) or not len(self.distinct):
            return none, [], none
        place = np.searchsorted(self.distinct, hashes)
        place[place == len(self.distinct)] = 0
        inside = np.convolve(ids >= 0, np.ones(self.min_match, np.int64), "valid") == self.min_match
        at = np.flatnonzero((self.distinct[place] == hashes) & inside)
        if not len(at):
            return none, [], none
        at = at[np.argsort(hashes[at], kind="stable")]
        values, first, count = np.unique(hashes[at], return_index=True, return_counts=True)
        begin = np.searchsorted(self.hashes, values, "left")
        size = np.searchsorted(self.hashes, values, "right") - begin
        group = np.repeat(np.arange(len(values)), size)
        entry = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        order = np.argsort(self.item[entry], kind="stable")
        group, entry = group[order], entry[order]
        items, starts = np.unique(self.item[entry], return_index=True)
        parts = [(first[g], count[g], self.at[e]) for g, e in
                 zip(np.split(group, starts[1:]), np.split(entry, starts[1:]))]
        return at, parts, items

    def matches(self, ids: np.ndarray, at: np.ndarray, part: tuple, item: int) -> list[tuple[int, int, int]]:
        """The maximal matches (document word, item word, length) of an item: seeds in a row on a diagonal."""
        first, count, pos = part
        before = np.concatenate([[0], np.cumsum(count)[:-1]])
        doc = at[np.repeat(first - before, count) + np.arange(count.sum())]
        pos = np.repeat(pos, count)
        words, same = self.words[item], np.ones(len(doc), bool)
        for k in range(self.min_match):
            same &= ids[doc + k] == words[pos + k]
        diagonal, doc = (doc - pos)[same], doc[same]
        if not len(doc):
            return []
        order = np.lexsort((doc, diagonal))
        diagonal, doc = diagonal[order], doc[order]
        starts = np.concatenate([[0], np.flatnonzero((np.diff(diagonal) != 0) | (np.diff(doc) != 1)) + 1])
        lengths = np.diff(np.append(starts, len(doc))) + self.min_match - 1
        return list(zip(doc[starts].tolist(), (doc - diagonal)[starts].tolist(), lengths.tolist()))

    def hits(self, text: str, min_coverage: float) -> list[dict]:
        words = words_of(text)
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        at, parts, found = self.shared(ids)
        out, places = [], None
        for item, part in zip(found.tolist(), parts):
            if int(part[1].sum()) <= PAIRS:
                marked = tiles(self.matches(ids, at, part, item), self.min_match)
            else:
                marked = running_tiles(ids, self.words[item], self.min_match)
            coverage = sum(n for _, _, n in marked) / len(self.words[item])
            if not marked or coverage < min_coverage:
                continue
            places = places or [m.span() for m in WORD.finditer(text)]
            out.append({"item_id": self.ids[item], "coverage": coverage, "longest": max(n for _, _, n in marked),
                        "spans": [{"start": places[d][0], "end": places[d + n - 1][1]} for d, _, n in sorted(marked)]})
        return out


def _block(shared: Broadcast, min_match: int) -> Items:
    """The worker's index of a block, built once."""
    name, rows = shared.value
    return held((__name__, name, min_match), lambda: Items(rows, min_match))


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks: dealt by hash to as many blocks as their size asks for."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).where(
        "t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == k) if n > 1 else rows
        yield sorted(((r["id"], r["t"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", hits_col: str = "hits", keep: list[str] | None = None,
         min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all, if not given) with the items each row contains."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != hits_col]
    fields = [f for f in docs.schema.fields if f.name in keep]
    raw = free_name("_tiled_text", keep)
    found = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias(raw),
                        F.array().cast(T.ArrayType(HIT)).alias(hits_col))
    text_field = T.StructField(raw, T.BinaryType())

    def scan(shared: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _block(shared, min_match)
            for batch in batches:
                for part in slices(batch, raw):
                    before = part.column(hits_col).to_pylist()
                    hits = [b + items.hits(t, min_coverage)
                            for b, t in zip(before, decoded_texts(part.column(raw)))]
                    yield with_columns(part, [hits_col], {hits_col: pa.array(hits, _HITS)})
        return run

    schema = T.StructType([*fields, text_field, T.StructField(hits_col, T.ArrayType(HIT))])
    for n, rows in enumerate(blocks(benchmark, item_col, item_text_col, block_bytes)):
        name = f"{docs.sparkSession.sparkContext.applicationId}-{id(rows)}-{n}-{hash(tuple(rows))}"
        found = map_batches(found, scan(docs.sparkSession.sparkContext.broadcast((name, rows))), schema)
    return found.drop(raw)

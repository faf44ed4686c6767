"""Periodic runs of words by a grammar: Re-Pair, runs at each rule's boundary, all derivations.

A run is a stretch of consecutive words with smallest period q, at least
``EXPONENT`` * q and ``LENGTH`` words long, that no neighbouring word extends.

* Cut.  A word pair inside a run occurs three times in its document at least, as
  does a triple, and a five-gram twice.  Where one does not, no run passes, so the
  texts fall into pieces; most prose has none.  Counts are by hash, collisions
  leave more to the next steps and nothing else.
* Re-Pair, one grammar for a batch of documents.  Each round takes the pairs of
  symbols whose number is within half of the highest, gives way to the more
  frequent where two overlap, and replaces them by rules until no pair repeats.
* Boundaries.  A run lies in the value of some smallest node of the derivation, and
  crosses the border of its two parts.  The runs that do are found once for each
  rule (Main and Lorentz: one side holds two periods at least, which the Z-function
  of that side shows), and once for each node of a balanced tree over what Re-Pair
  leaves of a piece.
* Derivations.  A rule's runs are placed wherever the rule is derived, and
  intervals of equal period that overlap by a period become one.

Documents are independent rows: nothing is shuffled, a lost task is run again.
A task holds one batch of at most ``TEXT_AT_ONCE`` bytes, or one longer text.

Defined cases: a null text has no words, no runs and an empty collapsed text; a
text of one word repeated is one run of period 1; ties do not arise, runs come by
start, then period; repeated rows have equal results; an empty table gives no
rows; other columns stay, but for those named like the new ones; text that is not
UTF-8 is handled as its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import free_name, map_batches, slices, with_columns

EXPONENT, LENGTH = 4, 6
TEXT_AT_ONCE = 4 << 20
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
#: Odd numbers that spread n-grams over 64 bits.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


# --- cutting ----------------------------------------------------------------

def _often(keys: np.ndarray, least: int) -> np.ndarray:
    """Whether each key occurs ``least`` times."""
    ordered = np.sort(keys)
    often = ordered[least - 1:][ordered[least - 1:] == ordered[:len(ordered) - least + 1]]
    if not len(often):
        return np.zeros(len(keys), bool)
    often = often[np.concatenate([[True], often[1:] != often[:-1]])]
    return often[np.minimum(np.searchsorted(often, keys), len(often) - 1)] == keys


def _gram_keys(ids: np.ndarray, doc: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    keys = doc[at].astype(np.uint64) * MIX[5]
    for i in range(n):
        keys = (keys ^ ids[at + i].astype(np.uint64)) * MIX[i]
        keys ^= keys >> np.uint64(29)
    return keys


def pieces(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of words that can hold runs.

    ``ids`` are the words of all documents in a row, ``doc`` their documents.
    """
    n = len(ids)
    live = np.zeros(n + 5, bool)
    at = np.flatnonzero(doc[:-1] == doc[1:])
    for size, least, reach in ((2, 3, 2), (3, 3, 3), (5, 2, 1)):
        at = at[_often(_gram_keys(ids, doc, at, size), least)]
        live[:] = False
        live[at] = True
        # The next longer n-gram starts where ``reach`` of these do in a row.
        keep = np.ones(len(at), bool)
        for i in range(1, reach):
            keep &= live[at + i]
        at = at[keep]
    if not len(at):
        return at, at
    new = np.flatnonzero(np.diff(at) > 1) + 1
    starts, lasts = at[np.concatenate([[0], new])], at[np.concatenate([new - 1, [len(at) - 1]])]
    return starts, lasts + 5


# --- Re-Pair ----------------------------------------------------------------

class Grammar:
    """Rules over terminals 0 to ``terminals`` - 1, and the sequence they leave.

    ``flat`` holds the pieces, each followed by -1.  Rule i is symbol
    ``terminals`` + i; a rule's parts are smaller symbols than itself.
    """

    def __init__(self, flat: np.ndarray, terminals: int) -> None:
        self.flat, self.terminals = flat, terminals
        self.left: list[int] = []
        self.right: list[int] = []
        self.size: list[int] = []
        self.first: list[int] = []
        self._rules: dict[int, int] = {}
        self.symbols, self.places = flat.copy(), np.arange(len(flat))
        while self._round():
            pass

    def size_of(self, symbol: int) -> int:
        return 1 if symbol < self.terminals else self.size[symbol - self.terminals]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs start, and their keys; of overlapping equal ones every other."""
        s = self.symbols
        index = np.arange(len(s))
        begins = np.concatenate([[True], s[1:] != s[:-1]])
        odd = (index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 1
        at = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0) & ~((s[:-1] == s[1:]) & odd[:-1]))
        return at, s[at] << 32 | s[at + 1]

    def _round(self) -> bool:
        if len(self.symbols) < 2:
            return False
        at, keys = self._pairs()
        kinds, kind, times = np.unique(keys, return_inverse=True, return_counts=True)
        most = times.max(initial=0)
        if most < 2:
            return False
        # More frequent pairs go first; equally frequent ones by hash, so that
        # a long repeat is halved and not taken up from one end.
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((kinds.astype(np.uint64) * MIX[0], times))] = np.arange(len(kinds))
        chosen = times[kind] * 2 > most
        at, kind = at[chosen], kind[chosen]
        rank = rank[kind]
        touch = np.diff(at) == 1
        wins = np.ones(len(at), bool)
        wins[1:] &= ~touch | (rank[1:] > rank[:-1])
        wins[:-1] &= ~touch | (rank[:-1] > rank[1:])
        at, kind = at[wins], kind[wins]
        used, where, back = np.unique(kind, return_index=True, return_inverse=True)
        symbols = np.array([self._rule(int(kinds[k]), int(self.places[at[w]])) for k, w in zip(used, where)])
        self.symbols[at] = symbols[back]
        stay = np.ones(len(self.symbols), bool)
        stay[at + 1] = False
        self.symbols, self.places = self.symbols[stay], self.places[stay]
        return True

    def _rule(self, key: int, place: int) -> int:
        """The symbol of a pair, a new one if it has none yet."""
        symbol = self._rules.get(key)
        if symbol is None:
            symbol = self._rules[key] = self.terminals + len(self._rules)
            a, b = key >> 32, key & 0xFFFFFFFF
            self.left.append(a)
            self.right.append(b)
            self.size.append(self.size_of(a) + self.size_of(b))
            self.first.append(place)
        return symbol

    def rule_nodes(self) -> np.ndarray:
        """(low, border, high, rule) of the first place of each rule."""
        if not self.left:
            return np.empty((0, 4), np.int64)
        first, size = np.array(self.first), np.array(self.size)
        sizes = np.array([self.size_of(a) for a in self.left])
        return np.stack([first, first + sizes, first + size, np.arange(len(size))], axis=1)

    def top_nodes(self) -> np.ndarray:
        """(low, border, high, -1) of the balanced trees over what is left of each piece."""
        ends = np.flatnonzero(self.symbols < 0)
        begins = np.concatenate([[0], ends[:-1] + 1])
        nodes, width = [np.empty((0, 4), np.int64)], 1
        while len(begins):
            # Of each piece, the borders between two subtrees of ``width`` symbols.
            counts = np.maximum((ends - begins + width - 1) // (2 * width), 0)
            piece = np.repeat(np.arange(len(begins)), counts)
            nth = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
            low = begins[piece] + 2 * width * nth
            nodes.append(np.stack([self.places[low], self.places[low + width],
                                   self.places[np.minimum(low + 2 * width, ends[piece])],
                                   np.full(len(low), -1)], axis=1))
            wide = ends - begins > 2 * width
            begins, ends, width = begins[wide], ends[wide], 2 * width
        return np.concatenate(nodes)


# --- runs at a border -------------------------------------------------------

def _squares(side: list[int], longest: int) -> Iterator[tuple[int, int]]:
    """(q, reach) of the primitive squares that ``side`` begins with, q up to
    ``longest``; its first ``reach`` words have period q (Z-function)."""
    n, far, back = len(side), 0, 0
    z = [0] * (longest + 1)
    known = 0
    for q in range(1, longest + 1):
        length = min(z[q - back], far - q) if q < far else 0
        if q + length >= far:
            far, back = max(far, q), q
            while far < n and side[far] == side[far - q]:
                far += 1
            length = far - q
        z[q] = length
        if length >= q and 2 * q > known:
            known = max(known, q + length)
            yield q, q + length


def border_runs(words: list[int], low: int, border: int, high: int) -> set[tuple[int, int, int]]:
    """(start, end, period) of the runs of words[low:high] that cross ``border``."""
    found, longest = set(), (high - low) // EXPONENT
    for q, reach in _squares(words[border:high], min(longest, (high - border) // 2)):
        start, end = border, border + reach
        while start > low and words[start - 1] == words[start - 1 + q]:
            start -= 1
        if start < border and end - start >= max(LENGTH, EXPONENT * q):
            found.add((start, end, q))
    for q, reach in _squares(words[low:border][::-1], min(longest, (border - low) // 2)):
        start, end = border - reach, border
        while end < high and words[end] == words[end - q]:
            end += 1
        if end > border and end - start >= max(LENGTH, EXPONENT * q):
            found.add((start, end, q))
    return found


def _near(grammar: Grammar, nodes: np.ndarray) -> np.ndarray:
    """The nodes that a run can cross: the two words at the border recur within
    the node, at a distance of a quarter of it at most."""
    flat = grammar.flat
    nodes = nodes[nodes[:, 2] - nodes[:, 0] >= LENGTH]
    if not len(nodes):
        return nodes
    key = flat[:-1] * np.int64(grammar.terminals + 1) + flat[1:]
    order = np.argsort(key, kind="stable")
    same, gap = key[order[1:]] == key[order[:-1]], np.diff(order)
    far = len(flat) + 1
    ahead, behind = np.full(len(flat), far), np.full(len(flat), far)
    ahead[order[:-1][same]] = gap[same]
    behind[order[1:][same]] = gap[same]
    low, border, high = nodes[:, 0], nodes[:, 1], nodes[:, 2]
    most = (high - low) // EXPONENT
    after, before = ahead[border - 1], behind[border - 1]
    return nodes[((after <= most) & (border + after < high)) | ((before <= most) & (border - 1 - before >= low))]


# --- derivations ------------------------------------------------------------

def _placed(grammar: Grammar, own: dict[int, list[tuple[int, int, int]]]) -> list[np.ndarray]:
    """The runs of each rule, relative to its start, at all places that derive it."""
    rules, t = len(grammar.left), grammar.terminals
    needed = np.zeros(rules, bool)
    for r in range(rules):
        needed[r] = r in own or any(c >= t and needed[c - t] for c in (grammar.left[r], grammar.right[r]))
    places: dict[int, list[np.ndarray]] = {}
    top = np.flatnonzero(grammar.symbols >= t)
    top = top[needed[grammar.symbols[top] - t]] if rules else top
    order = top[np.argsort(grammar.symbols[top], kind="stable")]
    for group in np.split(order, np.flatnonzero(np.diff(grammar.symbols[order])) + 1):
        if len(group):
            places[int(grammar.symbols[group[0]]) - t] = [grammar.places[group]]
    out = []
    for r in range(rules - 1, -1, -1):
        if not needed[r] or r not in places:
            continue
        at = np.concatenate(places.pop(r))
        for start, end, q in own.get(r, ()):
            out.append(np.stack([at + start, at + end, np.full(len(at), q)], axis=1))
        a, b = grammar.left[r], grammar.right[r]
        for child, shift in ((a, 0), (b, grammar.size_of(a))):
            if child >= t and needed[child - t]:
                places.setdefault(child - t, []).append(at + shift)
    return out


def merged(found: np.ndarray) -> np.ndarray:
    """Maximal (start, end, period): intervals of one period that overlap by it
    become one, and of equal intervals the smallest period stays."""
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 1], found[:, 0], found[:, 2]))]
    start, end, q = found.T
    span = int(end.max()) + 1
    group = np.cumsum(np.concatenate([[0], q[1:] != q[:-1]]))
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - q[1:])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(found) - 1]])
    runs = np.stack([start[first], reach[last], q[first]], axis=1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = (runs[1:, 0] == runs[:-1, 0]) & (runs[1:, 1] == runs[:-1, 1])
    return runs[np.concatenate([[True], ~again])]


def find(ids: np.ndarray, doc: np.ndarray, terminals: int) -> np.ndarray:
    """(start, end, period) of all runs, by start; places are those of ``ids``,
    the words of all documents in a row."""
    none = np.empty((0, 3), np.int64)
    if len(ids) < LENGTH:
        return none
    starts, ends = pieces(ids, doc)
    if not len(starts):
        return none
    sizes = ends - starts
    flat = np.full(int((sizes + 1).sum()), -1, np.int64)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat[np.repeat(begins, sizes) + inside] = ids[np.repeat(starts, sizes) + inside]
    grammar = Grammar(flat, terminals)
    words, own, out = flat.tolist(), {}, [none]
    for low, border, high, rule in _near(grammar, np.concatenate([grammar.rule_nodes(), grammar.top_nodes()])).tolist():
        runs = border_runs(words, low, border, high)
        if rule < 0:
            out.append(np.array(sorted(runs), np.int64).reshape(-1, 3))
        elif runs:
            own[rule] = [(s - low, e - low, q) for s, e, q in sorted(runs)]
    found = merged(np.concatenate([*out, *_placed(grammar, own)]))
    if not len(found):
        return none
    shift = (starts - begins)[np.searchsorted(begins, found[:, 0], "right") - 1]
    found = found + np.stack([shift, shift, np.zeros_like(shift)], axis=1)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


# --- documents --------------------------------------------------------------

def runs_of(texts: list[bytes | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Of each text its runs (start, length, period) and the collapsed text."""
    # bytes.split knows the white space of ASCII only, as the contract does.
    split = [(t or b"").split() for t in texts]
    known: dict[bytes, int] = {}
    lengths = np.array([len(w) for w in split], np.int64)
    ids = np.fromiter((known.setdefault(w, len(known)) for words in split for w in words),
                      np.int64, int(lengths.sum()))
    begins = np.cumsum(lengths) - lengths
    found = find(ids, np.repeat(np.arange(len(split)), lengths), len(known))
    # Documents without words share their begin with the next one.
    of = np.searchsorted(begins, found[:, 0], "right") - 1
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for d, (start, end, q) in zip(of.tolist(), found.tolist()):
        runs[d].append((start - int(begins[d]), end - start, q))
    collapsed = []
    for words, some in zip(split, runs):
        if some:
            change = np.zeros(len(words) + 1, np.int64)
            for start, length, q in some:
                change[start + q] += 1
                change[start + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        collapsed.append(b" ".join(words))
    return runs, collapsed


def find_runs(docs: DataFrame, *, text_col: str = "text", runs_col: str = "runs",
              collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` with the runs of each text, array<struct<start, length, period>> in
    words from 0, and the text without the words that a run repeats."""
    docs = docs.drop(runs_col, *([] if collapsed_col == text_col else [collapsed_col]))
    raw = free_name("_runs_text", docs.columns)
    source = docs.withColumn(raw, F.col(text_col).cast("string").cast("binary")).drop(collapsed_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw, size=TEXT_AT_ONCE):
                runs, collapsed = runs_of(part.column(raw).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
                entries = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], RUN.names)
                yield with_columns(part, [raw], {
                    runs_col: pa.ListArray.from_arrays(pa.array(ends), entries),
                    collapsed_col: pa.array(collapsed, pa.binary())})

    fields = [f for f in source.schema.fields if f.name != raw]
    made = map_batches(source, run, T.StructType([
        *fields, T.StructField(runs_col, T.ArrayType(RUN, False), False),
        T.StructField(collapsed_col, T.BinaryType(), False)]))
    return made.withColumn(collapsed_col, F.col(collapsed_col).cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, the first of equals; null without runs."""
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, 0), lambda a, x: F.when(better(a, x), x).otherwise(a))


def listed(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    line = F.transform(runs, lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return F.array_join(line, "")


def with_repeats(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text in which a tenth of the documents repeat a stretch up to their end.

    With h the crc32 of the id in decimal digits and g = h div 10: where h mod 10
    is 0, each of n words from a = g mod n on becomes word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def of(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        word = lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " "))

    text = F.col(text_col).cast("string")
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), 0)
    changed = F.get(F.transform(F.array(words), of), 0)
    return F.when(h % 10 == 0, F.coalesce(changed, text)).otherwise(text)

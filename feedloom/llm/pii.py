"""Personal data by candidate generation and gradient-boosted trees.

Generators of high recall propose overlapping spans: the strict patterns (the
base, which always stays) and loose ones, such as written-out mail addresses,
phone numbers without a plus, parts of digit runs with other separators, IPv6
addresses and addresses with marked dots.  Boosted trees score each candidate by
its format and its context.  They learn from all distinct texts, each of which
counts once: each base span is written anew in a loose form, in its own place.  The candidate
that is exactly this form is positive; others that touch it, and all candidates
of the text that touch no base span, are negative.  The latter may be personal
data without a label, so that measured precision is a lower bound.  The texts are
dealt by their hash: three of four train the trees, and on the others each kind gets the lowest threshold whose precision
reaches ``PRECISION``; candidates above it that overlap no better span are added.

Every pattern takes time in proportion to the text, whatever it holds.

Defined cases: a null text is empty; where the table lacks positive or negative
candidates nothing is added to the base; equal scores go to the earlier, then
the longer candidate; repeated rows have equal results; an empty table gives no
rows; other columns stay, but for one named like the new one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import decoded_texts, free_name, map_batches, slices, with_columns, written

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, PRECISION = 12, 3, 0.9
WINDOW = 24
#: Steps between the scores 0 and 1 that a threshold can have.
SCORE_STEPS = 1000
#: Examples that leave a task at a time.
EXAMPLES = 4096
#: A number is written in at most so many groups of digits.
GROUPS = 6

# The characters and patterns of the base kinds.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MARKED_AT = re.compile(r" ?[(\[{]at[)\]}] ?| at ", re.I)
WRITTEN_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?[(\[{]dot[)\]}] ?| dot |\.)[A-Za-z0-9-]{2,63}){1,8}", re.I)
DIGIT_RUN = re.compile(r"[+(]?[0-9](?:[ ().:/_-]{0,2}[0-9])*")
DIGIT_GROUP = re.compile(r"[0-9]+")
MARKED_DOTS = re.compile(r"[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?[(\[]dot[)\]] ?| dot )[0-9]{1,3}){3}", re.I)
HEX_RUN = re.compile(r"[0-9A-Fa-f:]{7,45}")
#: Words before a candidate that speak for a kind.
CUES = {"email": ("mail", "contact", "@"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "master", "account"), "phone": ("tel", "phone", "call", "mobile", "fax")}


class Candidate(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    valid: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: for each @ the local characters before it, and the domain after it."""
    at, free = text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four joined numbers at a time out of each run of numbers joined by dots."""
    for run in DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            end = at + len(".".join(parts[i:i + 4]))
            yield at, end
            at = end + 1


def _number(s: str) -> int:
    """The value of a part of an address; long ones only need to be too large."""
    s = s.lstrip("0")
    return int(s[:4] or 0) if len(s) <= 3 else 1000


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_candidates(text: str) -> list[Candidate]:
    """All matches of the strict patterns; ``valid`` tells which are base spans."""
    out = [Candidate("email", s, e, True, True) for s, e in _emails(text)] if "@" in text else []
    for s, e in _ips(text):
        ok = all(_number(p) <= 255 for p in text[s:e].split("."))
        out.append(Candidate("ip", s, e, ok, ok))
    for m in DIGITS.finditer(text):
        d = _digits(m.group())
        ok = 14 <= len(d) <= 19 and luhn(d)
        out.append(Candidate("card", *m.span(), ok, ok))
    if "+" in text:
        for m in PLUS.finditer(text):
            ok = 10 <= len(_digits(m.group())) <= 15
            out.append(Candidate("phone", *m.span(), ok, ok))
    return out


def _numbers(text: str, start: int, end: int) -> Iterator[Candidate]:
    """Cards and phone numbers in a run of digit groups: the whole run, and what few
    groups in a row may be; with a checksum for parts, as most of them are nothing."""
    groups = [m.span() for m in DIGIT_GROUP.finditer(text, start, end)]
    total = sum(e - s for s, e in groups)
    if total < 7:
        return
    if total <= 20:
        d = _digits(text[start:end])
        if total >= 12:
            yield Candidate("card", start, end, False, 14 <= total <= 19 and luhn(d))
        if total <= 16:
            yield Candidate("phone", start, end, False, 10 <= total <= 15)
    for i, (s, _) in enumerate(groups):
        size = 0
        for j in range(i, min(i + GROUPS, len(groups))):
            e = groups[j][1]
            size += e - groups[j][0]
            if size > 19:
                break
            begin = s - 1 if s > start and text[s - 1] in "+(" else s
            if (begin, e) == (start, end):
                continue
            if 10 <= size <= 15:
                yield Candidate("phone", begin, e, False, True)
            if size >= 14 and luhn(_digits(text[s:e])):
                yield Candidate("card", s, e, False, True)


def loose_candidates(text: str) -> list[Candidate]:
    """Spans of the loose generators."""
    out, free = [], 0
    for m in MARKED_AT.finditer(text):
        before, free = text[free:m.start()], m.end()
        local = len(before) - len(before.rstrip(LOCAL))
        domain = WRITTEN_DOMAIN.match(text, m.end()) if local else None
        if domain and (m.group().strip().lower() != "at" or re.search(r"dot", domain.group(), re.I)):
            out.append(Candidate("email", m.start() - local, domain.end(), False, True))
    for m in DIGIT_RUN.finditer(text):
        out.extend(_numbers(text, *m.span()))
    for m in MARKED_DOTS.finditer(text):
        out.append(Candidate("ip", *m.span(), False, all(_number(p) <= 255 for p in DIGIT_GROUP.findall(m.group()))))
    if text.count(":") >= 2:
        for m in HEX_RUN.finditer(text):
            parts = m.group().split(":")
            if len(parts) >= 4:
                ok = len(parts) <= 8 and all(len(p) <= 4 for p in parts) and m.group().count("::") <= 1 and (
                    len(parts) == 8 or "::" in m.group())
                out.append(Candidate("ip", *m.span(), False, ok))
    return out


def features(text: str, c: Candidate) -> list[float]:
    """Format and context of a candidate."""
    s = text[c.start:c.end]
    short = s[:256]
    groups = re.findall(r"[0-9]+", short)
    d = "".join(groups)
    before, after = text[max(0, c.start - WINDOW):c.start], text[c.end:c.end + WINDOW]
    left, right = before[-1:], after[:1]
    cue = before.lower()
    tail = re.split(r"[.@ ]", s)[-1] if c.kind == "email" else ""
    return [
        *[float(c.kind == k) for k in KINDS],
        len(s), len(d), sum(x.isalpha() for x in short), len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0), len(set(d)),
        s.count("."), s.count("-"), s.count(" "), s.count("(") + s.count(")"), s.count(":"), s.count("@"),
        float(s[:1] == "+"), float(luhn(d)) if d else 0.0,
        float(len(groups) == 4 and all(_number(g) <= 255 for g in groups)),
        len(tail), float(tail.isalpha()),
        float(left.isalnum()), float(right.isalnum()), float(left in " \n\t("), float(right in " \n\t.,;)"),
        sum(x.isdigit() for x in before), sum(x.isdigit() for x in after),
        float(any(w in cue for w in CUES[c.kind])),
        float("=" in before[-4:] or ":" in before[-3:]),
    ]


N_FEATURES = 30


@dataclass
class Forest:
    """Boosted trees as arrays, with a threshold for each kind."""

    weights: list[float] = field(default_factory=list)
    #: For each tree, its nodes as (feature, threshold, left, right, value); a leaf has feature -1.
    trees: list[list[tuple[int, float, int, int, float]]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability that the trees give to each candidate."""
        margin = np.zeros(len(rows))
        for weight, nodes in zip(self.weights, self.trees):
            feature, limit, left, right, value = (np.array(x) for x in zip(*nodes))
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                go_left = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= limit[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


def _nodes(root) -> list[tuple[int, float, int, int, float]]:
    """A fitted tree's nodes in one list."""
    out: list = []

    def add(node) -> int:
        here = len(out)
        out.append((-1, 0.0, 0, 0, node.prediction()))
        if node.subtreeDepth() > 0:
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            out[here] = (split.featureIndex(), split.threshold(), left, right, node.prediction())
        return here

    add(root)
    return out


def exported(model: GBTClassificationModel) -> Forest:
    return Forest(list(model.treeWeights), [_nodes(t._java_obj.rootNode()) for t in model.trees])


def loose_form(kind: str, span: str) -> str:
    """A base span in another writing, which its own characters choose."""
    choice = int(hashlib.md5(span.encode()).hexdigest()[:8], 16) % 4
    if kind == "email":
        local, domain = span.split("@")
        at, dot = ((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."))[choice]
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return span.replace(".", ("[.]", "(.)", " dot ", "(dot)")[choice])
    if kind == "card":
        d = _digits(span)
        return "./_:"[choice].join(d[i:i + 4] for i in range(0, len(d), 4))
    return span[1:] if choice == 0 else "./-"[choice - 1].join(DIGIT_GROUP.findall(span))


def _touch(a: Candidate, start: int, end: int) -> bool:
    return a.start < end and start < a.end


def examples(text: str) -> Iterator[tuple[str, list[float], float]]:
    """(kind, features, label) of a text's candidates and of its base spans in loose forms."""
    strict = base_candidates(text)
    base = Taken((c.start, c.end) for c in strict if c.base)
    for c in strict + loose_candidates(text):
        if not c.base and base.free(c.start, c.end):
            yield c.kind, features(text, c), 0.0
    for c in strict:
        if c.base:
            form = loose_form(c.kind, text[c.start:c.end])
            before = text[max(0, c.start - 2 * WINDOW):c.start]
            around = before + form + text[c.end:c.end + 2 * WINDOW]
            start, end = len(before), len(before) + len(form)
            for o in base_candidates(around) + loose_candidates(around):
                if not o.base and _touch(o, start, end):
                    yield o.kind, features(around, o), float((o.kind, o.start, o.end) == (c.kind, start, end))


def labelled(docs: DataFrame, text_col: str) -> DataFrame:
    """(kind, features, label, fold) of the examples of all texts; a text has one fold of four.

    ``text`` is the text's hash and ``place`` the example's number in it."""
    text = F.col(text_col).cast("string")
    source = docs.where(F.length(text) > 0).select(text.cast("binary").alias("t"), F.xxhash64(text).alias("text"))

    def rows_of(part: pa.RecordBatch) -> Iterator[tuple]:
        for text, key in zip(decoded_texts(part.column("t")), part.column("text").to_pylist()):
            fold = int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 4
            for place, example in enumerate(examples(text)):
                yield *example, fold, key, place

    kinds = [pa.string(), pa.list_(pa.float64()), pa.float64(), pa.int32(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                rows = rows_of(part)
                while some := list(islice(rows, EXAMPLES)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*some), kinds)],
                                                     ["kind", "x", "label", "fold", "text", "place"])

    return map_batches(source, run, "kind string, x array<double>, label double, fold int, text bigint, place int")


def calibrated(bins: list[tuple[int, int, float]], precision: float) -> float:
    """The lowest threshold whose smoothed precision reaches ``precision``; infinite if none does.

    ``bins`` is (step of the score, examples, positive ones)."""
    best, n, positive = float("inf"), 0, 0.0
    for step, count, right in sorted(bins, reverse=True):
        n, positive = n + count, positive + right
        if (positive + 1) / (n + 2) >= precision:
            best = step / SCORE_STEPS
    return best


def score_bins(rows: DataFrame, forest: Forest) -> DataFrame:
    """(kind, step, examples, positives) of examples: at most ``SCORE_STEPS`` + 1 rows a kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
            step = np.floor(forest.score(xs) * SCORE_STEPS).astype(np.int32)
            yield with_columns(batch.select(["kind", "label"]), [], {"step": pa.array(step)})

    scored = map_batches(rows.select("kind", "label", "x"), run, "kind string, label double, step int")
    return scored.groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive"))


def sampled(docs: DataFrame, text_col: str, sample_rows: int, seed: int) -> DataFrame:
    """About ``sample_rows`` distinct texts, or all; however often a text is repeated, it counts once."""
    texts = docs.select(F.col(text_col).cast("string").alias(text_col)).where(F.length(text_col) > 0).withColumn(
        "_hash", F.xxhash64(text_col, F.lit(seed)))
    distinct = texts.agg(F.approx_count_distinct("_hash")).first()[0]
    key = F.pmod(F.col("_hash"), F.lit(1_000_000_007))
    return texts.where(key < int(1_000_000_007 * min(1.0, sample_rows / max(distinct, 1)))).dropDuplicates(["_hash"])


def fit(docs: DataFrame, *, text_col: str = "text", sample_rows: int | None = None,
        precision: float = PRECISION, seed: int = 0) -> Forest:
    """Trees and thresholds from all distinct texts, or about ``sample_rows`` of them if that is given.

    Copies of a text give the same examples, which are dropped by the text's hash and
    their place: no text is shuffled."""
    if sample_rows is not None:
        docs = sampled(docs, text_col, sample_rows, seed)
    rows = written(labelled(docs, text_col).dropDuplicates(["text", "place"]), "candidates")
    train = rows.where("fold > 0")
    if train.select("label").distinct().count() < 2:
        return Forest()
    vectors = train.select("label", array_to_vector("x").alias("features"))
    forest = exported(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed).fit(vectors))
    bins = score_bins(rows.where("fold = 0"), forest).collect()
    for kind in KINDS:
        forest.thresholds[kind] = calibrated(
            [(r["step"], r["n"], r["positive"]) for r in bins if r["kind"] == kind], precision)
    return forest


class Taken:
    """Spans in a text, united where they touch, for looking up whether a place is free."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i == 0 or self.ends[i - 1] <= start

    def add(self, start: int, end: int) -> None:
        """Take a free place."""
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def detect(text: str, forest: Forest) -> tuple[list[Candidate], list[Candidate]]:
    """The base spans and the added ones."""
    if not any(map(text.__contains__, "0123456789@:")) and not MARKED_AT.search(text):
        return [], []
    strict = base_candidates(text)
    base = [c for c in strict if c.base]
    others = [c for c in strict + loose_candidates(text) if not c.base] if forest.trees else []
    if not others:
        return base, []
    scores = forest.score(np.array([features(text, c) for c in others], float))
    chosen = sorted((-s, c.start, -c.end, c) for s, c in zip(scores.tolist(), others)
                    if s >= forest.thresholds[c.kind])
    # A span is added if it touches neither a base span nor a better added one.
    taken = Taken((c.start, c.end) for c in base)
    added = []
    for *_, c in chosen:
        if taken.free(c.start, c.end):
            added.append(c)
            taken.add(c.start, c.end)
    return base, added


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("base", pa.bool_())]))


def find(docs: DataFrame, forest: Forest, *, text_col: str = "text", spans_col: str = "pii",
         keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all, if not given) with the spans of each text,
    by start, then kind; offsets are code points, the end exclusive."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != spans_col]
    raw = free_name("_pii_text", keep)
    source = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias(raw))

    def spans(text: str) -> list[dict]:
        base, added = detect(text, forest)
        ordered = sorted(base + added, key=lambda c: (c.start, KINDS.index(c.kind), c.end))
        return [{"kind": c.kind, "start": c.start, "end": c.end, "base": c.base} for c in ordered]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, raw):
                found = [spans(t) for t in decoded_texts(part.column(raw))]
                yield with_columns(part, [raw], {spans_col: pa.array(found, _SPANS)})

    fields = [f for f in docs.schema.fields if f.name in keep]
    return map_batches(source, run, T.StructType([*fields, T.StructField(spans_col, SPANS)]))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: str, spans: list[Candidate]) -> str:
    """A text with each span replaced by its kind; overlapping spans become one mark."""
    out, at = [], 0
    for c in sorted(spans, key=lambda c: (c.start, -c.end)):
        if c.start >= at:
            out += [text[at:c.start], f"[{c.kind}]"]
        at = max(at, c.end)
    return "".join([*out, text[at:]])

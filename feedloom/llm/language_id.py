"""Language identification by words first, then shorter and shorter character n-grams.

A known word scores the negative logarithm of its frequency in each language.
An unseen word scores the mean over its longest n-grams of which any is known
(with a mark at both ends of the word), and backs off by one character until
some are.  What a language has not seen costs a fixed penalty.  A text takes the
language with the smallest mean score over its words; ``score`` is the softmax
of the summed scores, times the share of words of which anything is known.

All counts cover every training text: words are counted in the tasks, summed by
a shuffle on the word, and n-grams are counted from the summed words.  All of
them are scored by.  The model in the workers holds the most frequent words and
n-grams, ``MAX_WORDS`` and ``MAX_GRAMS`` at most, so its size has a bound for any
corpus.  Where there are more, the other words of the documents are joined with
the stored counts, and those found nowhere with the counts of their n-grams;
what is held changes the work, not the result.

Defined cases: ``und`` with score 0 for a null text, for a text without letters,
and where nothing could be learned; a text of which nothing is known takes the
language with the most training words, with score 0; ties go to the first
language by name; rows without a language or text teach nothing; an empty
table gives no rows; other columns stay, but for those named like the new ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import decoded_texts, free_name, map_batches, slices, with_columns, written

UNKNOWN = "und"
LONGEST_GRAM = 4
MAX_WORDS, MAX_GRAMS = 100_000, 100_000
#: What a word or n-gram that a language has not seen costs, in the scores' unit.
PENALTY = 7.0
#: Distinct words that a task counts before it hands them on, whose n-grams a worker
#: keeps in mind, and of a text that are scored together.
COUNTED_WORDS, SCORED_WORDS, WORDS_AT_ONCE = 100_000, 100_000, 50_000
LETTERS, NEARLY_LETTERS = regex.compile(r"\p{L}+"), re.compile(r"[^\W\d_]+")
BEYOND = re.compile(r"[^\x00-\u052f]")


def words_of(text: str) -> list[str]:
    """The runs of letters in lower case.

    The faster pattern knows the letters of European scripts as the other does,
    but also takes numerals that are no decimal digits; a text that has some, or
    a character beyond those scripts, takes the other.
    """
    text = text.lower()
    if BEYOND.search(text) is None:
        words = NEARLY_LETTERS.findall(text)
        if not words or "".join(words).isalpha():
            return words
    return LETTERS.findall(text)


def grams_of(word: str, n: int) -> Iterator[str]:
    marked = f" {word} " if n > 1 else word
    return (marked[i:i + n] for i in range(len(marked) - n + 1))


def _counts(rows: dict[str, Counter], kind: pa.Schema) -> pa.RecordBatch:
    langs = [lang for lang, c in rows.items() for _ in c]
    return pa.RecordBatch.from_arrays([
        pa.array(langs, pa.string()), pa.array([w for c in rows.values() for w in c], pa.string()),
        pa.array([n for c in rows.values() for n in c.values()], pa.int64())], schema=kind)


_COUNTS = pa.schema([("lang", pa.string()), ("token", pa.string()), ("n", pa.int64())])


def _count(pairs: Iterator[tuple[str, list[str] | Iterator[str], int]]) -> Iterator[pa.RecordBatch]:
    """Sum (language, tokens, weight) by language and token, a bounded number at a time."""
    rows: dict[str, Counter] = {}
    for lang, tokens, weight in pairs:
        counter = rows.setdefault(lang, Counter())
        if weight == 1:
            counter.update(tokens)
        else:
            for t in tokens:
                counter[t] += weight
        if sum(map(len, rows.values())) > COUNTED_WORDS:
            yield _counts(rows, _COUNTS)
            rows = {}
    yield _counts(rows, _COUNTS)
    rows.clear()


def word_counts(train: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, token, n) over all texts; each task sends a word once per language and flush."""
    source = train.select(F.col(lang_col).cast("string").alias("lang"),
                          F.col(text_col).cast("string").cast("binary").alias("t")).where(
        "lang is not null and t is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for batch in batches:
                for part in slices(batch, "t"):
                    for lang, text in zip(part.column("lang").to_pylist(), decoded_texts(part.column("t"))):
                        yield lang, words_of(text), 1
        return _count(texts())

    return map_batches(source, run, "lang string, token string, n bigint").groupBy("token", "lang").agg(
        F.sum("n").alias("n"))


def gram_counts(words: DataFrame, longest: int) -> DataFrame:
    """(lang, token, n) of the n-grams of all counted words, one row of words each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams():
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("lang", "token", "n"))
                for lang, word, n in zip(*columns):
                    for size in range(1, longest + 1):
                        yield lang, grams_of(word, size), n
        return _count(grams())

    return map_batches(words.select("lang", "token", "n"), run, "lang string, token string, n bigint").groupBy(
        "token", "lang").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list:
    """The most frequent tokens, ``most`` of them at most, with their counts by language.

    Totals fall into classes, sixteen to a doubling; as many whole classes are
    taken from the top as fit.  So no task hands more to the driver than the
    model holds, and tokens of one class are never told apart.
    """
    level = F.floor(F.log2(F.sum("n")) * 16).alias("level")
    sizes = {r["level"]: r["count"] for r in counts.groupBy("token").agg(level).groupBy("level").count().collect()}
    lowest, held = None, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > most:
            break
        lowest = at
    if lowest is None:
        return []
    return counts.groupBy("token").agg(
        level, F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")).where(
        F.col("level") >= lowest).orderBy("token").collect()


class Model:
    """Scores of words and n-grams by language."""

    def __init__(self, langs: list[str], words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]],
                 word_totals: dict[str, int], gram_totals: dict[tuple[str, int], int], longest: int) -> None:
        self.langs, self.longest = langs, longest
        self.totals = np.array([word_totals[x] for x in langs], float)
        place = {x: i for i, x in enumerate(langs)}

        def scores(counts: dict[str, dict[str, int]], total) -> dict[str, int]:
            matrix, rows = np.full((len(counts), len(langs)), PENALTY), {}
            for i, (token, by_lang) in enumerate(counts.items()):
                rows[token] = i
                for lang, n in by_lang.items():
                    matrix[i, place[lang]] = min(PENALTY, -math.log10(n / total(lang, len(token))))
            return rows, matrix

        self.words, self.word_scores = scores(words, lambda lang, _: word_totals[lang])
        self.grams, self.gram_scores = scores(grams, lambda lang, n: gram_totals[lang, n])
        self.word_totals, self.gram_totals = word_totals, gram_totals
        self.kept: dict[str, tuple[int, ...]] = {}
        #: The stored counts of words and n-grams, where the model does not hold all of them.
        self.tables: tuple[DataFrame, DataFrame] | None = None

    def __getstate__(self) -> dict:
        """Workers do without the tables, which are the driver's."""
        return {**self.__dict__, "tables": None}

    def gram_rows(self, word: str) -> tuple[int, ...]:
        """The rows of the longest n-grams of a word of which any is known."""
        rows = self.kept.get(word)
        if rows is None:
            for n in range(self.longest, 0, -1):
                rows = tuple(r for g in grams_of(word, n) if (r := self.grams.get(g)) is not None)
                if rows:
                    break
            else:
                rows = ()
            if len(self.kept) < SCORED_WORDS:
                self.kept[word] = rows
        return rows

    def score(self, word: str) -> np.ndarray | None:
        """The scores of a word by language; none if none of its n-grams is known."""
        row = self.words.get(word)
        if row is not None:
            return self.word_scores[row]
        rows = self.gram_rows(word)
        return self.gram_scores[list(rows)].mean(axis=0) if rows else None

    def _summed(self, words: dict[str, int]) -> tuple[np.ndarray, int]:
        """The scores of all words, each as often as it occurs, and how many are known."""
        rows, times, grams, gram_times = [], [], [], []
        for word, n in words.items():
            row = self.words.get(word)
            if row is not None:
                rows.append(row)
                times.append(n)
            elif found := self.gram_rows(word):
                grams.append(found)
                gram_times.append(n)
        summed = np.array(times, float) @ self.word_scores[rows] if rows else np.zeros(len(self.langs))
        if grams:
            lengths = np.fromiter(map(len, grams), np.int64, len(grams))
            flat = np.fromiter(chain.from_iterable(grams), np.int64)
            sums = np.add.reduceat(self.gram_scores[flat], np.cumsum(lengths) - lengths, axis=0)
            summed = summed + (np.array(gram_times, float) / lengths) @ sums
        return summed, sum(times) + sum(gram_times)

    def held_part(self, text: str) -> tuple[np.ndarray, int, int, dict[str, int]]:
        """Summed scores and number of the words that are held, number of all, and the other words."""
        counts, rows, times, rest = Counter(words_of(text)), [], [], {}
        for word, n in counts.items():
            row = self.words.get(word)
            if row is None:
                rest[word] = n
            else:
                rows.append(row)
                times.append(n)
        summed = np.zeros(len(self.langs))
        for at in range(0, len(rows), WORDS_AT_ONCE):
            summed = summed + np.array(times[at:at + WORDS_AT_ONCE], float) @ self.word_scores[rows[at:at + WORDS_AT_ONCE]]
        return summed, sum(times), sum(times) + sum(rest.values()), rest

    def predict(self, text: str) -> tuple[str, float]:
        """Language and score by what is held, which is all where there are no ``tables``."""
        counts = Counter(words_of(text))
        if not self.langs or not counts:
            return UNKNOWN, 0.0
        summed, known, items = np.zeros(len(self.langs)), 0, iter(counts.items())
        while some := dict(islice(items, WORDS_AT_ONCE)):
            part, n = self._summed(some)
            summed, known = summed + part, known + n
        if not known:
            return self.langs[int(np.argmax(self.totals))], 0.0
        share = np.power(10.0, np.maximum(summed.min() - summed, -300.0))
        best = int(np.argmax(share))
        return self.langs[best], float(share[best] / share.sum() * known / sum(counts.values()))


def train(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST_GRAM,
          max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """Learn from every row of ``docs`` that has a text and a language."""
    words = written(word_counts(docs, text_col, lang_col), "words")
    grams = written(gram_counts(words, longest), "grams")
    word_totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    gram_totals = {(r["lang"], r["size"]): r["n"] for r in grams.groupBy(
        "lang", F.char_length("token").alias("size")).agg(F.sum("n").alias("n")).collect()}
    held_tokens = [{r["token"]: r["by_lang"] for r in most_frequent(c, most)}
                   for c, most in ((words, max_words), (grams, max_grams))]
    model = Model(sorted(word_totals), *held_tokens, word_totals, gram_totals, longest)
    if any(c.select("token").distinct().count() > len(h) for c, h in zip((words, grams), held_tokens)):
        model.tables = words, grams
    return model


def _vectors(counts: DataFrame, needed: DataFrame, model: Model, grams: bool) -> DataFrame:
    """(_token, s0, s1, ..): the scores by language of the ``needed`` tokens that were counted."""
    def total(lang: str) -> Column:
        if not grams:
            return F.lit(float(model.word_totals[lang]))
        sizes = [float(model.gram_totals.get((lang, n), 1)) for n in range(1, model.longest + 1)]
        return F.get(F.array(*map(F.lit, sizes)), F.char_length("_token") - 1)

    by_lang = counts.join(needed, "token", "left_semi").groupBy(F.col("token").alias("_token")).agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    # least passes over the null of a language that has not seen the token.
    return by_lang.select("_token", *[
        F.least(F.lit(PENALTY), -F.log10(F.try_element_at("by_lang", F.lit(lang)) / total(lang))).alias(f"s{i}")
        for i, lang in enumerate(model.langs)])


def _grams(word: Column, n: int) -> Column:
    """The n-grams of a word as ``grams_of`` gives them."""
    marked = F.concat(F.lit(" "), word, F.lit(" ")) if n > 1 else word
    places = F.sequence(F.lit(1), F.char_length(marked) - n + 1)
    return F.when(F.char_length(marked) >= n, F.transform(places, lambda i: F.substring(marked, i, F.lit(n))))


def scores_of(tokens: DataFrame, model: Model) -> DataFrame:
    """(_token, s0, s1, ..) of a stored table of distinct words, by the stored counts;
    words without a known n-gram have no row.

    Words back off together: those of which no n-gram of a size is known go on to the
    next shorter one.
    """
    words, grams = model.tables
    names = [f"s{i}" for i in range(len(model.langs))]
    found = [written(_vectors(words, tokens, model, False), "seen")]
    waiting = tokens.select("token")
    for n in range(model.longest, 0, -1):
        waiting = written(waiting.join(found[-1].select(F.col("_token").alias("token")), "token", "left_anti"), "waiting")
        parts = waiting.select(F.col("token").alias("word"), F.explode(_grams(F.col("token"), n)).alias("token"))
        sized = grams.where(F.char_length("token") == n)
        scored = parts.join(_vectors(sized, parts.select("token").distinct(), model, True), F.col("token") == F.col("_token"))
        found.append(written(scored.groupBy(F.col("word").alias("_of")).agg(
            *[F.avg(s).alias(s) for s in names]).withColumnRenamed("_of", "_token"), "backed"))
    return reduce(DataFrame.union, found)


def by_tables(texts: DataFrame, model: Model, shared) -> DataFrame:
    """(_t1, _t2, _pred, _score) of rows (_t1, _t2, t): two hashes stand for a text."""
    names, text = [f"s{i}" for i in range(len(model.langs))], ["_t1", "_t2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "t"):
                found = [model.held_part(t) for t in decoded_texts(part.column("t"))]
                yield with_columns(part, ["t"], {
                    "sums": pa.array([f[0].tolist() for f in found], pa.list_(pa.float64())),
                    "known": pa.array([f[1] for f in found], pa.int64()),
                    "total": pa.array([f[2] for f in found], pa.int64()),
                    "rest": pa.array([list(f[3].items()) for f in found], pa.map_(pa.string(), pa.int64()))})

    scored = written(map_batches(texts, run, "_t1 bigint, _t2 int, sums array<double>, known bigint, total bigint, "
                                             "rest map<string,bigint>").withColumn("_row", F.monotonically_increasing_id()),
                     "scored")
    tokens = written(scored.select(F.explode(F.map_keys("rest")).alias("token")).distinct(), "tokens")
    # Rows are told apart by number, copies of a text too: so the words need no shuffle by text.
    rest = scored.select("_row", F.explode("rest").alias("token", "n"))
    added = rest.join(scores_of(tokens, model), F.col("token") == F.col("_token")).groupBy(F.col("_row").alias("_of")).agg(
        F.sum("n").alias("_n"), *[F.sum(F.col("n") * F.col(s)).alias(s) for s in names])
    both = scored.select("_row", *text, "known", "total", "sums").join(added, F.col("_row") == F.col("_of"), "left").select(
        *text, "total", (F.col("known") + F.coalesce("_n", F.lit(0))).alias("known"),
        F.array(*[F.get("sums", i) + F.coalesce(s, F.lit(0.0)) for i, s in enumerate(names)]).alias("sums"))
    least, langs = F.array_min("sums"), F.array(*map(F.lit, model.langs))
    shares = F.aggregate("sums", F.lit(0.0), lambda a, x: a + F.pow(
        F.lit(10.0), F.greatest(least - x, F.lit(-300.0))))
    most = F.lit(model.langs[int(np.argmax(model.totals))])
    predicted = both.select(
        *text, F.when(F.col("total") == 0, UNKNOWN).when(F.col("known") == 0, most).otherwise(
            F.get(langs, F.array_position("sums", least).cast("int") - 1)).alias("_pred"),
        F.when(F.col("known") == 0, 0.0).otherwise(
            F.lit(1.0) / shares * F.col("known") / F.col("total")).alias("_score"))
    # Copies of a text have equal rows but for the last digits of their sums: one of each remains.
    one = predicted.groupBy(*text).agg(F.max(F.struct("_score", "_pred")).alias("_one"))
    return written(one.select(*text, "_one._pred", "_one._score"), "predicted")


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", lang_pred_col: str = "lang_pred",
            score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all, if not given) with prediction and score."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (lang_pred_col, score_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    if model.tables is not None:
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        hashes = [F.xxhash64(text).alias("_t1"), F.hash(text).alias("_t2")]
        found = by_tables(docs.select(*hashes, text.cast("binary").alias("t")), model, shared).select(
            F.col("_t1").alias("_k1"), F.col("_t2").alias("_k2"), "_pred", "_score")
        # The document travels as one struct: its names cannot clash with those of this join.
        return docs.select(F.struct(*keep).alias("_doc"), *hashes).join(
            found, (F.col("_t1") == F.col("_k1")) & (F.col("_t2") == F.col("_k2"))).select(
            *[F.col(f"_doc.`{c}`").alias(c) for c in keep],
            F.col("_pred").alias(lang_pred_col), F.col("_score").alias(score_col))
    raw = free_name("_lang_text", keep)
    source = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, raw):
                found = [model.predict(t) for t in decoded_texts(part.column(raw))]
                yield with_columns(part, [raw], {
                    lang_pred_col: pa.array([f[0] for f in found], pa.string()),
                    score_col: pa.array([f[1] for f in found], pa.float64())})
        model.kept.clear()

    fields = [f for f in docs.schema.fields if f.name in keep]
    return map_batches(source, run, T.StructType([
        *fields, T.StructField(lang_pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())]))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))

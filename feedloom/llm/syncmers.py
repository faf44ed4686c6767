"""Document fingerprints by closed syncmers.

A text is a sequence of pieces: runs of up to ``PIECE`` characters without white
space, cut anew at each word.  A k-mer is ``K`` pieces in a row, an s-mer ``S``
of them.  A k-mer is an anchor if the smallest hash among its s-mers is that of
its first or its last one.  Whether a k-mer is chosen depends on nothing outside
of it, so the same passage gives the same anchors in every document, at
positions that differ by a constant; and every K - S k-mers in a row have one.

The fingerprint is the set of anchor hashes: likeness is the share of common
ones (Jaccard), and its printed form lists the ``PRINTED`` smallest.

Everything is a column expression; texts cross the shuffle only where an edited
text needs the next document.

Defined cases: a null text is empty; a text without anchors (fewer than K
pieces, or no chosen k-mer) has one, the hash of all its pieces, so texts
without pieces are equal; documents follow (id, hash of the text), null ids
first; rows equal in id and text are one document and have equal results; the
next document of the last one is the first, of the only one itself; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import written

PIECE, K, S = 8, 5, 2
PRINTED = 16
#: Documents next to each other that one group of the ordered step holds.
RUN = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _smers(pieces: Column) -> Column:
    """The hashes of all s-mers (S is 2)."""
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
                       lambda x, i: F.xxhash64(F.get(pieces, i), x))


def _chosen(pieces: Column, smers: Column) -> Column:
    last = K - S
    edge = lambda i: F.least(F.get(smers, i), F.get(smers, i + last))
    inner = lambda i: F.least(*[F.get(smers, i + j) for j in range(1, last)])
    # s-mers 0 and 3 and piece 2 make up the five pieces of a k-mer.
    places = F.filter(F.sequence(F.lit(0), F.size(pieces) - K), lambda i: inner(i) >= edge(i))
    return F.transform(places, lambda i: F.struct(
        i.alias("pos"), F.xxhash64(F.get(smers, i), F.get(pieces, i + S), F.get(smers, i + last)).alias("hash")))


def anchors(text: Column) -> Column:
    """array<(pos, hash)>: the closed syncmers of a text in their order."""
    pieces = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S{{1,{PIECE}}}"), 0),
                         lambda x: F.xxhash64(x))

    def of(p: Column) -> Column:
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(p).alias("hash")))
        found = F.when(F.size(p) >= K, let(_smers(p), lambda m: _chosen(p, m)))
        return let(found, lambda a: F.when(F.size(a) > 0, a).otherwise(whole))

    return let(pieces, of)


def hashes(found: Column) -> Column:
    """The distinct hashes of anchors."""
    return F.array_distinct(F.transform(found, lambda a: a["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def printed(distinct: Column) -> Column:
    """The smallest hashes in hexadecimal digits.

    Only hashes below a bound that leaves about four times as many are sorted;
    where that bound leaves too few, all are.
    """
    def smallest(h: Column) -> Column:
        share = F.least(F.lit(1.0), F.lit(4.0 * PRINTED) / F.size(h))
        bound = F.lit(-2.0 ** 63) + share * F.lit(2.0 ** 64)
        low = F.filter(h, lambda x: x.cast("double") <= bound)
        few = let(low, lambda x: F.when(F.size(x) >= F.least(F.size(h), F.lit(PRINTED)), x).otherwise(h))
        return F.slice(F.sort_array(few), 1, PRINTED)

    return F.array_join(F.transform(let(distinct, smallest), lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ",")


def anchor_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, hash): a row for each anchor, to join passages by hash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.inline(anchors(F.col(text_col).cast("string"))))


def _ranked(rows: DataFrame) -> DataFrame:
    """(_h1, _h2, rank, total) of the distinct documents in their order.

    A range partitioning of the narrow keys is stored with each row's place in
    its partition; the partitions' sizes, one row each, give the offsets.
    """
    keys = rows.select("doc_id", "_h1", "_h2").distinct()
    order = [F.col("doc_id").asc_nulls_first(), "_h1", "_h2"]
    stored = written(keys.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select("_h1", "_h2", F.monotonically_increasing_id().alias("_at")), "ranks")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    w = Window.orderBy("_part")
    offsets = sizes.select("_part", (F.sum("_rows").over(w) - F.col("_rows")).alias("_offset"),
                           F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding,
                                                             Window.unboundedFollowing)).alias("total"))
    return (stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(F.col("_h1").alias("_k1"), F.col("_h2").alias("_k2"),
                    (F.col("_offset") + place).alias("rank"), "total"))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """(doc_id, text, next_text): each document beside the next one by ascending id.

    Documents are dealt into runs of ``run`` by their rank; the first of each run
    also goes to the run before, so no text is needed from anywhere else.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "*", F.xxhash64("doc_id", "text").alias("_h1"), F.hash("doc_id", "text").alias("_h2"))
    ranked = rows.join(_ranked(rows), (F.col("_h1") == F.col("_k1")) & (F.col("_h2") == F.col("_k2")))
    rank, total = F.col("rank"), F.col("total")

    def at(place: Column, in_run: Column, own: bool) -> Column:
        return F.struct(place.alias("place"), F.floor(in_run / run).alias("run"), F.lit(own).alias("own"))

    wrap = F.when(rank == 0, at(total, total - 1, False))
    before = F.when((rank > 0) & (rank % run == 0), at(rank, rank - 1, False))
    dealt = ranked.select("doc_id", "text", F.inline(F.array_compact(F.array(at(rank, rank, True), before, wrap))))
    following = Window.partitionBy("run").orderBy("place").rangeBetween(1, 1)
    return dealt.withColumn("next_text", F.first("text").over(following)).where("own").select(
        "doc_id", "text", "next_text")


def edited(text: Column, n_chars: Column, next_text: Column) -> Column:
    """The last half of the code points replaced by as many first ones of the next text."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n_chars - half), F.substring(next_text, F.lit(1), half))


def compare_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                       run: int = RUN) -> DataFrame:
    """Fingerprints of each text and its edited form, and likeness to the latter and the next text."""
    n_chars = F.char_length("text")
    texts = with_next(docs, id_col=id_col, text_col=text_col, run=run).select(
        "doc_id", "text", "next_text", n_chars.alias("n_chars"),
        edited(F.col("text"), n_chars, F.col("next_text")).alias("edited"))
    sets = texts.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        *[hashes(anchors(F.col(c))).alias(f"_{c}") for c in ("text", "edited", "next_text")])
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("_text")).alias("fingerprint"),
        printed(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_text"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_text"), F.col("_next_text")).alias("near_next"))

"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has 64 bits.  Bit i is set if it is set in more than half of the
hashes of the text's word shingles.  Two fingerprints are linked if they differ
in at most ``BITS`` = 3 bits.

Three bits touch three bytes at most, so linked fingerprints share at least
5 of 8 positional bytes.  A posting list per (position, byte value) alone would
hold 1/256 of all fingerprints; tallying over such lists is quadratic.  The
lists are intersected first: each fingerprint is posted under every set of five
positions with its bytes there (56 keys of 40 bits), and a pair meets exactly if
it reaches the guaranteed minimum count.  The shared bytes of each pair are
tallied, and the pair is verified by its differing bits.

Equal fingerprints are one entry.  A key with more than ``PAIR_LIMIT`` entries
makes no pairs.  Its fingerprints take an exact way whose cost grows with their
number only: each gives the points within two bits of it, and the points within
one bit.  Two fingerprints are within three bits if and only if a point is
within two bits of one and one bit of the other, so at each point with
fingerprints within one bit, all fingerprints within two bits are linked to the
smallest of the former.  These are links, and they connect what is linked.

Defined cases: a null text is empty; a text without words has fingerprint zero
and is linked like any other; fewer words than a shingle make one hash; a null
id never names a component unless the component has no other; repeated rows are
linked and stay; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import map_batches, slices, written
from feedloom.llm.graph import components

WORDS, SEED, BITS = 3, 42, 3
SHARED = 8 - BITS
PAIR_LIMIT = 256
HASHES_AT_ONCE = 65_536


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of a text in UTF-8, unsigned.

    Both bytes.lower and bytes.split know ASCII only: A-Z, and the white space
    of the contract.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.dtype("<u8"))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[at:at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit integer."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t"):
                fps = np.array([fingerprint(t or b"", words) for t in part.column("t").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps.view(np.int64))],
                                                 ["doc_id", "fp"])

    kind = dict(source.dtypes)["doc_id"]
    return map_batches(source, run, f"doc_id {kind}, fp bigint")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _key(fp: Column, n: int, positions: tuple[int, ...]) -> Column:
    """The bytes at some positions, under the number of the position set."""
    key = F.lit(n).cast("bigint")
    for p in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, p))
    return key


def tally(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    same = [F.when(_byte(a, p) == _byte(b, p), 1).otherwise(0) for p in range(8)]
    return sum(same[1:], same[0])


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _flipped(points: Column, above: bool) -> Column:
    """Each (point, highest flipped bit) with one more bit flipped, higher ones only."""
    def flips(x: Column) -> Column:
        bits = F.filter(F.array(*[F.lit(i) for i in range(64)]), lambda i: i > x["top"])
        return F.transform(bits, lambda i: F.struct(
            x["z"].bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).alias("z"), i.alias("top")))
    return F.flatten(F.transform(points, flips)) if above else points


def ball(fp: Column, radius: int) -> Column:
    """All points within ``radius`` bits."""
    ring = F.array(F.struct(fp.alias("z"), F.lit(-1).alias("top")))
    rings = [ring]
    for _ in range(radius):
        ring = _flipped(ring, True)
        rings.append(ring)
    return F.transform(F.concat(*rings), lambda x: x["z"])


def dense_links(fps: DataFrame) -> DataFrame:
    """Links that connect all fingerprints within three bits of each other,
    without pairs: 2146 points for each fingerprint, whatever their number."""
    centers = fps.select("fp", F.explode(ball(F.col("fp"), 1)).alias("z")).groupBy("z").agg(
        F.min("fp").alias("center"))
    members = fps.select("fp", F.explode(ball(F.col("fp"), 2)).alias("_z"))
    return (members.join(centers, F.col("_z") == F.col("z")).where("fp <> center")
            .select(F.col("fp").alias("u"), F.col("center").alias("v")).distinct())


def links(fps: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(u, v) links between distinct fingerprints, enough to connect every pair
    within ``BITS`` bits.  ``fps`` is a stored table of distinct ``fp``."""
    sets = list(combinations(range(8), SHARED))
    posted = fps.select("fp", F.explode(F.array(*[
        _key(F.col("fp"), n, s) for n, s in enumerate(sets)])).alias("key"))
    met = written(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select(F.col("key").alias("_key"), "n"), "keys")
    shared = written(posted.join(met, F.col("key") == F.col("_key")).select("key", "fp", "n"), "postings")
    few = shared.where(F.col("n") <= pair_limit)
    other = few.select(F.col("key").alias("_key"), F.col("fp").alias("v"))
    pairs = (few.join(other, (F.col("key") == F.col("_key")) & (F.col("fp") < F.col("v")))
             .where(tally(F.col("fp"), F.col("v")) >= SHARED)
             .where(distance(F.col("fp"), F.col("v")) <= BITS)
             .select(F.col("fp").alias("u"), "v").distinct())
    crowded = shared.where(F.col("n") > pair_limit).select("fp").distinct()
    return pairs.union(dense_links(crowded))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest id reachable."""
    printed = written(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    classes = written(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), pair_limit))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.join(named.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_fp"), "component_id")
    return printed.join(of_class, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def printed_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

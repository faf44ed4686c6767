"""Cross-site boilerplate: remove lines that occur on many distinct sites.

A line's spread is the number of distinct sites with a document that has it.
One HyperLogLog sketch of sites per line hash is built in every task and merged
by the aggregation, so a line found everywhere crosses the shuffle as one sketch
per task.  Lines whose estimate is near the threshold get an exact distinct
count; the others are decided by their estimate, which is more than ``SIGMAS``
standard errors (and more than one site) away from the threshold.

A line is compared without white space at its ends; blank lines are not counted
and stay.  A document of which no other line would be left keeps its text: it is
a copy rather than a page around which boilerplate stands.

Defined cases: a null text stays null and has no lines; a null site is one site;
a line repeated within a document is removed each time; rows with equal id and
text have equal results; an empty table gives no rows; other columns, also ones
named like those that are added, are not looked at and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import written

MIN_SITES = 10
LG_K, SIGMAS = 12, 5
BLANKS = " \t\r\x0b\x0c"
#: The two hashes, 96 bits together, that stand for a line or a row.
LINE, ROW = ("_l1", "_l2"), ("_r1", "_r2")


def _hashes(names: tuple[str, str], *columns: Column | str) -> list[Column]:
    return [F.xxhash64(*columns).alias(names[0]), F.hash(*columns).alias(names[1])]


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """A narrow row for each non-blank line: its row's and its own hashes, place and site."""
    exploded = docs.select(*_hashes(ROW, id_col, text_col),
                           F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("_site"),
                           F.posexplode(F.split(text_col, "\n", -1)).alias("_pos", "_line"))
    bare = exploded.select(*ROW, "_site", "_pos", _bare(F.col("_line")).alias("_line")).where("_line <> ''")
    return bare.select(*ROW, "_site", "_pos", *_hashes(LINE, "_line"))


def widespread(lines: DataFrame, min_sites: int) -> DataFrame:
    """The hashes of the lines on at least ``min_sites`` distinct sites."""
    margin = max(1.0, SIGMAS * 1.04 / 2 ** (LG_K / 2) * min_sites)
    # Few lines are on many sites; a table of them keeps later joins apart from this shuffle.
    spread = written(lines.groupBy(*LINE).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("_sites")).where(
        F.col("_sites") >= min_sites - margin), "spread")
    sure = spread.where(F.col("_sites") > min_sites + margin).select(*LINE)
    near = spread.where(F.col("_sites") <= min_sites + margin).select(*LINE)
    # One row for each line and site before the join, so no line is frequent in it.
    counted = (lines.groupBy(*LINE, "_site").agg(F.lit(1).alias("_one"))
               .join(near, list(LINE), "left_semi")
               .groupBy(*LINE).agg(F.count("_one").alias("_sites"))
               .where(F.col("_sites") >= min_sites).select(*LINE))
    return written(sure.union(counted), "boilerplate")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES, added: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text, and the counts of
    each text's lines and removed lines."""
    lines = written(occurrences(docs, id_col, text_col, site_col), "lines")
    boilerplate = widespread(lines, min_sites)
    marked = lines.join(boilerplate, list(LINE)).groupBy(*ROW).agg(
        F.sort_array(F.collect_set("_pos")).alias("_marks"))
    # The document travels as one struct: its names cannot clash with those of this join.
    cut = docs.select(F.struct(*docs.columns).alias("_doc"), *_hashes(ROW, id_col, text_col)).join(
        marked, list(ROW), "left")
    old = F.col(f"_doc.{text_col}")
    parts = F.split(old, "\n", -1)
    n_content = F.size(F.filter(parts, lambda x: _bare(x) != ""))
    removes = F.col("_marks").isNotNull() & (F.size("_marks") < n_content)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_marks"))
    text = F.when(removes, F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")).otherwise(old)
    return cut.select(
        *[(text if c == text_col else F.col(f"_doc.{c}")).alias(c) for c in docs.columns if c not in added],
        F.when(old.isNull(), 0).otherwise(F.size(parts)).alias(added[0]),
        F.when(removes, F.size("_marks")).otherwise(0).alias(added[1]))

"""A training corpus from documents: five stages, each over all that the one before kept.

* language: documents without a recognised language go
* line_dedup: lines found on many sites go, texts and their lengths change
* near_dedup: of each group of linked fingerprints the document with the smallest id stays
* decontamination: documents that contain a benchmark item go
* tokens: texts become token ids, which are decoded again and compared

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``docs``, extra ones included.  Columns that a stage adds
for its own use have names that begin with ``_stage_``.

Defined cases: null texts go in the first stage, as do texts without letters;
rows without an id are documents like any other; repeated rows are near
duplicates; empty tables give no rows; an empty benchmark removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import bpe, decontaminate, language_id, line_dedup, simhash
from feedloom.llm.common import written

#: A text whose best language has a smaller share than this is not recognised.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.predict(docs, model, lang_pred_col="_stage_lang", score_col="_stage_score")
    return found.where((F.col("_stage_lang") != language_id.UNKNOWN) & (F.col("_stage_score") >= MIN_SCORE)
                       ).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs, added=("_stage_lines", "_stage_removed"))
    kind = dict(docs.dtypes)["n_chars"]
    return cut.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Stored row numbers tell repeated rows apart; known ids come before unknown ones.
    rows = written(docs.withColumn("_stage_row", F.monotonically_increasing_id()), "rows")
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"),
                   F.col("_stage_row").alias("row"))
    linked = simhash.near_duplicates(rows.select(key.alias("_stage_id"), "text"), id_col="_stage_id")
    stay = linked.where(F.col("doc_id.row") == F.col("component_id.row")).select(
        F.col("doc_id.row").alias("_stage_row"))
    return rows.join(stay, "_stage_row", "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find(docs, benchmark, hits_col="_stage_hits")
    return found.where(F.size("_stage_hits") == 0).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode(docs.select("doc_id", "source", "lang", "text"), offsets=False, decoded_col="decoded")
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("decoded bytes differ from the text")))
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("bigint").alias("n_tokens"),
                        ids.alias("ids"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("tokens", tokens)]

#: Models, fingerprints and tokens are not for SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is stored and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

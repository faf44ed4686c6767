"""The operators of this package as queries over the whole given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (alignment, bpe, chat, decontaminate, language_id, line_dedup, packing, pii, runs,
                          sharding, simhash, syncmers, warc)
from feedloom.llm.common import table
from feedloom.session import shared_dir

SHARDS = 24


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return sharding.shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    model = language_id.train(docs.where(~language_id.held_out()).select("text", "lang"))
    return language_id.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op3_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = pii.find(docs, pii.fit(docs.select("text")), keep=["doc_id"])
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
                        pii.joined(F.col("pii")).alias("spans"))


def op4_chat_rotation(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    spans = F.array_join(F.transform("loss_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return chat.rotate(turns).select("conv_id", "participant", "part", "n_turns", "n_own_turns",
                                     "offset", "text", spans.alias("loss_spans"))


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return token_digests(docs)


def token_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and digest both."""
    coded = bpe.encode(docs, offsets=False, decoded_col="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.compare_with_edits(table(spark, sf, "documents", "doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    items = table(spark, sf, "benchmark", "item_id", "text")
    hit = decontaminate.find(docs, items, keep=["doc_id"]).select("doc_id", F.explode("hits").alias("hit"))
    spans = F.array_join(F.transform("hit.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return hit.select("doc_id", "hit.item_id", "hit.coverage", "hit.longest",
                      F.size("hit.spans").alias("n_tiles"), spans.alias("spans"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    warc.write(table(spark, sf, "pages", "page_id", "url", "html"), folder)
    # Bytes and digest are those of the original put together again: a response's block
    # is cut from its record, a revisit takes the payload of the record it refers to.
    whole = F.when(F.col("record_type") == "response", warc.block_of(F.col("record"))).otherwise(F.col("payload"))
    return warc.read(spark, folder).select(
        F.col("record_id").cast("bigint").alias("page_id"),
        F.octet_length(whole).cast("bigint").alias("payload_bytes"), F.sha2(whole, 256).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.printed_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = runs.find_runs(docs.select("doc_id", runs.with_repeats().alias("text")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listed(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.alignment(table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_language_id, op3_pii, op4_chat_rotation, op5_bpe, op6_syncmers,
        op7_decontamination, op8_line_dedup, op9_warc, op10_simhash, op11_runs,
        op12_packing, op13_alignment)}

ORACLES: dict[str, str] = {
    "op4_chat_rotation": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS said,
    ((row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
        coalesce(text, '')) - 1) // 1024)::INT AS part
  FROM conversations),
v AS (SELECT DISTINCT conv_id, role AS participant FROM t),
s AS (
  SELECT t.conv_id, participant, turn, role, said, part, role = participant AS own,
    CASE WHEN role = participant THEN '<|assistant|>' || chr(10)
         ELSE '<|user name=' || role || '|>' || chr(10) END AS opening
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
g AS (SELECT *, opening || said || '<|end|>' || chr(10) AS segment FROM s),
p AS (
  SELECT *, sum(length(segment)) OVER w - length(segment) AS at_, row_number() OVER w AS nth
  FROM g WINDOW w AS (PARTITION BY conv_id, participant, part
                      ORDER BY turn NULLS FIRST, role, said ROWS UNBOUNDED PRECEDING)),
a AS (
  SELECT conv_id, participant, part, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_own_turns,
    sum(length(segment)) AS n_chars, string_agg(segment, '' ORDER BY nth) AS text,
    coalesce(string_agg(CASE WHEN own THEN (at_ + length(opening))::BIGINT || ':'
        || (at_ + length(segment) - 1)::BIGINT END, ',' ORDER BY nth), '') AS loss_spans
  FROM p GROUP BY conv_id, participant, part)
SELECT conv_id, participant, part, n_turns, n_own_turns,
  (sum(n_chars) OVER (PARTITION BY conv_id, participant ORDER BY part) - n_chars)::BIGINT AS "offset",
  text, loss_spans
FROM a""",
    "op8_line_dedup": """
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
b AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
w AS (SELECT bare FROM b WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 10),
m AS (SELECT doc_id, pos, line, bare, w.bare IS NOT NULL AS wide FROM b LEFT JOIN w USING (bare)),
d AS (
  SELECT doc_id, count(*)::INT AS n_lines, (count(*) FILTER (WHERE wide))::INT AS n_wide,
    count(*) FILTER (WHERE bare <> '') AS n_content,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT wide), '') AS left_over
  FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines,
  CASE WHEN n_wide < n_content THEN n_wide ELSE 0 END AS n_removed,
  CASE WHEN n_wide < n_content THEN left_over ELSE text END AS text
FROM documents LEFT JOIN d USING (doc_id)""",
    "op9_warc": """
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM (SELECT *, strlen(payload) >= 100 AND page_id <> first AS again
      FROM (SELECT page_id, coalesce(html, '') AS payload,
              min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))""",
}

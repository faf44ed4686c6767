"""The pipeline against plain versions of its stages, and its defined cases."""

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from feedloom.llm import bpe, decontaminate, language_id, line_dedup, simhash
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint, signed


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))


def plain_run(rows, items, model):
    """{doc_id: token ids} of rows (doc_id, text, source) with distinct ids."""
    kept = [r for r in rows if (p := model.predict(r[1] or ""))[0] != "und" and p[1] >= 0.5]
    site = {d: s for d, _, s in kept}
    kept = [(d, t, site[d]) for d, t, *_ in plain_lines(kept, line_dedup.MIN_SITES)]
    fps = {d: signed(plain_fingerprint(t)) for d, t, _ in kept}
    roots, first = plain_components(set(fps.values())), {}
    for d in sorted(fps):
        first.setdefault(roots[fps[d]], d)
    kept = [r for r in kept if first[roots[fps[r[0]]]] == r[0]]
    index = decontaminate.Items(items, decontaminate.MIN_MATCH)
    coder = reference()
    return {d: coder.encode_ordinary(t) for d, t, _ in kept if not index.hits(t, decontaminate.MIN_COVERAGE)}


def test_run_against_plain_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = plain_run(rows, items, language_id.train(docs.where(~language_id.held_out())))
    got = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"]: r["ids"] for r in got.collect()} == want
    assert 0.3 * len(rows) < len(want) < len(rows)


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of few rows: nulls, repeats, copies, an extra column, a contaminated text."""
    item = "one two three four five six seven eight nine ten"
    text = "the cat sat on the mat and looked at the dog for a long while before it left the house again"
    docs = [(1, text, "en", "a"), (1, text, "en", "a"), (None, text, "en", None), (None, "le chat est dans la maison", "fr", "b"),
            (2, f"here it is: {item}. And it ends", "en", "b"), (3, None, "en", "c"), (4, "", None, "c"), (5, "123 456", "en", "c"),
            (6, "another text in the language of the others " * 2000, "en", "d"), (7, text.upper(), None, "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.char_length("text").cast("bigint")).withColumn("ids", F.lit("own")).withColumn("hits", F.lit(1))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_keep_columns_and_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    after = sorted((r["doc_id"] for r in corpus_pipeline.language(spark, docs, folder).collect()), key=str)
    assert after == [1, 1, 2, 6, 7, None, None]
    assert sorted((r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()), key=str) == [1, 6, None]


def test_lines_change_text_and_length(spark):
    rows = [(i, f"own words {i}\nshared line", "en", f"s{i}", 5) for i in range(line_dedup.MIN_SITES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.line_dedup_stage(spark, docs, "").orderBy("doc_id").collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [(f"own words {i}", 11) for i in range(line_dedup.MIN_SITES)]


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    rest = corpus_pipeline.decontamination(spark, spark.read.parquet(f"{folder}/documents.parquet"), f"{tmp_path}/none")
    assert rest.count() == 10

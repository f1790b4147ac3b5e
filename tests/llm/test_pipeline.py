"""The pipeline stage by stage against plain code."""

import re

import pytest
from pyspark.sql import functions as F

from test_jaccard import brute_components

import corpus_pipeline
from rowloom.llm import mixing, quality


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 90").withColumn("name", F.lit("clash"))
    docs = docs.union(docs.limit(3)).union(docs.limit(1).withColumns({"text": F.lit(None).cast("string"), "doc_id": F.lit(-1).cast("long")}))
    out, folder = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], "/root/testdata/sf0.001").write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns(stages):
    for df in stages[1:5]:
        assert df.columns == stages[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "source_mix", "encoding"]


def test_decisions_take_effect(stages):
    docs, good, unique, apart, mixed, encoded = stages
    # Judged rows are collected whole: a filter on them is pushed down with every count written out in it.
    verdict = quality.judge(quality.measures(docs, ["doc_id", "text"])).select("doc_id", "text", "kept").collect()
    assert rows(good) == sorted((r.doc_id, r.text) for r in verdict if r.kept)
    best = {}
    for d, t in rows(good):
        k = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[k] = min(best.get(k, (0, 0, "")), (-len(t), d, t)) if k in best else (-len(t), d, t)
    assert rows(unique) == sorted((d, t) for _, d, t in best.values())
    linked = brute_components(rows(unique), 5, 80)
    assert sorted(d or -1 for d, _ in rows(apart)) == sorted({c for _, _, c in linked})
    copies = {r.doc_id: r.copies for r in mixing.mix(apart).collect()}
    assert rows(mixed) == sorted(r for r in rows(apart) for _ in range(copies[r[0]]))
    assert encoded.count() == mixed.count()


def test_encoding(stages):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = dict(rows(stages[4]))
    for r in stages[5].collect():
        assert list(r.ids) == library.encode(text[r.doc_id])


def test_run_over_an_empty_table(spark, stages, tmp_path):
    stages[0].limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()


def test_run_over_the_whole_table(spark):
    """The last rows against the library and plain code, source included."""
    import public_tokenizers
    import sentencepiece

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    verdict = quality.judge(quality.measures(docs, ["doc_id", "text", "source"])).select("doc_id", "text", "source", "kept").collect()
    good = [(r.doc_id, r.text) for r in verdict if r.kept]
    best = {}
    for d, t in good:
        k = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[k] = min(best.get(k, (0, 0, "")), (-len(t), d, t)) if k in best else (-len(t), d, t)
    unique = sorted((d, t) for _, d, t in best.values())
    # One more, as the plain code takes a document 0 for one without an id.
    apart = {c - 1 for _, _, c in brute_components([(d + 1, t) for d, t in unique], 5, 80)}
    copies = {r.doc_id: r.copies for r in mixing.mix(docs.where(F.col("doc_id").isin(*apart))).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    given = {r.doc_id: (r.text, r.source) for r in verdict}
    want = sorted((d, given[d][1] or "", library.encode(given[d][0])) for d in apart for _ in range(copies[d]))
    assert sorted((r.doc_id, r.source or "", list(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()) == want

"""A corpus, cleaned and mixed for training: quality rules, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs.  All but the last return the columns of
documents.

Empty and null texts fail the quality rules, so no later stage sees them; repeated rows
are one document after exact dedup; the mix may hold a document twice, and the last stage
then gives two rows.  An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import jaccard, mixing, naming, pieces, quality
from rowloom.llm.common import documents
from rowloom.session import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return naming.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 on five-word shingles."""
    return jaccard.keep_one(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the entropy-balanced mix takes them."""
    return mixing.repeat_rows(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and digests of ids and decoded text."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_documents(docs, model, keep_ids=True, carry=["source"]).drop("decoded")


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("source_mix", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL has neither the component search at this size nor the piece encoding; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The training-data pipeline over ``documents``: quality classifier, language
identification, exact dedup, MinHash near-dedup, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emporia.llm import exact_dedup, language_id, minhash_dedup, packing, quality
from emporia.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled ones, rejects go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go; the filters are fitted
    on a bounded sample of the rows with a language."""
    return language_id.keep_identified(docs, language_id.fit_languages(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five-word
    shingles the one with the smallest identifier stays."""
    return minhash_dedup.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("minhash_dedup", minhash_stage),
    ("packing", packing_stage),
]

#: Learned scores and tokenizer ids are beyond SQL; tests/llm/test_pipeline.py
#: holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as
    Parquet in the shared folder and reread as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: quality classifier, quality rules, line dedup, near-dedup, packing.

Each stage takes what the one before kept, as a table of documents, and calls
one operator of :mod:`tillroll.llm`.  The classifier is fitted on the labels of
``sf_dir``, on the documents that reach the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import classifier, line_dedup, minhash, packing, quality_rules
from tillroll.llm.common import table
from tillroll.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees score 0.7 or more."""
    return classifier.keep_quality(docs, classifier.fit_quality(docs, table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality_rules.clean_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of three consecutive lines."""
    return line_dedup.dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8)."""
    return minhash.keep_one(docs, words=5)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality_classifier), ("quality rules", rules), ("line dedup", lines),
          ("MinHash near-dedup", near_dedup), ("packing", pack)]

# The classifier's trees and the tokenizer have no SQL form; the pipeline is
# tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents pass the stages in turn; each stage's decisions take effect on its input.

Every stage but the last returns the columns of ``documents``. A stage's result is written and read again as the
next one's input, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import decontam, langid, packing, simhash, toxicity
from vigil.llm.common import read, table
from vigil.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of the model's with enough certainty; texts without letters go."""
    return langid.keep_identified(docs, langid.fit(docs))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Stages rest on trained models, fingerprints and a tokenizer, which SQL cannot express; tests hold them to brute
#: force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = table(docs, name)
    return docs

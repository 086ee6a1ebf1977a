"""Corpus pipeline: from raw documents to token records in training order.

Five stages, each one operator of ``ferrule.llm`` with its production parameters:

1. ``quality``     documents that the classifier (10) rejects go;
2. ``near_dedup``  one document of each near-duplicate class (4) stays, the least id;
3. ``decontam``    documents with a benchmark passage or its re-parameterised twin (6) go;
4. ``mix``         every document as often as the mix to target weights (8) takes it;
5. ``tokens``      token records in training order, written as shard files (1).

A stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of
``documents``.  ``run`` applies them one after another; each stage's rows are written to
the shared folder as Parquet and read again, so an executor lost later costs nothing
that came before, and every stage is planned on what its predecessor really kept.

SQL cannot express the classifier, the template matching or the tokenizer; the tests
hold the stages against brute-force versions (``ORACLE_SQL`` is None).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferrule.llm import common, decontamination, mixing, near_dedup, quality, tokens


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return near_dedup.keep_one(docs)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return decontamination.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.ship(spark)
    return tokens.training_shards(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontam", decontam_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the places of the token records that the last one writes."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

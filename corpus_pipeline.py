"""Corpus pipeline over ``documents``: drop poor texts, exact copies and near copies, mask secrets, pack.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a frame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

In every stage a null text counts as empty, rows that repeat a doc_id stay or go together, other columns may have any
name, and an empty table stays empty. A row with a null doc_id is scored, masked and packed like others (its pieces
have a null doc_id); the two stages that drop copies keep it, since it can be neither the smallest of a group nor named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import _common, exact, packing, quality, secrets, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (fitted on the labels of ``sf_dir`` outside the held-out fifth) accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to white space) the row with the smallest doc_id."""
    return exact.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id."""
    return simhash.keep_first(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in ``text`` replaced by a mark; n_chars follows where a text changes."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids, mixed by source."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage), ("secrets", secret_stage), ("packing", packing_stage)]

#: SQL cannot express the classifier, SimHash or the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = _common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

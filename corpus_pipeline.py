"""From documents to packed sequences: five stages, each written and reread.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
Labels for the classifier come from ``labels`` in ``sf_dir``. A stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import classifier, common, exactdedup, mixing, neardup, packing
from pairloom.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    model = classifier.learn(docs, common.table(spark, sf_dir, "labels"))
    return classifier.score(docs.select(*COLUMNS), model).filter(F.col("score") >= classifier.THRESHOLD).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every text."""
    index = exactdedup.DigestIndex(spark, f"pipeline_digests_{uuid.uuid4().hex}")
    rows = exactdedup.new_rows(index, docs.select(*COLUMNS), "documents")
    spark.sql(f"DROP TABLE {index.name}")
    return rows


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five words, 80 percent)."""
    return neardup.without_near_duplicates(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document taken repeatedly is there repeatedly."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 4096."""
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"), end_id=2, digests=True)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("packing", packed)]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus out of ``documents``: good, distinct, clean of benchmark passages, and packed.

Each stage takes the documents that its predecessor kept, with the columns of ``documents`` (and any further
ones), and the last one returns pieces of packed sequences. Null and empty texts, repeated rows and null
ids are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showloom.llm import jaccard, leaks, packing, quality, suffixes
from showloom.llm.common import stored
from showloom.llm.queries import END_ID, table, tokenizer_path, training_fold


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more, learnt from the labels that ``op5`` may learn from."""
    labels = table(spark, sf_dir, "labels").filter(training_fold(F.col("doc_id")))
    weights = quality.train(table(spark, sf_dir, "documents"), labels)
    return quality.accepted(docs, weights)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return jaccard.one_of_each(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that an earlier one has."""
    return suffixes.without_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality", good), ("near_duplicates", distinct), ("repeats", without_copies),
    ("decontamination", decontaminated), ("packing", packed),
]
#: SQL cannot score, tokenize or pack; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

"""From raw documents to packed training sequences, as stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. ``run`` writes each stage's rows as Parquet to the shared folder and reads them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from llm import jaccard, langid, packing, pii, toxicity
from llm.tables import read, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under its threshold; it learns from all labels of the corpus."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a language's centroids."""
    return langid.without_rejected(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked documents; all rows without words."""
    return jaccard.without_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return pii.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_languages),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: No SQL says a learnt model or a tokenizer; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, docs = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

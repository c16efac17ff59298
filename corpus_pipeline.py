"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import decontamination, mixing, near_dedup, quality
from tillwright.llm.queries import table, written_and_read
from tillwright.session import shared_folder

QUALITY = 0.3


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that were cut."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones of these, does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_scores(docs, model, "_score").filter(F.col("_score") >= QUALITY).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8)."""
    return near_dedup.deduplicate(docs)


def decontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: these are cut, or the document goes if they are more than half of it."""
    return _counted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights; a document can come twice, and in passages."""
    return _counted(mixing.mixed_documents(docs))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files, and for each document where it lies."""
    return written_and_read(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("minhash near-dedup", distinct_documents),
    ("benchmark decontamination", decontaminated_documents),
    ("source mixing", mixed_documents),
    ("token id files", token_files),
]

# The classifier, the hashes behind the mix and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)

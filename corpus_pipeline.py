"""A corpus pipeline over ``documents``: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontamination, line_dedup, minhash_dedup, mixing, toxicity
from salesmart.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds to be toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go; a document left without any text stays as an empty one. n_chars stays that of the source."""
    return line_dedup.dedup_lines(docs).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity of 0.8 or more."""
    return minhash_dedup.keep_one_of_each(docs).select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows chosen to meet the target weights; ``epoch`` tells repeated rows apart."""
    return mixing.mix_documents(docs.select(COLUMNS)).select(*COLUMNS, "n_tokens", "epoch")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("minhash_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The first stage applies a trained model, which SQL cannot state; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: stages over ``documents``, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from antecede.llm import byte_bpe, line_dedup, mixing, quality_crf, simhash
from antecede.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.classify(docs, labels).where("__predicted = 1").select(*docs.columns)


def frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go from all of them."""
    return line_dedup.drop_lines(docs, min_docs=10, min_chars=1).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return simhash.first_of_each(docs, words=4, max_distance=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(mixing.mix(docs, weights=(3, 1, 2), share=1.5, limit=2.0))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, and digests of ids and decoded bytes."""
    return byte_bpe.digests(docs, byte_bpe.public_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality_crf", good_documents),
    ("line_dedup", frequent_lines),
    ("simhash_near_dedup", near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", encoded),
]

#: No stage but line dedup can be written as SQL; the stages are held against plain versions in tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        at = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabaudit.llm import exact_dedup, mixing, ngram_join, packing, quality
from tabaudit.llm.queries import MIX_MOST, MIX_SHARE, MIX_WEIGHTS, earlier, table
from tabaudit.session import fresh_path, scratch, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.without_poor(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs, earlier(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join: five-word shingles, similarity 0.8 or more."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixture(docs, MIX_SHARE, MIX_MOST, mixing.repeating(MIX_WEIGHTS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, dealt into sequences, with their token ids."""
    return packing.pack(docs)


def _lean(stage: Stage) -> Stage:
    """The stage with small batches between the JVM and its workers, which share an executor's memory."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", _lean(accept_quality)),
    ("exact dedup", _lean(drop_exact_copies)),
    ("n-gram Jaccard join", _lean(drop_near_copies)),
    ("mixing sources", _lean(mix_sources)),
    ("packing", _lean(pack_sequences)),
]

#: The classifier, the random rounding and the tokenizer can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = fresh_path(spark)
        with scratch(spark):  # what a stage writes on its way goes when its output is there
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

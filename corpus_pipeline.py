"""The corpus pipeline: low-quality documents go, one of each group of near
copies stays, repeated passages are cut out, the sources are mixed to their
target weights and the documents packed into sequences, which take their turns
in the order of the mix.

Each stage takes what its predecessor kept, written as Parquet and reread; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contract_lake.llm import mixing, packing, quality, simhash, suffixes, tokens
from contract_lake.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=4, max_bits=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.dedup_texts(docs, window=200)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, tokens.default_vocabulary(), capacity=2048, order=mixing.place())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]
#: The trained scorer, byte-level cuts and the packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

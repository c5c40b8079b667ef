"""A training-corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; all but the last return the columns of
``documents``. Stages are written as Parquet under the shared folder and read back, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, ngram_join, packing, quality_rules, substring_dedup
from tidemark.llm.queries import table, tokenizer_path
from tidemark.scratch import materialize

#: Session settings that bound what a task holds of its rows at once, on their way to Python and as decoded from Parquet. At Spark's own
#: 64 MB and 4,096 rows, texts lie in each task, in each worker and in what allocators keep of both, over all stages of a run.
LIGHT = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def light(stage: Stage) -> Stage:
    """``stage`` in a session with ``LIGHT``, but for what the session already sets; it stays, since results are read later."""

    @wraps(stage)
    def run_light(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        given = spark.conf.getAll
        for key, value in LIGHT.items():
            if key not in given:
                spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run_light


@light
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return quality_rules.accepted(docs)


@light
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; texts without words are no copies of each other."""
    return ngram_join.one_of_each(docs)


@light
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without sentences of passages that an earlier one has."""
    return substring_dedup.dedup(docs)


@light
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; documents that are mostly such go as a whole."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@light
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths."""
    return packing.pieces(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality), ("ngram_join", near_duplicates), ("substring_dedup", repeated_passages),
    ("decontaminate", benchmark_passages), ("packing", packed),
]
#: Fingerprint joins, automata and tokenizers can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline: language, exact copies, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared
folder and reads it again as the next stage's docs; what a stage wrote besides is removed. All but the last return the columns of docs.

Stages set the session's batch limits (BATCHES), which hold when their results are read, and leave them set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, language_id, mixing, ngram_join, packing
from tidemark.llm.shared import clear, stash, table, written

#: Least score of a document's language: it outweighs all other languages together. Texts mixed of several, and junk
#: that resembles none, score less.
LEAST_SCORE = 0.5
#: Bytes that a task hands to Python at a time, and rows that it reads of a file at a time. Rows are whole texts: with Spark's
#: own limits, 64 MB and 4096 rows, the batches of two tasks took hundreds of MB beside the heap, and made it grow.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.parquet.columnarReaderBatchSize": "512"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage, in batches of the limited size."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run


@bounded
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that one language fits: a null text, one without a letter, and one under LEAST_SCORE go.

    Without any label to learn from there is no score, and all texts that have a letter stay.
    """
    return language_id.keep_known(docs, least=LEAST_SCORE)


@bounded
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact(docs)


@bounded
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 or more."""
    return ngram_join.keep_one(docs, k=5, num=80, den=100)


@bounded
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, whole, in part or twice, as the sources' targets ask."""
    return mixing.mixed(docs)


@bounded
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents."""
    return packing.pack(docs)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixture", mixture), ("packing", packed)]

#: SQL can express neither the kernel classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents"), written()
    for _, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir))
        clear(spark, mark, docs)
    return docs

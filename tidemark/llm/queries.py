"""The queries of this subpackage and the SQL that some of them can be compared with."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import backoff, chat_format, decontaminate, exact_dedup, language_id, merkle, mixing, mixing_sql, ngram_join, packing, secret_scan, tandem, url_filter, vector_join
from tidemark.llm.shared import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(table(spark, sf_dir, "conversations"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score(table(spark, sf_dir, "documents"))


def op3_lm_score_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model, every pair among its counts, by the joins that take any corpus."""
    docs = table(spark, sf_dir, "documents")
    return backoff.score(docs, corpus=docs)


def op3_lm_score_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With pairs that occur once left out of the model: they back off."""
    return backoff.score(table(spark, sf_dir, "documents"), least=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.link_vectors(table(spark, sf_dir, "embeddings"), least=0.93)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tandem.periodic(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_chat_format, op2_exact_dedup, op3_lm_score, op4_language_id, op5_embedding_join, op6_mixing, op7_ngram_jaccard, op8_secret_scan, op9_packing,
        op10_url_filter, op11_periodic_runs, op12_merkle_manifest, op13_decontamination, pipeline, op3_lm_score_all, op3_lm_score_cutoff,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, "op3_lm_score": backoff.ORACLE_ALL, "op3_lm_score_all": backoff.ORACLE_ALL, "op3_lm_score_cutoff": backoff.ORACLE, "op6_mixing": mixing_sql.ORACLE, "op5_embedding_join": vector_join.ORACLE, "op7_ngram_jaccard": ngram_join.ORACLE, "op11_periodic_runs": tandem.ORACLE, "op12_merkle_manifest": merkle.ORACLE, "op13_decontamination": decontaminate.ORACLE}

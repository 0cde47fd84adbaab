"""Summaries with totals, coverage of labels and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import query


@query("""
SELECT o_orderstatus AS status, count(*) AS orders, CAST(GROUPING(o_orderstatus) AS BIGINT) AS total, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS urgent
FROM orders GROUP BY ROLLUP (o_orderstatus)
""")
def progress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by state, with the total of all states."""
    from tidemark.sources.tables import load

    return (
        load(spark, sf_dir, "orders")
        .withColumnRenamed("o_orderstatus", "status")
        .rollup("status")
        .agg(F.count(F.lit(1)).alias("orders"), F.grouping("status").cast("long").alias("total"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    )


@query("""
SELECT source, lang, count(*) AS documents, count(l.doc_id) AS labelled, CAST(floor(CAST(count(l.doc_id) AS DOUBLE) / CAST(count(*) AS DOUBLE) * CAST(10000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS share
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source, lang
""")
def label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of labelled documents by source and language."""
    from tidemark.plans.prices import share
    from tidemark.sources.tables import load

    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_id")).distinct()
    both = load(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(labels, F.col("doc_id") == F.col("l_id"), "left")
    n = F.count(F.lit(1))
    return both.groupBy("source", "lang").agg(n.alias("documents"), F.count("l_id").alias("labelled"), share(F.count("l_id"), n).alias("share"))


@query("""
SELECT quality, count(*) AS total, count(CASE WHEN toxic = 1 THEN 1 END) AS toxic, CAST(floor(CAST(sum(n_chars) AS DOUBLE) / CAST(count(*) AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS mean_chars
FROM labels JOIN documents ON labels.doc_id = documents.doc_id GROUP BY quality
""")
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents by rating, with a conditional count and a mean."""
    from tidemark.functions.money import half_up
    from tidemark.sources.tables import load

    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("d_id"), "n_chars")
    both = load(spark, sf_dir, "labels").join(docs, F.col("doc_id") == F.col("d_id"))
    mean = half_up(F.sum("n_chars").cast("double") / F.count(F.lit(1)).cast("double"))
    return both.groupBy("quality").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("toxic") == 1).alias("toxic"), mean.alias("mean_chars"))

"""Quality, reconciliation and loading queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import incremental, quality
from tidemark.plans.catalog import query
from tidemark.plans.prices import SHARE
from tidemark.sources.tables import by_region, load


@query("SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    return quality.orphans(load(spark, sf_dir, "documents").select("doc_id", "source"), load(spark, sf_dir, "labels"), "doc_id", "doc_id")


@query("""
SELECT source, CASE WHEN l.doc_id IS NULL THEN 'not_found' ELSE 'found' END AS status, count(DISTINCT d.doc_id) AS documents, count(l.doc_id) AS hit_count
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2
""")
def match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with and without a label by source, and the labels found."""
    labels = load(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_id"))
    both = load(spark, sf_dir, "documents").select("doc_id", "source").join(labels, F.col("doc_id") == F.col("l_id"), "left")
    status = F.when(F.col("l_id").isNull(), "not_found").otherwise("found").alias("status")
    return both.groupBy("source", status).agg(F.count_distinct("doc_id").alias("documents"), F.count("l_id").alias("hit_count"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL)")
def work_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which no line is there yet."""
    return quality.orphans(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), load(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


FILLED = ["doc_id", "text", "lang", "source", "n_chars"]


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", f AS filled, n AS rows, {SHARE.format("f", "n")} AS share FROM (SELECT count(*) AS n,
  count(CASE WHEN {c} IS NOT NULL AND trim(CAST({c} AS VARCHAR)) <> '' THEN 1 END) AS f FROM documents)"""
        for c in FILLED
    )
)
def fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of filled values by column."""
    return quality.fill_rates(load(spark, sf_dir, "documents"), FILLED)


@query("""
SELECT doc_id, h AS text_hash FROM (SELECT doc_id, h, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS n
  FROM (SELECT doc_id, md5(lower(trim(text))) AS h FROM documents)) WHERE n = 1
""")
def dedupe_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review of each normalised text, the one of the smallest id: counted before it is shuffled."""
    text = F.md5(F.lower(F.trim("text")).cast("binary")).alias("text_hash")
    return load(spark, sf_dir, "documents").groupBy(text).agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text_hash")


@query("""
SELECT md5(text) AS text_hash, count(DISTINCT source) AS sources, count(*) AS rows, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1
""")
def cross_product_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that stand under several sources."""
    found = load(spark, sf_dir, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("text_hash"))
    return found.agg(F.count_distinct("source").alias("sources"), F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("first_id")).filter("sources > 1")


@query("""
WITH a AS (SELECT doc_id AS product_id, md5(text) AS review_key, 'old' AS origin FROM documents WHERE doc_id % 2 = 0),
b AS (SELECT doc_id AS product_id, md5(text) AS review_key, 'new' AS origin FROM documents)
SELECT product_id, review_key, origin FROM a UNION ALL
SELECT product_id, review_key, origin FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.product_id = b.product_id AND a.review_key = b.review_key)
""")
def merge_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews inserted into a table that has those of even ids: keys that are there stay as they are."""
    rows = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("product_id"), F.md5(F.col("text").cast("binary")).alias("review_key"))
    target = rows.filter("product_id % 2 = 0").withColumn("origin", F.lit("old"))
    return incremental.insert_or_ignore(target, rows.withColumn("origin", F.lit("new")), ["product_id", "review_key"], ["origin"])


@query("""
WITH w AS (SELECT s_suppkey, s_name, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'parts' AS side, count(*) AS rows FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM w) UNION ALL
SELECT 'whole', count(*) FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM w)
""")
def union_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regional shop tables put together against the whole: no row on either side alone."""
    places = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    whole = load(spark, sf_dir, "supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", F.col("r_name").alias("region"))
    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    parts = by_region({name: whole.filter(F.col("region") == name).drop("region") for name in names})
    return quality.reconcile(parts, whole)


@query("""
SELECT 'except' AS op, count(*) AS keys FROM (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem) UNION ALL
SELECT 'intersect', count(*) FROM (SELECT o_orderkey FROM orders INTERSECT SELECT l_orderkey FROM lineitem) UNION ALL
SELECT 'intersect_all', count(*) FROM (SELECT l_suppkey FROM lineitem INTERSECT ALL SELECT s_suppkey FROM supplier) UNION ALL
SELECT 'union', count(*) FROM (SELECT o_orderkey FROM orders UNION SELECT l_orderkey FROM lineitem)
""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of set operations between order keys and line keys."""
    orders, lines = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    shops, sold = load(spark, sf_dir, "supplier").select("s_suppkey"), load(spark, sf_dir, "lineitem").select("l_suppkey")
    made = {"except": orders.subtract(lines), "intersect": orders.intersect(lines), "intersect_all": sold.intersectAll(shops), "union": orders.union(lines).distinct()}
    out = None
    for name, df in made.items():
        row = df.agg(F.count(F.lit(1)).alias("keys")).select(F.lit(name).alias("op"), "keys")
        out = row if out is None else out.unionByName(row)
    return out


@query("""
SELECT s_suppkey AS id, s_name AS name, s_suppkey AS old_id FROM supplier UNION ALL
SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey), c_name, c_custkey FROM customer
""")
def id_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers appended to suppliers under new ids."""
    target = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return incremental.append_with_new_ids(target, load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "id", ["id"])


@query("""
SELECT source, count(*) AS documents, count(CASE WHEN length(text) <= 100 THEN 1 END) AS short, count(CASE WHEN lang = 'en' THEN 1 END) AS english,
  CAST(max(n_chars) AS BIGINT) AS longest FROM documents GROUP BY source
""")
def capability_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several conditional counts by source in one pass."""
    return (
        load(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("documents"), F.count_if(F.length("text") <= 100).alias("short"),
            F.count_if(F.col("lang") == "en").alias("english"), F.max("n_chars").cast("long").alias("longest"),
        )
    )

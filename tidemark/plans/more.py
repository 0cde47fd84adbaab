"""Further queries: as-of prices, fan-out, sampling, growth, keyword columns, shared specifications, run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_week
from tidemark.operators import snapshots
from tidemark.plans.cases import rows
from tidemark.plans.catalog import query
from tidemark.plans.prices import CENTS, SHARE, prices, share
from tidemark.sources.tables import load

HASH = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 15) AS BIGINT)"


def seeded(column: str):
    """A hash that other engines have as well."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


@query(f"""
WITH p AS (SELECT l_partkey AS product, CAST(l_shipdate AS DATE) AS day, min({CENTS}) AS c FROM lineitem GROUP BY 1, 2),
a AS (SELECT p_partkey AS product, DATE '1997-06-30' AS day FROM part)
SELECT a.product, a.day, p.c AS cents FROM a ASOF LEFT JOIN p ON a.product = p.product AND a.day >= p.day
""")
def as_of_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's lowest price of the last day it was seen, up to a given day."""
    daily = prices(spark, sf_dir, F.col("l_shipdate").cast("date").alias("day")).groupBy("product", "day").agg(F.min("c").alias("cents"))
    asked = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), F.lit("1997-06-30").cast("date").alias("day"))
    return snapshots.as_of(daily, asked, "product", "day", "cents").select("product", "day", "cents")


@query(f"""
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY {HASH.format("doc_id")}, doc_id) AS n FROM documents) WHERE n <= 3
""")
def sample_per_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three documents of each source, picked by hash: Spark ranks only the first three of each task."""
    docs = load(spark, sf_dir, "documents").select("source", "doc_id").withColumn("h", seeded("doc_id"))
    n = F.row_number().over(Window.partitionBy("source").orderBy("h", "doc_id"))
    return docs.withColumn("n", n).filter("n <= 3").select("source", "doc_id")


@query("""
SELECT source, doc_id FROM documents WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) < 0.25 * 4294967296
""")
def sample_by_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents, picked by hash where they lie."""
    return sampled(load(spark, sf_dir, "documents"), "doc_id", 0.25).select("source", "doc_id")


def sampled(df: DataFrame, key: str, ratio: float | None) -> DataFrame:
    """The rows whose key's hash lies below a share of its range; no ratio takes all. Rows with a null key go, unless all are taken."""
    if ratio is None:
        return df
    at = F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return df.filter(at < F.lit(int(ratio * (1 << 32))))


@query(f"""
SELECT lang, source, n, place FROM (SELECT lang, source, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) AS place FROM
  (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source)) WHERE place <= 5
""")
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest sources of each language."""
    counts = load(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "source")).cast("long")
    return counts.withColumn("place", place).filter("place <= 5")


@query(f"""
WITH w AS (SELECT event_type, strftime(ts, '%G-W%V') AS week, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, week, n, lag(n) OVER (PARTITION BY event_type ORDER BY week) AS before,
  {SHARE.format("n", "lag(n) OVER (PARTITION BY event_type ORDER BY week)")} AS growth FROM w
""")
def week_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by week against the week before, as a ratio in ten-thousandths."""
    week = load(spark, sf_dir, "events").groupBy("event_type", iso_week(F.col("ts")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.partitionBy("event_type").orderBy("week"))
    return week.withColumn("before", before).withColumn("growth", share(F.col("n"), F.col("before")))


COLUMNS = (("red", "warm"), ("hot", "warm"), ("blue", "cold"), ("small", "small"))


@query("""
SELECT kind, count(DISTINCT p_partkey) AS products, CAST(min(cents) AS BIGINT) AS lowest FROM (SELECT p_partkey, p_name,
  CAST(floor(p_retailprice * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS cents FROM part)
JOIN (VALUES ('red', 'warm'), ('hot', 'warm'), ('blue', 'cold'), ('small', 'small')) k(word, kind) ON contains(lower(p_name), word) GROUP BY kind
""")
def keyword_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names put into columns by the keywords they contain; the keyword table is a handful of rows."""
    from tidemark.functions.money import cents

    words = rows(spark, "word string, kind string", *COLUMNS)
    part = load(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("name"), cents(F.col("p_retailprice")).alias("c"))
    both = part.join(F.broadcast(words), F.contains("name", F.col("word")))
    return both.groupBy("kind").agg(F.count_distinct("p_partkey").alias("products"), F.min("c").alias("lowest"))


@query("""
SELECT r_name AS region, p_brand AS brand, arg_min(s_suppkey, {n: -n, s: s_suppkey}) AS shop, CAST(max(n) AS BIGINT) AS series FROM (
  SELECT r_name, p_brand, s_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3) GROUP BY 1, 2
""")
def shared_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and brand the shop with the most products, whose specifications serve the whole region."""
    places = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    shops = load(spark, sf_dir, "supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "region")
    lines = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").join(load(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand")), F.col("l_partkey") == F.col("p_partkey"))
    counts = lines.join(shops, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("region", "brand", "s_suppkey").agg(F.count_distinct("l_partkey").alias("n"))
    return counts.groupBy("region", "brand").agg(F.min_by("s_suppkey", F.struct((-F.col("n")).alias("n"), "s_suppkey")).alias("shop"), F.max("n").alias("series"))


FAN_OUT_SQL = """
WITH m AS (SELECT p_brand AS brand, count(*) AS models FROM part GROUP BY 1),
s AS (SELECT r_name AS region, count(*) AS shops FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT brand, region, models * shops AS tasks FROM m, s
"""


@query(FAN_OUT_SQL)
def model_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work for every model in every shop."""
    return fan_out(spark, sf_dir, load(spark, sf_dir, "part"))


@query(FAN_OUT_SQL)
def model_fan_out_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as model_fan_out, which takes all models too."""
    return model_fan_out(spark, sf_dir)


def fan_out(spark: SparkSession, sf_dir: str, models: DataFrame) -> DataFrame:
    """Models by brand times shops by region: both sides are counted before they meet, so rows are never multiplied."""
    models = models.select(F.col("p_brand").alias("brand"))
    places = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    shops = load(spark, sf_dir, "supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("region").agg(F.count(F.lit(1)).alias("shops"))
    per_brand = models.groupBy("brand").agg(F.count(F.lit(1)).alias("models"))
    return per_brand.crossJoin(F.broadcast(shops)).select("brand", "region", (F.col("models") * F.col("shops")).alias("tasks"))


@query("""
SELECT source, CAST(sum(hits) AS BIGINT) AS hits, count(*) AS items FROM (SELECT d.source, b.item_id, count(*) AS hits FROM benchmark b JOIN documents d ON contains(d.text, b.text)
  GROUP BY 1, 2) GROUP BY source
""")
def passages_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that hold listed passages, with hits and distinct passages."""
    from tidemark.operators.matching import passages_in

    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = passages_in(load(spark, sf_dir, "benchmark"), docs.select("doc_id", "text")).join(docs.select("doc_id", "source"), "doc_id")
    return found.groupBy("source").agg(F.count(F.lit(1)).alias("hits"), F.count_distinct("item_id").alias("items"))

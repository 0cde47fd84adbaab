"""Queries that say why: keys found in pages, models that nothing matched, price differences that mean something."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import difference_verdict
from tidemark.operators import extraction, matching
from tidemark.plans.catalog import query
from tidemark.plans.prices import CENTS, prices
from tidemark.sources.tables import load, spread

KEYS = ", ".join(f"('{k}')" for k in extraction.JSON_KEYS)
PAGE = """'<script>{"name":"' || p_name || '","techSpecs" :[' || p_size || '],' || CASE WHEN p_size % 2 = 0 THEN '"specification":{"specGroups":[]}' ELSE '\\"classifications\\":1,"specifications":2' END || '}</script><p>techSpecs</p>'"""


@query(rf"""
SELECT key, CAST(sum(hits) AS BIGINT) AS hits, count(*) AS pages FROM (
  SELECT key, len(regexp_extract_all(html, '["\\]*' || key || '["\\]*\s*:')) AS hits FROM (SELECT {PAGE} AS html FROM part), (VALUES {KEYS}) k(key)) WHERE hits > 0 GROUP BY key
""")
def json_key_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON keys in pages made of the products, and how many pages have each."""
    size = F.col("p_size").cast("string")
    body = F.when(F.col("p_size") % 2 == 0, '"specification":{"specGroups":[]}').otherwise('\\"classifications\\":1,"specifications":2')
    html = F.concat(F.lit('<script>{"name":"'), "p_name", F.lit('","techSpecs" :['), size, F.lit("],"), body, F.lit("}</script><p>techSpecs</p>"))
    pages = spread(load(spark, sf_dir, "part"), "p_partkey").select("p_partkey", html.alias("html"))
    return extraction.key_counts(pages, "p_partkey", "html").groupBy("key").agg(F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("pages"))


@query("""
WITH p AS (SELECT CAST(40 + p_size AS BIGINT) AS wanted, CAST(p_partkey % 7 AS BIGINT) AS want, CAST(p_partkey % 5 AS BIGINT) AS have, CAST(40 + p_size * 7 % 50 AS BIGINT) AS size FROM part),
g AS (SELECT wanted, want, max(CASE WHEN want = have AND wanted = size THEN 1 ELSE 0 END) AS ok, list_sort(list(DISTINCT size) FILTER (want = have)) AS sizes FROM p GROUP BY 1, 2)
SELECT wanted || 'U' || want || 'SG' AS target, CASE WHEN sizes IS NULL OR len(sizes) = 0 THEN 'no_such_series' ELSE 'other_sizes' END AS reason,
  coalesce(array_to_string(sizes, '/'), '') AS sizes, wanted FROM g WHERE ok = 0
""")
def no_match_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models made of the products, each with the titles it met: why nothing matched, and the sizes seen of its series."""
    text = lambda c: c.cast("string")
    target = F.concat(text(F.col("p_size") + 40), F.lit("U"), text(F.col("p_partkey") % 7), F.lit("SG"))
    title = F.concat(F.lit("Screen "), text(F.col("p_size") * 7 % 50 + 40), F.lit(" inch Class U"), text(F.col("p_partkey") % 5), F.lit("SG Series"))
    pairs = spread(load(spark, sf_dir, "part"), "p_partkey").select(target.alias("target"), title.alias("title"))
    rules = matching.MatchRules()
    said = matching.matches(F.col("target"), F.col("title"), F.lit(None).cast("string"), F.array().cast("array<string>"), rules)
    return matching.refusals(pairs.withColumn("match", said), "target", "title", "match", rules)


@query(f"""
WITH l AS (SELECT l_partkey AS product, CAST(l_shipdate AS DATE) AS day, {CENTS} AS c FROM lineitem),
e AS (SELECT product, arg_min(c, {{d: day, c: c}}) AS old, arg_max(c, {{d: day, c: c}}) AS new, max(day) - min(day) AS days FROM l GROUP BY product),
v AS (SELECT product, CASE WHEN abs(new - old) * 10000 <= old * 500 THEN 'same' WHEN abs(new - old) * 10000 > old * 5000 THEN 'suspect'
  WHEN days > 7 AND p_size > 5 THEN 'move' ELSE 'unsure' END AS verdict FROM e JOIN part ON p_partkey = product)
SELECT verdict, count(*) AS products FROM v GROUP BY verdict
""")
def price_verdict_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by what their first and last price say; pages of small products count as gone."""
    line = prices(spark, sf_dir, F.col("l_shipdate").cast("date").alias("day"))
    at = F.struct("day", "c")
    ends = line.groupBy("product").agg(F.min_by("c", at).alias("old"), F.max_by("c", at).alias("new"), F.date_diff(F.max("day"), F.min("day")).alias("days"))
    both = ends.join(load(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), "p_size"), "product")
    verdict = difference_verdict(F.col("old"), F.col("new"), F.col("days"), F.lit(True), F.col("p_size") > 5)
    return both.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("products"))

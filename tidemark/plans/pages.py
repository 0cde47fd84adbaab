"""Page, URL and matching queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.operators import extraction, matching
from tidemark.operators.ranking import number_all
from tidemark.plans.catalog import query
from tidemark.plans.prices import SHARE, share
from tidemark.sources.tables import load
from tidemark.streaming.run import work_dir

HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
CLEAN = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '')"


@query(f"SELECT {CLEAN} AS clean, lower(regexp_replace({CLEAN}, '/+$', '')) AS matched, count(*) AS pages FROM pages GROUP BY 1, 2")
def clean_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised addresses and how many pages share each."""
    clean = urls.clean_url(F.col("url"))
    return load(spark, sf_dir, "pages").groupBy(clean.alias("clean"), urls.match_url(clean).alias("matched")).agg(F.count(F.lit(1)).alias("pages"))


@query(f"""
SELECT page_id, {HOST} AS host, {PATH} AS path FROM pages
WHERE {HOST} IN (SELECT h FROM (SELECT {HOST} AS h, count(*) AS n FROM pages GROUP BY 1) WHERE n >= 5)
""")
def url_host_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host and path of the pages whose host is allowed: here, hosts with five pages or more."""
    pages = load(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("host"), urls.path(F.col("url")).alias("path"))
    allowed = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5").select("host")
    return pages.join(allowed, "host", "left_semi").select("page_id", "host", "path")


@query(f"""
WITH u AS (SELECT DISTINCT {HOST} AS host, url FROM pages),
g AS (SELECT host, count(*) AS hits, count(CASE WHEN regexp_matches(list_extract(string_split({CLEAN}, '/'), -1), '[0-9]{{2}}') THEN 1 END) AS good FROM u GROUP BY host)
SELECT host, hits, {SHARE.format("good", "hits")} AS purity, row_number() OVER (ORDER BY {SHARE.format("good", "hits")} DESC, hits DESC, host) AS rank FROM g
""")
def purity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts by the share of distinct addresses that end in something numbered."""
    distinct = load(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host"), "url").distinct()
    good = F.count_if(urls.last_segment(F.col("url")).rlike("[0-9]{2}"))
    ranked = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("hits"), share(good, F.count(F.lit(1))).alias("purity"))
    where = work_dir(spark)  # a row for each host, which is read three times
    ranked.write.parquet(where)
    ranked = spark.read.parquet(where)
    return number_all(ranked, [-F.col("purity"), -F.col("hits"), F.col("host")], [F.desc("purity"), F.desc("hits"), "host"], "rank")


@query(f"""
SELECT {HOST} AS host, link, count(*) AS n FROM (SELECT url, unnest(regexp_extract_all(html, '(?i)<a[^>]* href=["'']([^"'']*)["'']', 1)) AS link FROM pages) GROUP BY 1, 2
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all pages by host."""
    found = load(spark, sf_dir, "pages").select(urls.host(F.col("url")).alias("host"), F.explode(extraction.links(F.col("html"))).alias("link"))
    return found.groupBy("host", "link").agg(F.count(F.lit(1)).alias("n"))


@query(r"""
SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<h1[^>]*>([^<]*)</h1>', 1)), ''), nullif(trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)), '')) AS heading,
  nullif(trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)), '') AS title FROM pages
""")
def extract_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading of each page: the first h1, else the title."""
    h1, title = (F.regexp_extract("html", rf"(?is)<{t}[^>]*>([^<]*)</{t}>", 1) for t in ("h1", "title"))
    return load(spark, sf_dir, "pages").select("page_id", extraction.first_of(h1, title).alias("heading"), extraction.first_of(title).alias("title"))


@query("""
WITH p AS (SELECT page_id, CASE WHEN regexp_matches(lower(html), 'captcha') AND length(html) <= 20480 THEN 'challenge' WHEN length(html) < 5120 THEN 'shell' ELSE 'ok' END AS kind FROM pages)
SELECT kind, count(*) AS pages FROM p GROUP BY kind
""")
def page_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages by what their response was."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>([^<]*)</title>", 1)
    kind = extraction.page_class(F.lit(200), title, F.col("url"), F.col("html"))
    return load(spark, sf_dir, "pages").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("pages"))


MARKERS = ["<table", "<script", "<h1", "href=", "product", "price"]


@query(
    " UNION ALL ".join(f"SELECT '{m}' AS marker, CAST(sum((length(html) - length(replace(html, '{m}', ''))) // {len(m)}) AS BIGINT) AS hits FROM pages" for m in MARKERS)
)
def marker_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often markers stand in the stored pages."""
    return extraction.marker_counts(load(spark, sf_dir, "pages"), "page_id", "html", MARKERS).groupBy("marker").agg(F.sum("hits").alias("hits"))


SLUG_SQL = """
WITH w AS (SELECT p_partkey, list_filter(string_split(lower(p_name), ' '), lambda x: x <> '') AS t FROM part),
k AS (SELECT p_partkey, [i FOR i IN range(1, len(t) + 1) IF t[i] NOT IN ('inch', 'inches', 'class', 'series', 'tv', 'uhd', '4k', 'hdr', 'smart')] AS pos, t FROM w),
p AS (SELECT DISTINCT p_partkey, unnest(flatten([[upper(array_to_string([t[j] FOR j IN list_slice(pos, i, i + n - 1)], '')) FOR i IN range(1, len(pos) - n + 2) IF pos[i + n - 1] - pos[i] - (n - 1) <= 5]
  FOR n IN range(1, 5)])) AS m FROM k)
SELECT model, count(DISTINCT p_partkey) AS hits, min(p_partkey) AS first_product FROM
  (SELECT DISTINCT upper(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')) AS model FROM part) JOIN p ON p.m = model WHERE model <> '' GROUP BY model
"""


@query(SLUG_SQL)
def slug_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose slug names one of the models, all product names, by windows of words that meet them in an equi-join."""
    part = load(spark, sf_dir, "part")
    return slug_hits(part, part)


@query(SLUG_SQL)
def slug_match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as slug_match, which takes all models too."""
    return slug_match(spark, sf_dir)


def slug_hits(wanted: DataFrame, part: DataFrame) -> DataFrame:
    """How many products' slugs name each model, and the first of them; a model that several products share counts once."""
    models = wanted.select(urls.upper_alnum(F.col("p_name")).alias("model")).distinct()
    catalog = part.select("p_partkey", F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("slug"))
    found = matching.match_slugs(models, catalog, "model", "slug")
    return found.groupBy("model").agg(F.count_distinct("p_partkey").alias("hits"), F.min("p_partkey").alias("first_product"))


@query("SELECT DISTINCT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def passage_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a listed passage word for word."""
    return matching.passages_in(load(spark, sf_dir, "benchmark"), load(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def text_from_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of each page, and a hash of it; unclosed tags need a real parser."""
    text = load(spark, sf_dir, "pages").select("page_id", extraction.visible_text("html").alias("text"))
    return text.select("page_id", F.length("text").alias("characters"), F.md5(F.col("text").cast("binary")).alias("text_hash"))


@query()
def spec_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter, item and value of the tables of each page."""
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    triples = extraction.SpecTriples(F.col("html").outer()) if hasattr(F.col("html"), "outer") else None
    if triples is None:
        spark.udtf.register("spec_triples", extraction.SpecTriples)
        pages.createOrReplaceTempView("spec_pages")
        return spark.sql("SELECT page_id, t.* FROM spec_pages, LATERAL spec_triples(html) t")
    return pages.lateralJoin(triples).select("page_id", "chapter", "item", "value")

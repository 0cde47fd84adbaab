"""Rules over texts and documents that are made of the given tables by number; the SQL derives what each rule must give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, money, nested, regions, urls
from tidemark.operators import extraction, matching, quality, reviews
from tidemark.plans.catalog import query
from tidemark.plans.stored import joined
from tidemark.sources.tables import load, spread

def text(*parts: Column | str) -> Column:
    """Columns and plain texts put together."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def choice(by: Column, *values: Column) -> Column:
    """The value whose place is the number ``by``, from 0 on; null beyond the last."""
    return F.try_element_at(F.array(*values), (by + 1).cast("int"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products, with k, their number, and s, a size of two digits or three."""
    return spread(load(spark, sf_dir, "part"), "p_partkey").select("*", F.col("p_partkey").alias("k"), (F.col("p_size") * 3).alias("s"), (F.col("p_size") + 20).alias("s2"))


P = "(SELECT *, p_partkey AS k, p_size * 3 AS s, p_size + 20 AS s2 FROM part)"


@query(f"""
SELECT k AS product, CASE k % 5 WHEN 0 THEN s BETWEEN 15 AND 110 WHEN 4 THEN s BETWEEN 15 AND 110 ELSE false END AS strict, k % 5 = 2 AND s >= 10 AS lenient FROM {P}
""")
def title_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of all products, with sizes inside and outside the limits, accessories and model numbers, by the strict and the lenient rule."""
    key, size, name = F.col("k"), F.col("s"), F.col("p_name")
    title = choice(key % 5, text("TV ", size, " pulgadas ", name), text("Soporte TV ", size, " pulgadas"), text("QLED ", size, "QD7N Smart"), text("Remote for ", size, '" TV'), text(size, " inch ", name))
    return products(spark, sf_dir).select(key.alias("product"), extraction.tv_title(title).alias("strict"), extraction.tv_model_title(title).alias("lenient"))


@query(f"""
WITH m AS (SELECT s2 || 'U' || (k % 9) || 'N' AS model, coalesce(CASE k % 4 WHEN 0 THEN p_brand END, CASE k % 6 WHEN 1 THEN p_type END, 'U' || (k % 9) || 'N') AS series_key FROM {P})
SELECT series_key, string_agg(DISTINCT model, ',' ORDER BY model) AS models FROM m GROUP BY series_key
""")
def series_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models put into series by family, by series field, or by the model without its size; blanks count as missing."""
    key, inches = F.col("k"), F.col("s2")
    model = text(inches, "U", key % 9, "N")
    table = products(spark, sf_dir).select(model.alias("model"), F.when(key % 4 == 0, F.col("p_brand")).when(key % 4 == 1, "").alias("family"), F.when(key % 6 == 1, F.col("p_type")).when(key % 6 == 3, "").alias("series"))
    return extraction.merge_series(table, "model", "family", "series", urls.strip_leading_size(F.col("model"))).select("series_key", F.array_join("models", ",").alias("models"))


@query(f"""
SELECT k AS product, CASE k % 3 WHEN 0 THEN k ELSE 1000000 + k END AS page, CASE k % 3 WHEN 0 THEN 'address' ELSE 'code' END AS way FROM {P} WHERE k % 3 = 0 OR k % 3 = 1 AND k % 2 = 0
""")
def address_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all products by address, and by the code at its end where the size agrees as well."""
    key = F.col("k")
    part = products(spark, sf_dir)
    wanted = part.select(key.alias("product"), choice(key % 3, text("https://X.example/tv/", key, "/"), text("https://x.example/old/c", F.floor(key / 3)), text("https://x.example/none/z", key)).alias("url"), F.col("p_size").alias("size"))
    whole = part.filter(key % 3 == 0).select(key.alias("page"), text("https://x.example/TV/", key, "?a=1").alias("page_url"), F.col("p_size").alias("page_size"))
    coded = part.filter(key % 3 == 1).select((key + 1_000_000).alias("page"), text("https://x.example/new/c", F.floor(key / 3)).alias("page_url"), (F.col("p_size") + key % 2).cast("int").alias("page_size"))
    return extraction.join_addresses(wanted, whole.unionByName(coded), "url", "page_url", "size", "page_size").select("product", "page", F.col("by").alias("way"))


@query(f"""
WITH c AS (SELECT k, p_size AS total, [k % 30, (k // 3) % 30, (k // 7) % 20, 10, 90 - k % 30 - (k // 3) % 30 - (k // 7) % 20] AS pct FROM {P}),
r AS (SELECT *, list_transform(pct, lambda p: CAST(floor(CAST(total AS DOUBLE) * CAST(p AS DOUBLE) / CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)) AS n FROM c),
e AS (SELECT k, i, n[i] + CASE WHEN i = list_position(pct, list_max(pct)) THEN total - CAST(list_sum(n) AS BIGINT) ELSE 0 END AS n FROM r, (SELECT unnest(range(1, 6)) AS i))
SELECT k AS product, CAST(i AS BIGINT) AS star, CAST(n AS BIGINT) AS n FROM e
""")
def star_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star counts of all products from percentages: each histogram sums to its total."""
    key = F.col("k")
    a, b, c = key % 30, F.floor(key / 3) % 30, F.floor(key / 7) % 20
    counts = reviews.star_counts(F.col("p_size").cast("long"), F.array(a, b, c, F.lit(10).cast("long"), F.lit(90) - a - b - c))
    return products(spark, sf_dir).select(key.alias("product"), F.posexplode(counts).alias("i", "n")).select("product", (F.col("i") + 1).cast("long").alias("star"), "n")


#: Countries as suppliers may write them, by the nation's number, and the region of each.
WRITTEN = (("mexico", "NORTH AMERICA"), ("墨西哥", "NORTH AMERICA"), (" Germany ", "EUROPE"), ("日本", "ASIA"), ("CHILE", "SOUTH AMERICA"), ("Atlantis", "UNKNOWN"), ("uk", "EUROPE"))


@query(f"""
SELECT r.region, count(*) AS suppliers FROM supplier JOIN (VALUES {", ".join(f"({i}, '{r}')" for i, (_, r) in enumerate(WRITTEN))}) r(i, region) ON s_nationkey % {len(WRITTEN)} = r.i GROUP BY 1
""")
def region_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by region, their countries in two languages and cases; one that is not listed shows as such."""
    country = choice(F.col("s_nationkey") % len(WRITTEN), *[F.lit(c) for c, _ in WRITTEN])
    return load(spark, sf_dir, "supplier").groupBy(regions.region(country).alias("region")).agg(F.count(F.lit(1)).alias("suppliers"))


@query(f"""
SELECT CASE WHEN k % 2 = 0 THEN 'yotpo:' || k || '-' || i ELSE '2026-01-0' || (i + 1) || '|' || p_name END AS review_id, CASE WHEN k % 5 <> 0 THEN CAST(i + 1 AS DOUBLE) END AS rating,
  CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'a' || k || '.jpg' ELSE 'a' || k || '.jpg | b.jpg' END AS images, 'https://x.example/r#bv-src-product=' || k AS source_url
FROM {P}, (SELECT unnest(range(3)) AS i) WHERE i < k % 4
""")
def review_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vendor's answers for all products flattened: prefixed keys or date and author, joined lists, and the product they were found under."""
    key, name = F.col("k"), F.col("p_name")
    images = choice(key % 3, F.lit(""), text('{"url":"a', key, '.jpg"}'), text('{"url":"a', key, '.jpg"},{"url":"b.jpg"}'))
    one = lambda i: text('{"id":"', F.when(key % 2 == 0, text(key, f"-{i}")).otherwise(""), '"', F.when(key % 5 != 0, f',"score":{i + 1}').otherwise(""), f',"date":"2026-01-0{i + 1}","name":"', name, '","images":[', images, "]}")
    doc = text('{"product":', key, ',"reviews":[', F.array_join(F.slice(F.array(one(0), one(1), one(2)), F.lit(1), (key % 4).cast("int")), ","), "]}")
    kind = "product long, reviews array<struct<id:string,score:double,date:string,name:string,images:array<struct<url:string>>>>"
    found = products(spark, sf_dir).select(F.from_json(doc, kind).alias("d")).select("d.product", F.explode("d.reviews").alias("r"))
    return found.select(
        reviews.review_key("yotpo", F.col("r.id"), F.col("r.date"), F.col("r.name")).alias("review_id"), F.col("r.score").alias("rating"),
        F.array_join(F.transform("r.images", lambda x: x["url"]), " | ").alias("images"), reviews.with_source(F.lit("https://x.example/r"), F.col("product")).alias("source_url"),
    )


@query("""
WITH n AS (SELECT s_nationkey, count(*) AS added FROM supplier GROUP BY 1)
SELECT '2026-W' || (10 + s_nationkey) AS week, 'site_' || s_suppkey AS site, s_suppkey % 7 AS ok, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 5 END AS blocked, s_suppkey % 4 = 0 AS timeout, added FROM supplier JOIN n USING (s_nationkey)
""")
def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State documents of runs, one a nation: sites by name, their result lines, and what the run added."""
    n = F.col("s_suppkey")
    site = text('"site_', n, '":{"output":"Result: ok=', n % 7, " fail=0", F.when(n % 3 == 0, text(" blocked=", n % 5)).otherwise(""), ' rows=1","timeout":', (n % 4 == 0), ',"elapsed":1.5}')
    sites = load(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", site.alias("site"))
    held = sites.groupBy("s_nationkey").agg(F.array_join(F.collect_list("site"), ",").alias("sites"), F.count(F.lit(1)).alias("n"))
    doc = text('{"week":"2026-W', F.col("s_nationkey") + 10, '","before":{"price":100},"after":{"price":', F.col("n") + 100, '},"sites":{', F.col("sites"), "}}")
    kind = "week string, before struct<price:long>, after struct<price:long>, sites map<string, struct<output:string,timeout:boolean,elapsed:double>>"
    docs = held.select(F.from_json(doc, kind).alias("d"))
    each = docs.select("d.week", (F.col("d.after.price") - F.col("d.before.price")).alias("added"), F.explode("d.sites").alias("site", "s"))
    number = lambda name: F.regexp_extract("s.output", rf"\b{name}=(\d+)", 1).try_cast("long").alias(name)
    return each.select("week", "site", number("ok"), number("blocked"), F.col("s.timeout").alias("timeout"), "added")


@query(f"""
SELECT k // 100 AS site, CASE WHEN k // 100 % 3 = 0 THEN 'dom-' ELSE 'api-' END || k AS model, CASE WHEN k // 100 % 3 = 0 THEN 'dom' ELSE 'api' END AS method FROM {P}
""")
def api_or_dom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of each site from its API's answer, and from its pages where the API has no list; a hundred products are a site."""
    key = F.col("k")
    site = F.floor(key / 100)
    part = products(spark, sf_dir).select(site.alias("site"), "k", text('{"m":{"id":"api-', key, '"}},').alias("one"), text("dom-", key).alias("dom"))
    answers = joined(part, "site", "k", "one", '{"data":{"list":[', "]}}").withColumn("doc", F.when(F.col("site") % 3 == 0, "<html>").otherwise(F.replace("html", F.lit(",]}}"), F.lit("]}}"))))
    api = extraction.api_rows(answers.filter(F.try_parse_json("doc").isNotNull()), "doc", "data.list", {"model": "m.id"}, ["site"])
    return extraction.first_method([("api", api), ("dom", part.select("site", F.col("dom").alias("model")))], "site").select("site", "model", "method")


@query(f"""
WITH c AS (SELECT k, list_sort(list_filter([k % 5 + 1, k % 7 + 2, k % 11 + 3], lambda x: x > k % 6 + 5)) AS ahead, CAST(k % 11 AS DOUBLE) / CAST(10 AS DOUBLE) AS a, CASE WHEN k % 4 > 0 THEN CAST(k % 5 AS DOUBLE) / CAST(4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS b,
  CAST(k % 3 AS DOUBLE) / CAST(2 AS DOUBLE) AS c FROM {P}),
s AS (SELECT *, CAST(floor(least(a, CAST(1 AS DOUBLE)) * CAST(50 AS DOUBLE) + least(b, CAST(1 AS DOUBLE)) * CAST(30 AS DOUBLE) + least(c, CAST(1 AS DOUBLE)) * CAST(20 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS score FROM c)
SELECT k AS page, CAST(ahead[1] AS BIGINT) AS next, score, score >= 70 AS passed FROM s
""")
def page_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For a list page of each product: the next page by the numbers it links to, and its score."""
    key = F.col("k")
    next_page = extraction.next_page(F.array(key % 5 + 1, key % 7 + 2, key % 11 + 3), key % 6 + 5)
    score = extraction.page_score((key % 11) / F.lit(10.0), F.when(key % 4 > 0, (key % 5) / F.lit(4.0)), (key % 3) / F.lit(2.0))
    return products(spark, sf_dir).select(key.alias("page"), next_page.alias("next"), score.alias("score"), (score >= 70).alias("passed"))


@query("""
WITH b AS (SELECT p_brand AS brand, count(*) AS n FROM part GROUP BY 1)
SELECT brand, 'https://x.example/' || brand || '?from=' || f || '&to=' || least(f + 49, n - 1) AS address FROM (SELECT *, unnest(range(0, n, 50)) AS f FROM b)
""")
def page_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the windows of each brand's catalogue, 50 products at a time."""
    brands = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n"))
    each = brands.select("brand", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(50).cast("long"))).alias("f"))
    return each.select("brand", urls.fill("https://x.example/{brand}?from={a}&to={b}", brand=F.col("brand"), a=F.col("f").cast("string"), b=F.least(F.col("f") + 49, F.col("n") - 1).cast("string")).alias("address"))


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS link FROM part), f AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS link FROM part WHERE p_partkey % 2 = 0)
SELECT link || '.md' AS link FROM w WHERE link NOT IN (SELECT link FROM f)
""")
def dead_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the texts of products refer to, two each, and that are not among the files there."""
    part = load(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    texts = part.select(text("see playbook/", words[0], ".md and ", words[1], ".md, not x.txt").alias("text"))
    return extraction.dead_links(texts, part.filter("p_partkey % 2 = 0").select(text(words[0], ".md").alias("name")), "text", "name")


@query("""
WITH r AS (SELECT l_partkey AS product, CAST(l_quantity AS BIGINT) AS value, CAST(l_linenumber AS DOUBLE) / CAST(10 AS DOUBLE) AS confidence FROM lineitem)
SELECT product, value, confidence FROM (SELECT *, row_number() OVER (PARTITION BY product ORDER BY confidence DESC, value DESC) AS n FROM r) WHERE n = 1
""")
def best_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all readings of a product's quantity the one of the highest confidence, the larger of equals."""
    readings = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product"), F.col("l_quantity").cast("long").alias("value"), (F.col("l_linenumber") / F.lit(10.0)).alias("confidence"))
    best = readings.groupBy("product").agg(F.max(F.struct("confidence", "value")).alias("b"))
    return best.select("product", "b.value", "b.confidence")


@query(f"SELECT k AS product, k % 3 < 2 AND k % 2 = 0 AS ok FROM {P}")
def slug_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs of all products that do and do not name their model: other sizes, connectors between, and longer words."""
    key, inches = F.col("k"), F.col("s2")
    slug = text("brand-", inches, choice(key % 3, F.lit("-u8n-mini-led"), F.lit("-inch-class-4k-uhd-u8n-tv"), F.lit("-xu8nx-tv")))
    model = text(inches + F.when(key % 2 == 0, 0).otherwise(10), "U8N")
    return products(spark, sf_dir).select(key.alias("product"), F.array_contains(matching.slug_windows(slug), urls.upper_alnum(model)).alias("ok"))


@query("""
WITH c AS (SELECT regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') AS clean FROM pages)
SELECT clean, coalesce(regexp_matches(lower(regexp_extract(clean, '([^/]*)$', 1)), '[a-z][0-9]{2}|[0-9]{2}[a-z]'), false) AS model_like, count(*) AS pages FROM c GROUP BY 1, 2
""")
def url_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of all pages cleaned, and whether they look like a model's page."""
    url = F.col("url")
    like = F.coalesce(urls.looks_like_model_url(url), F.lit(False))
    return load(spark, sf_dir, "pages").groupBy(urls.clean_url(url).alias("clean"), like.alias("model_like")).agg(F.count(F.lit(1)).alias("pages"))


@query(f"""
SELECT k AS product, CASE k % 5 WHEN 3 THEN CAST(CAST(TIMESTAMP '2024-01-01' + to_days(CAST(k % 700 AS INTEGER)) AS DATE) AS TIMESTAMP) WHEN 4 THEN NULL
  ELSE TIMESTAMP '2024-01-01' + to_days(CAST(k % 700 AS INTEGER)) + to_seconds(k * 37 % 86400) END AS seen_at FROM {P}
""")
def timestamp_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time of each product as vendors write it: ISO, American, seconds since 1970, a date, and none."""
    key = F.col("k")
    at = F.timestamp_seconds(F.lit(1_704_067_200) + (key % 700) * 86_400 + key * 37 % 86_400)
    raw = choice(key % 5, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(at, "MM/dd/yyyy HH:mm:ss"), F.unix_seconds(at).cast("string"), F.date_format(at, "yyyy-MM-dd"), F.lit("soon"))
    return products(spark, sf_dir).select(key.alias("product"), dates.any_timestamp(raw).cast("timestamp_ntz").alias("seen_at"))


@query(f"""
SELECT k AS product, CASE k % 4 WHEN 0 THEN 'Brand ' || s2 || 'U8QG' WHEN 1 THEN s2 || 'QD8SF-PRO' WHEN 2 THEN 'TV ' || s2 || ' pulgadas 4K' ELSE p_name END AS clean, CASE WHEN k % 4 < 3 THEN s2 END AS inches,
  CASE k % 4 WHEN 0 THEN 'BRAND' || s2 || 'U8QG' WHEN 1 THEN 'QD8SF' WHEN 2 THEN 'TV' || s2 || 'PULGADAS4K' ELSE upper(replace(p_name, ' ', '')) END AS core FROM {P}
""")
def text_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search texts of all products cleaned of another script, their sizes and model cores."""
    key, inches, name = F.col("k"), F.col("s2"), F.col("p_name")
    raw = choice(key % 4, text("Brand（美国） ", inches, "U8QG"), text(inches, "QD8SF-PRO"), text("TV ", inches, " pulgadas 4K"), name)
    core = urls.core_model(F.regexp_replace(raw, "[（(][^）)]*[）)]", ""))
    return products(spark, sf_dir).select(key.alias("product"), urls.clean_search_text(raw).alias("clean"), urls.size_inch(raw).alias("inches"), core.alias("core"))


@query(f"SELECT k AS product, CASE k % 3 WHEN 0 THEN s2 || 'A6N-PRO' WHEN 1 THEN '' ELSE s2 || 'U7N,X9-' || s2 END AS words FROM {P}")
def title_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all products' titles that could be model numbers."""
    key, inches, name = F.col("k"), F.col("s2"), F.col("p_name")
    title = choice(key % 3, text("Smart TV BRAND2024 ", inches, "A6N-PRO 4K UHD"), name, text(inches, "U7N and x9-", inches))
    return products(spark, sf_dir).select(key.alias("product"), F.array_join(urls.model_words(title, ["SMART", "BRAND2024"]), ",").alias("words"))


@query(f"""
WITH c AS (SELECT k, CASE WHEN k % 4 < 3 THEN CAST(k % 101 AS DOUBLE) + CASE WHEN k % 4 = 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS percent FROM {P})
SELECT k AS product, percent, CASE WHEN percent IS NULL THEN 'unknown' WHEN percent >= {quality.SUCCESS} THEN 'success' WHEN percent >= {quality.PARTIAL} THEN 'partial' ELSE 'failed' END AS verdict FROM c
""")
def coverage_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage texts of all products and their verdicts: the number before the percent sign counts."""
    key = F.col("k")
    a = key % 101
    percent = quality.coverage_percent(choice(key % 4, text(a, "/100 = ", a, "%"), text(a, ".5 %"), text(a), F.lit("none")))
    return products(spark, sf_dir).select(key.alias("product"), percent.alias("percent"), quality.coverage_verdict(percent).alias("verdict"))


@query("""
WITH c AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'T' || s_nationkey END AS t, CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_suppkey % 5 = 0 THEN 'S' ELSE 'A' END || s_nationkey END AS s, 'A' || s_nationkey AS a FROM supplier)
SELECT k AS site, coalesce(t, s, a) AS currency, CASE WHEN k % 2 = 0 THEN 'schema' ELSE 'adapter' END AS search_url, k % 2 = 0 AS differs FROM c
""")
def config_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field of every site from its first source: site table, schema, adapter; and whether schema and adapter disagree."""
    n, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    every = load(spark, sf_dir, "supplier")
    table = every.filter(n % 3 == 0).select(n.alias("site"), text("T", nation).alias("currency"), F.lit(None).cast("string").alias("search_url"))
    schema = every.filter(n % 2 == 0).select(n.alias("site"), text(F.when(n % 5 == 0, "S").otherwise("A"), nation).alias("currency"), F.lit("schema").alias("search_url"))
    adapter = every.select(n.alias("site"), text("A", nation).alias("currency"), F.lit("adapter").alias("search_url"))
    named = lambda df, p: df.select("site", F.col("currency").alias(f"{p}_currency"), F.col("search_url").alias(f"{p}_url"))
    both = named(adapter, "a").join(named(schema, "s"), "site", "left").join(named(table, "t"), "site", "left")
    differs = quality.full_difference(schema, adapter.join(schema, "site", "left_semi"), ["site"], ["currency", "search_url"]).select("site", F.lit(True).alias("d"))
    first = lambda c: F.coalesce(f"t_{c}", f"s_{c}", f"a_{c}")
    return both.join(differs, "site", "left").select("site", first("currency").alias("currency"), first("url").alias("search_url"), F.coalesce("d", F.lit(False)).alias("differs"))


#: A response's status, title, address, body and length in characters, by the product's number, and what it is.
RESPONSES = (
    (403, "Just a moment...", "", "x", 6000, "cloudflare"), (200, "", "", "/TSPD/ x", 9000, "f5"), (200, "Robot or human?", "", "x", 9000, "challenge"), (200, "TV", "", '"captcha":{"enabled":true}', 30000, "ok"),
    (200, "TV", "https://x.example/are-you-robot", "x", 9000, "challenge"), (403, "Access Denied", "", "x", 300, "akamai"), (200, "TV", "", "captcha", 6000, "challenge"), (200, "TV", "", "x", 900, "shell"),
    (404, "Not here", "", "x", 9000, "not_found"), (503, "", "", "x", 170, "unreachable"), (403, "x", "", "captcha-delivery.com", 6000, "datadome"), (429, "x", "", "x", 9000, "blocked"),
)


@query(f"""
SELECT r.kind, count(*) AS responses FROM {P} JOIN (VALUES {", ".join(f"({i}, '{r[5]}')" for i, r in enumerate(RESPONSES))}) r(i, kind) ON k % {len(RESPONSES)} = r.i GROUP BY 1
""")
def block_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses for all products, with the marks of each kind of block and each kind of status, counted by what they are."""
    key, name = F.col("k"), F.col("p_name")
    of = lambda n: choice(key % len(RESPONSES), *[F.lit(r[n]) for r in RESPONSES])
    html = F.rpad(text(of(3), " ", name), of(4), " ")
    responses = products(spark, sf_dir).select(of(0).alias("status"), of(1).alias("title"), of(2).alias("url"), html.alias("html"))
    kind = extraction.page_class(F.col("status"), F.col("title"), F.col("url"), F.col("html"))
    return responses.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("responses"))


@query(f"""
SELECT k AS product, CASE WHEN k % 3 = 0 THEN CAST(s2 AS VARCHAR) WHEN k % 3 = 1 THEN CAST(s AS VARCHAR) END AS size, k % 4 = 0 AS has_chapters, CASE WHEN k % 4 < 3 THEN p_name END AS title,
  CASE k % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS stock, CASE k % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'MXN' END AS currency,
  s2 || 'U8' || CASE WHEN k % 2 = 0 THEN ',' || s2 || 'U7N' ELSE '' END AS models, p_name AS text,
  CASE WHEN k % 7 > 0 THEN CAST(floor(CAST(p_size AS DOUBLE) / CAST(s2 AS DOUBLE) * CAST(10000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) END AS saved FROM {P}
""")
def nested_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For all products: entries of a map by words in order, fields of whole and broken documents, stock, currency, own models, decoded text and what a change saves."""
    key, size, inches, name = F.col("k"), F.col("s"), F.col("s2"), F.col("p_name")
    both = F.create_map(F.lit("Weight"), F.lit("9"), F.lit("Screen size"), size.cast("string"), F.lit("Pantalla"), inches.cast("string"))
    table = F.when(key % 3 == 0, both).when(key % 3 == 1, F.create_map(F.lit("Weight"), F.lit("9"), F.lit("Screen size"), size.cast("string")))
    doc = choice(key % 4, text('{"chapters":[],"name":"', name, '"}'), text('{"title":"', name, '"}'), text('{"name":"', name, '","title":"x"}'), text('{"chapters":[],"name'))
    stock = choice(key % 5, F.lit("https://schema.org/InStock"), F.lit("SoldOut"), F.lit("LimitedAvailability"), F.lit("soon"))
    head, body = F.array(text(inches, "U8")), F.array(text(inches + 1, "X1"), text(inches + key % 2, "U7N"), text(inches, "Z"))
    out = products(spark, sf_dir).select(
        key.alias("product"), nested.kv_lookup(table, "pantalla|size").alias("size"), nested.has_path(doc, "chapters").alias("has_chapters"),
        F.when(F.try_parse_json(doc).isNotNull(), nested.any_path(doc, "name", "title")).alias("title"), nested.in_stock(stock).alias("stock"),
        nested.known_currency(choice(key % 3, F.lit(" eur "), F.lit("MXN"), F.lit("price"))).alias("currency"), F.array_join(nested.own_models(head, body), ",").alias("models"),
        nested.decoded(F.base64(name.cast("binary"))).alias("text"), nested.saved_share(F.when(key % 7 > 0, inches.cast("double")), F.lit(20.0)).alias("saved"),
    )
    return out


@query(f"""
SELECT k AS product, CAST(CASE k % 6 WHEN 0 THEN s2 * 1000 + k % 1000 WHEN 1 THEN s2 * 1000 + k % 1000 + k % 90 / 100.0 + 0.1 WHEN 2 THEN s2 + 0.99 WHEN 3 THEN s2 * 1000 + k % 1000 END AS DECIMAL(18, 2)) AS amount FROM {P}
""")
def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of all products as shops write them: separators of several countries, raised cents, marks after; what cannot be read is null, never 0."""
    key, inches = F.col("k"), F.col("s2")
    rest = F.lpad((key % 1000).cast("string"), 3, "0")
    decimals = F.lpad((key % 90 + 10).cast("string"), 2, "0")
    raw = choice(key % 6, text("$", inches, ",", rest, ".00"), text(inches, "&nbsp;", rest, ",", decimals, "€"), text(inches, "€<sup>99</sup>"), text(inches, ",", rest, " 円～"), F.lit("Saltar a"), F.lit(""))
    currency = choice(key % 6, *[F.lit(c) for c in ("USD", "EUR", "EUR", "JPY", "USD", "EUR")])
    return products(spark, sf_dir).select(key.alias("product"), money.money(raw, currency).alias("amount"))

"""Queries that write tables, files and states and read them back, and those of lists, site codes and named transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import money, urls
from tidemark.operators import extraction, matching, paging, reviews
from tidemark.plans.catalog import query
from tidemark.plans.config import Field, ShopSchema
from tidemark.plans.made import choice, text
from tidemark.sinks import state as states
from tidemark.sinks import tables as sinks
from tidemark.sources import tables
from tidemark.sources.tables import load, spread
from tidemark.streaming import breaker
from tidemark.streaming.run import available_now, table_stream, work_dir

PAGE_LIMIT, REVIEW_LIMIT = 5, 3


@query(f"""
WITH l AS (SELECT l_orderkey AS scope, CAST(l_linenumber - 1 AS BIGINT) AS page, CASE WHEN l_quantity >= 3 THEN l_suppkey % 4 END AS k FROM lineitem),
t AS (SELECT scope, count(*) + scope % 3 AS total FROM l GROUP BY scope),
u AS (SELECT DISTINCT scope, page, k FROM l WHERE page < {PAGE_LIMIT}),
f AS (SELECT scope, page, k, CASE WHEN k IS NOT NULL AND row_number() OVER (PARTITION BY scope, k ORDER BY page) = 1 THEN 1 ELSE 0 END AS new FROM u),
g AS (SELECT scope, page, count(k) AS n, sum(new) AS new_keys FROM f GROUP BY scope, page),
c AS (SELECT *, sum(new_keys) OVER (PARTITION BY scope ORDER BY page ROWS UNBOUNDED PRECEDING) AS seen FROM g),
s AS (SELECT c.*, CASE WHEN n = 0 THEN 'empty_page' WHEN new_keys = 0 THEN 'page_all_known' WHEN seen >= {REVIEW_LIMIT} THEN 'max_reviews' WHEN page + 1 >= total THEN 'exhausted'
  WHEN page + 1 >= {PAGE_LIMIT} THEN 'max_pages' END AS stop FROM c JOIN t USING (scope)),
r AS (SELECT *, count(stop) OVER (PARTITION BY scope ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS over FROM s)
SELECT scope, page, CAST(new_keys AS BIGINT) AS new_keys, CAST(greatest(least(new_keys, {REVIEW_LIMIT} - (seen - new_keys)), 0) AS BIGINT) AS taken, stop FROM r WHERE over = 0
""")
def review_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of reviews, a list for each order and a page for each line: how far each list is read, and what ends it."""
    key = F.when(F.col("l_quantity") >= 3, F.col("l_suppkey") % 4)
    line = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scope"), (F.col("l_linenumber") - 1).cast("long").alias("page"), key.alias("k"))
    stored = line.groupBy("scope", "page").agg(F.collect_set("k").alias("keys"), F.count(F.lit(1)).alias("rows"))
    totals = stored.groupBy("scope").agg((F.sum("rows") + F.col("scope") % 3).alias("total"))
    return paging.read_pages(stored.join(totals, "scope"), "scope", "page", "keys", "total", 1, PAGE_LIMIT, REVIEW_LIMIT)


@query(f"""
WITH b AS (SELECT p_brand AS brand, count(*) AS total, min(p_partkey) % 6 AS k FROM part GROUP BY p_brand),
l AS (SELECT *, 'https://shop.example/' || lower(replace(brand, '#', '-')) || CASE WHEN total % 2 = 0 THEN '?sort=new' ELSE '' END AS url,
  CASE WHEN k = 0 THEN 1 ELSE least(greatest(CAST(ceil(CASE WHEN k = 5 THEN least(total, 100) ELSE total END / 30.0) AS BIGINT), 1), 50) END AS pages FROM b),
p AS (SELECT *, unnest(range(1, pages + 1)) AS page FROM l)
SELECT brand, {"CASE k " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(paging.KINDS)) + " END"} AS kind, page, (page - 1) * 30 AS start,
  CASE k WHEN 1 THEN url || '/page/' || page WHEN 2 THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'firstResult=' || (page - 1) * 30
    WHEN 5 THEN url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'offset=' || (page - 1) * 30 || '&limit=30' ELSE url END AS address FROM p
""")
def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each brand's list of products, by each kind of pagination."""
    total = F.count(F.lit(1)).alias("total")
    brands = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(total, (F.min("p_partkey") % 6).alias("k"))
    url = F.concat(F.lit("https://shop.example/"), F.lower(F.replace("brand", F.lit("#"), F.lit("-"))), F.when(F.col("total") % 2 == 0, "?sort=new").otherwise(""))
    lists = brands.withColumns({"url": url, "kind": choice(F.col("k"), *map(F.lit, paging.KINDS))})
    return paging.page_addresses(lists, "url", "kind", "total", 30, 50, "firstResult", 100).select("brand", "kind", "page", "start", "address")


@query("""
WITH p AS (SELECT p_partkey AS k, lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code FROM part)
SELECT k AS p_partkey, CASE k % 5 WHEN 0 THEN 'a' || code WHEN 1 THEN 'B07' || code || 'X' WHEN 2 THEN 'HBV' || code END AS sku, CASE k % 5 WHEN 3 THEN CAST(k AS VARCHAR) END AS review FROM p
""")
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shop's own numbers of products and reviews, read from addresses of all products in five forms."""
    part, k = load(spark, sf_dir, "part"), F.col("p_partkey")
    code = F.lpad(k.cast("string"), 6, "0")
    url = choice(
        k % 5, text("https://a.example/f-1070-a", code, ".html?x=1"), text("https://b.example/dp/B07", code, "X/ref=1"), text("https://c.example/tv-p-HBV", code, "?q=2"),
        text("https://d.example/review/?ReviewCD=", k, "&p=1"), text("https://e.example/p/", code, "/dp/short"),
    )
    return part.select("p_partkey", url.alias("url")).select("p_partkey", urls.sku(F.col("url")).alias("sku"), urls.review_number(F.col("url")).alias("review"))


@query("""
WITH s AS (SELECT CASE s_nationkey % 6 WHEN 0 THEN 'RUB' WHEN 1 THEN 'CAD' WHEN 2 THEN 'EUR' WHEN 3 THEN 'JPY' WHEN 4 THEN 'MXN' END AS currency, s_acctbal FROM supplier)
SELECT currency, count(*) AS sites, CAST(sum(CAST(floor(s_acctbal) AS BIGINT)) AS BIGINT) AS balance FROM s GROUP BY currency
""")
def site_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by the currency of their site's code; codes without a known country have none."""
    ends = [F.lit(x) for x in ("_ru", "_CA", "_de", "_jp", "_mx", "_zz")]
    code = F.concat(F.lit("shop"), F.col("s_suppkey").cast("string"), choice(F.col("s_nationkey") % 6, *ends))
    sites = load(spark, sf_dir, "supplier").select(money.site_currency(code).alias("currency"), F.floor("s_acctbal").alias("b"))
    return sites.groupBy("currency").agg(F.count(F.lit(1)).alias("sites"), F.sum("b").cast("long").alias("balance"))


SHOP = ShopSchema(
    "shop_mx", "https://shop.example/?q={q}", "MXN",
    fields=(
        Field("brand", ("<b>(.*?)</b>",), transform="brand"), Field("price", ("<i>(.*?)</i>",), transform="liverpool_money"),
        Field("currency", ("<h1>(.*?)</h1>",), transform="currency_mx"), Field("rating", ("<em>(.*?)</em>",), transform="rating"),
    ),
)


@query("""
SELECT p_partkey, replace(p_brand, '#', ' ') AS brand, CASE WHEN p_size % 3 > 0 THEN CAST(p_partkey * 12345 % 9999999 / CAST(100 AS DOUBLE) AS DECIMAL(18,2)) END AS price,
  CASE WHEN p_size % 4 > 0 THEN 'MXN' END AS currency, CAST(p_size % 5 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS rating FROM part
""")
def named_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of product pages by the transforms that a shop's schema names: brand, peso price, currency and rating."""
    part, cents = load(spark, sf_dir, "part"), F.col("p_partkey") * 12345 % 9999999
    price = F.concat(F.lit("antes <s>12</s> $"), F.format_number(cents / F.lit(100.0), 2), F.when(F.col("p_size") % 3 > 0, " MXN").otherwise("9"))
    brand = F.concat(choice(F.col("p_size") % 3, F.lit("Marca: "), F.lit("by "), F.lit("")), F.replace("p_brand", F.lit("#"), F.lit("&nbsp;")))
    html = F.concat(
        F.lit("<h1>"), F.when(F.col("p_size") % 4 > 0, F.col("p_name")).otherwise(" "), F.lit("</h1><b>"), brand, F.lit("</b><i>"), price, F.lit("</i><em>"),
        (F.col("p_size") % 5).cast("string"), F.lit(",5 de 5</em>"),
    )
    found = SHOP.extract(part.select("p_partkey", html.alias("html")))
    return found.select("p_partkey", "brand", "price", "currency", "rating")


@query("""
WITH p AS (SELECT p_brand, p_partkey, 'https://' || CASE p_partkey % 2 WHEN 0 THEN 'Acme' ELSE 'other' END || '.example/' || CASE p_partkey % 3 WHEN 0 THEN 'TV' ELSE 'fridge' END || '-' || p_partkey
  || CASE p_partkey % 5 WHEN 0 THEN '-wall-mount' WHEN 1 THEN '-Remote' ELSE '' END AS url FROM part)
SELECT p_brand, count(*) AS urls, count(CASE WHEN p_partkey % 2 = 0 AND p_partkey % 3 = 0 AND p_partkey % 5 NOT IN (0, 1) THEN 1 END) AS kept, min(CASE WHEN p_partkey % 30 IN (12, 18, 24) THEN url END) AS first FROM p GROUP BY p_brand
""")
def sitemap_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of a sitemap made of all products: those that name the brand and a set, and no accessory."""
    k = F.col("p_partkey")
    url = text("https://", F.when(k % 2 == 0, "Acme").otherwise("other"), ".example/", F.when(k % 3 == 0, "TV").otherwise("fridge"), "-", k, F.when(k % 5 == 0, "-wall-mount").when(k % 5 == 1, "-Remote").otherwise(""))
    kept = extraction.brand_sitemap(F.col("url"), "acme")
    made = load(spark, sf_dir, "part").select("p_brand", url.alias("url"))
    return made.groupBy("p_brand").agg(F.count(F.lit(1)).alias("urls"), F.count_if(kept).alias("kept"), F.min(F.when(kept, F.col("url"))).alias("first"))


@query("""
WITH l AS (SELECT l_partkey, count(*) AS n, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS back FROM lineitem GROUP BY l_partkey),
p AS (SELECT n, CAST(back AS INT) AS back FROM part LEFT JOIN l ON l_partkey = p_partkey)
SELECT coalesce(back > 0, false) AS has_reviews, CASE WHEN coalesce(n, 0) < 1 OR coalesce(back, 0) % 4 = 3 THEN 'failed' ELSE 'no_item' END AS outcome, count(*) AS products FROM p GROUP BY 1, 2
""")
def review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by whether they have reviews (here returns), and by what a search without a match says about them."""
    line = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("back"))
    both = load(spark, sf_dir, "part").join(line, F.col("l_partkey") == F.col("p_partkey"), "left")
    said = matching.outcome(F.coalesce("n", F.lit(0)), F.coalesce("back", F.lit(0)) % 4 == 3)
    return both.groupBy(reviews.has_reviews(F.col("back")).alias("has_reviews"), said.alias("outcome")).agg(F.count(F.lit(1)).alias("products"))


@query("""
WITH p AS (SELECT p_brand, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE CAST(floor(p_retailprice) AS BIGINT) END AS had, CASE WHEN p_partkey % 8 < 6 THEN CAST(floor(p_retailprice) AS BIGINT) END AS raw FROM part),
r AS (SELECT p_brand, had, CASE WHEN coalesce(had, 0) = 0 THEN raw ELSE had END AS price FROM p)
SELECT p_brand, count(CASE WHEN coalesce(had, 0) = 0 THEN 1 END) AS missing, count(*) - count(price) AS left_missing, CAST(sum(price) AS BIGINT) AS total FROM r GROUP BY p_brand
""")
def price_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that are missing or 0 taken from the raw text, and how many stay missing because it has none."""
    k, full = F.col("p_partkey"), F.floor("p_retailprice")
    had = F.when(k % 4 == 0, None).when(k % 4 == 1, 0).otherwise(full).cast("long")
    raw = F.when(k % 8 < 6, F.concat(F.format_number(full.cast("double"), 0), F.lit(" 円～"))).otherwise("在庫なし")
    made = spread(load(spark, sf_dir, "part"), "p_partkey").select("p_brand", had.alias("had"), had.alias("price"), raw.alias("raw"))
    fixed = sinks.update_where_missing(made, "price", money.money(F.col("raw"), F.lit("JPY")).cast("long"))
    missing = F.count_if(F.coalesce("had", F.lit(0)) == 0).alias("missing")
    return fixed.groupBy("p_brand").agg(missing, F.count_if(F.col("price").isNull()).alias("left_missing"), F.sum("price").alias("total"))


@query("""
WITH l AS (SELECT strftime(l_shipdate, '%Y') AS year, l_orderkey % 100 AS lot, l_quantity AS q FROM lineitem),
t AS (SELECT year, CASE WHEN year = '1997' THEN q + 1 ELSE q END AS q, lot FROM l)
SELECT 'kept' AS what, year, count(*) AS rows, CAST(sum(q) AS BIGINT) AS quantity FROM t WHERE lot >= 10 GROUP BY year
UNION ALL SELECT 'gone', year, count(*), CAST(sum(q) AS BIGINT) FROM t WHERE lot < 10 GROUP BY year
UNION ALL SELECT 'new', year, count(DISTINCT lot), CAST(sum(DISTINCT lot) AS BIGINT) FROM l GROUP BY year
""")
def store_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table appended to by years, one year replaced, keys inserted once, and lots backed up before they are deleted: what each table then holds."""
    where = work_dir(spark)
    line = load(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy").alias("year"), (F.col("l_orderkey") % 100).alias("lot"), F.col("l_quantity").alias("q"))
    read = lambda name: spark.read.schema("lot long, q double, year string").parquet(sinks.target(spark, f"{where}/{name}"))
    odd = F.col("year").cast("int") % 2 == 1
    for part in (line.filter(odd), line.filter(~odd)):
        sinks.append_snapshot(part, f"{where}/all", "year")
        sinks.insert_new(part.withColumn("q", F.col("lot").cast("double")), f"{where}/new", ["year", "lot"], ["q"], "year")
    sinks.insert_new(line.withColumn("q", F.col("lot").cast("double")), f"{where}/new", ["year", "lot"], ["q"], "year")
    sinks.replace_partitions(line.filter("year = '1997'").withColumn("q", F.col("q") + 1), f"{where}/all", "year")
    sinks.backup_then_delete(read("all"), F.col("lot") < 10, f"{where}/gone", f"{where}/kept")
    held = [read(name).withColumn("what", F.lit(name)) for name in ("kept", "gone", "new")]
    return held[0].unionByName(held[1]).unionByName(held[2]).groupBy("what", "year").agg(F.count(F.lit(1)).alias("rows"), F.sum("q").cast("long").alias("quantity"))


@query("""
SELECT p_brand AS brand, count(*) AS models, count(DISTINCT p_name) AS names, min('电视 "' || p_name || '", ' || p_size || ' 寸') AS first, CAST(sum(p_size) AS BIGINT) AS sizes, true AS alike FROM part GROUP BY p_brand
""")
def model_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of models written as CSV in GB18030 and in UTF-8 and read again: quotes, commas and both encodings come back alike."""
    where = work_dir(spark)
    name = text('电视 "', F.col("p_name"), '", ', F.col("p_size"), " 寸")
    models = load(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), "p_name", name.alias("title"), F.col("p_size").cast("long").alias("size"))
    found = []
    for encoding in ("GB18030", "UTF-8"):
        # The session allows Java's encodings before it writes in one.
        tables.csv(spark, sf_dir, "x string", "GB18030")
        models.write.option("header", True).option("escape", '"').option("encoding", encoding).csv(f"{where}/{encoding}")
        read = tables.csv(spark, f"{where}/{encoding}", "brand string, p_name string, title string, size long", encoding, escape='"')
        sums = F.count(F.lit(1)).alias("models"), F.count_distinct("p_name").alias("names"), F.min("title").alias("first"), F.sum("size").alias("sizes")
        found.append(read.groupBy("brand").agg(*sums))
    both = found[0].join(found[1].select(F.col("brand").alias("_b"), F.struct("models", "names", "first", "sizes").alias("_o")), F.col("brand") == F.col("_b"))
    return both.select("brand", "models", "names", "first", "sizes", F.struct("models", "names", "first", "sizes").eqNullSafe(F.col("_o")).alias("alike"))


@query("""
SELECT p_brand AS brand, p_type AS series, count(*) AS models, CAST(max(p_size) AS BIGINT) AS largest, CASE WHEN min(p_partkey) % 2 = 0 THEN 'x' END AS note FROM part GROUP BY p_brand, p_type
""")
def spec_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document over several lines for each brand and series, read as documents; an absent field is null."""
    where = work_dir(spark)
    sums = F.count(F.lit(1)).alias("models"), F.max("p_size").alias("largest"), F.min("p_partkey").alias("k")
    series = load(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(*sums)
    note = F.when(F.col("k") % 2 == 0, ',\n  "note": "x"').otherwise("")
    doc = text('{\n  "brand": "', F.col("p_brand"), '",\n  "series": {"name": "', F.col("p_type"), '",\n    "models": ', F.col("models"), ',\n    "largest": ', F.col("largest"), "}", note, "\n}")
    # A file for each 1000 series or so holds a list of documents, so no task holds more, however many series there are.
    files = F.pmod(F.xxhash64("p_brand", "p_type"), F.lit(-(-series.count() // 1000) or 1)).alias("file")
    lists = series.select(doc.alias("doc"), files).groupBy("file").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("doc"), ",\n"), F.lit("\n]")).alias("value"))
    lists.write.partitionBy("file").text(where)
    read = tables.json_document(spark, where, "brand string, series struct<name: string, models: long, largest: long>, note string")
    return read.select("brand", F.col("series.name").alias("series"), "series.models", "series.largest", "note")


@query("""
SELECT p_brand, CASE p_size % 5 WHEN 0 THEN 'title' WHEN 1 THEN 'price,title' WHEN 2 THEN '' ELSE 'price' END AS missing, p_size % 4 = 0 AS only_default, count(*) AS products FROM part GROUP BY 1, 2, 3
""")
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields that documents of all products lack, and whether a document refers to nothing but the default."""
    s, where = F.col("p_size"), work_dir(spark)
    fields = F.concat_ws(", ", text('"brand": "', F.col("p_brand"), '"'), F.when(s % 5 >= 2, '"title": "t"'), F.when(s % 5 < 1, '"price": 1').when(s % 5 == 2, '"price": 2'))
    ref = F.when(s % 4 == 0, '["_", "_"]').otherwise('["_", "a"]')
    load(spark, sf_dir, "part").select(text("{", fields, ', "ref": ', ref, "}").alias("value")).write.text(where)
    read = tables.json_lines(spark, where, ("price", "title"))
    ref = F.expr("try_variant_get(doc, '$.ref', 'array<string>')")
    brand, missing = F.expr("try_variant_get(doc, '$.brand', 'string')"), F.array_join("missing", ",")
    return read.groupBy(brand.alias("p_brand"), missing.alias("missing"), (F.size(F.array_except(ref, F.array(F.lit("_")))) == 0).alias("only_default")).agg(F.count(F.lit(1)).alias("products"))


@query("""
WITH w AS (SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_item' WHEN 2 THEN 'failed' END AS first, CASE WHEN p_partkey % 5 = 2 AND p_partkey % 2 = 0 THEN 'ok' END AS second FROM part),
s AS (SELECT k, coalesce(second, first) AS status FROM w)
SELECT coalesce(status, 'new') AS status, count(*) AS sites, count(CASE WHEN status IS NULL OR status = 'failed' THEN 1 END) AS left_over FROM s GROUP BY 1
""")
def state_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of work on all products, written, read, advanced by a second run and read again: what is done and what is left."""
    where, k = work_dir(spark), F.col("p_partkey")
    work = load(spark, sf_dir, "part").select(k.alias("site"))
    schema = "site long, status string, at long"
    status = F.when(k % 5 == 0, "ok").when(k % 5 == 1, "no_item").when(k % 5 == 2, "failed")
    first = load(spark, sf_dir, "part").filter(k % 5 < 3).select(k.alias("site"), status.alias("status"), F.lit(1).cast("long").alias("at"))
    states.write_state(first, where)
    again = states.left_to_do(work, states.read_state(spark, where, schema), "site", "status").filter((F.col("site") % 5 == 2) & (F.col("site") % 2 == 0))
    states.write_state(states.advance(states.read_state(spark, where, schema), again.selectExpr("site", "'ok' AS status", "2L AS at"), "site", "at"), where)
    held = states.read_state(spark, where, schema)
    left = states.left_to_do(work, held, "site", "status").withColumn("left", F.lit(1))
    both = work.join(held, "site", "left").join(left, "site", "left")
    return both.groupBy(F.coalesce("status", F.lit("new")).alias("status")).agg(F.count(F.lit(1)).alias("sites"), F.count("left").alias("left_over"))


@query("""
WITH w AS (SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS started, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT started, event_type, n FROM w WHERE started + INTERVAL 14 DAY <= (SELECT max(ts) FROM events)
""")
def weekly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly counts by the stream: a week comes out once the watermark, a week behind the latest event, has passed its end."""
    events = table_stream(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    closed = available_now(breaker.weekly_counts(events, "ts", ["event_type"]))
    return closed.select(F.col("window.start").cast("timestamp_ntz").alias("started"), "event_type", "n")


@query("""
WITH p AS (SELECT p_brand AS brand, p_type AS model, p_partkey % 3 AS shop, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part)
SELECT brand, model, false AS is_header, min(CASE WHEN shop = 0 THEN price END) AS shop0, min(CASE WHEN shop = 1 THEN price END) AS shop1, min(CASE WHEN shop = 2 THEN price END) AS shop2 FROM p GROUP BY brand, model
UNION ALL SELECT DISTINCT brand, NULL, true, NULL, NULL, NULL FROM p
""")
def price_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price sheet written as CSV and read again: a header row for each brand, then its models with the lowest price of each shop."""
    shops = ["shop0", "shop1", "shop2"]
    made = load(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("model"), F.concat(F.lit("shop"), (F.col("p_partkey") % 3).cast("string")).alias("shop"), F.floor("p_retailprice").alias("price"))
    path = sinks.export_csv(sinks.grouped_sheet(made, "brand", "model", "shop", "price", shops), work_dir(spark), "us", "20261128")
    return tables.csv(spark, path, "brand string, model string, is_header boolean, shop0 long, shop1 long, shop2 long")

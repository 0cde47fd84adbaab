"""Queries over stored pages and files, made of the products and pages of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.operators import extraction, html, incremental, matching, payloads
from tidemark.operators.ranking import number_rows
from tidemark.plans.catalog import query
from tidemark.sources import pages as cache
from tidemark.sources import sitemaps, tables
from tidemark.sources.tables import load, spread
from tidemark.streaming.run import work_dir

#: Shards of the made sitemap: how many, the one that is done, the one cut short and the one that is not stored.
SHARDS, DONE, CUT, ABSENT = 38, 7, 11, 23


@query(f"""
WITH p AS (SELECT page_id % {SHARDS} AS n, url FROM pages WHERE url IS NOT NULL),
c AS (SELECT s.n, count(url) AS urls, min(url) AS first, max(url) AS last FROM (SELECT range AS n FROM range({SHARDS})) s LEFT JOIN p ON s.n = p.n GROUP BY s.n)
SELECT CAST(run AS INT) AS run, 'shard-' || n || '.xml' AS shard, CASE WHEN n = {ABSENT} THEN 0 ELSE urls END AS urls, CASE n WHEN {CUT} THEN 'shortened' WHEN {ABSENT} THEN 'absent' END AS reason,
  CASE WHEN n NOT IN ({CUT}, {ABSENT}) THEN first END AS first, CASE WHEN n NOT IN ({CUT}, {ABSENT}) THEN last END AS last
FROM c, (VALUES (1), (2)) r(run) WHERE n <> {DONE} AND (run = 1 OR n IN ({CUT}, {ABSENT}))
""")
def sitemap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of all pages, stored as an index and gzip shards, read in two runs: the second reads what the first could not."""
    where = work_dir(spark)
    name = lambda n: F.concat(F.lit("shard-"), n.cast("string"), F.lit(".xml"))
    escaped = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    pages = load(spark, sf_dir, "pages").filter("url IS NOT NULL").select(F.pmod("page_id", F.lit(SHARDS)).alias("n"), F.lit(1).alias("part"), F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>")).alias("value"))
    frame = spark.range(SHARDS).select(F.col("id").alias("n"), F.inline(F.array(*[F.struct(F.lit(k).alias("part"), F.lit(v).alias("value")) for k, v in ((0, '<?xml version="1.0"?><urlset>'), (2, "</urlset>"))])))
    lines = pages.unionByName(frame).filter((F.col("n") != ABSENT) & ~((F.col("n") == CUT) & (F.col("part") == 2))).withColumn("shard", name(F.col("n")))
    dealt = lines.repartition(SHARDS, "shard").sortWithinPartitions("shard", "part").select("value", "shard")
    dealt.write.partitionBy("shard").option("compression", "gzip").text(f"{where}/shards")
    entry = F.concat(F.lit("<sitemap><loc>https://shop.example/"), name(F.col("id")), F.lit("</loc></sitemap>"))
    index = spark.range(0, SHARDS, 1, 1).groupBy().agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</sitemapindex>")).alias("value"))
    index.write.text(f"{where}/index")
    spark.range(1).select(F.lit(f"shard-{DONE}.xml").alias("shard")).write.parquet(f"{where}/catalog/done")
    runs = [sitemaps.read_left(spark, f"{where}/index", f"{where}/shards", f"{where}/catalog").withColumn("run", F.lit(i)) for i in (1, 2)]
    held = sitemaps.urls(spark, f"{where}/catalog").groupBy("shard").agg(F.min("url").alias("first"), F.max("url").alias("last"))
    return runs[0].unionByName(runs[1]).join(held, "shard", "left").select("run", "shard", "urls", "reason", "first", "last")


def joined(rows: DataFrame, by: str, order: str, text: str, start: str, end: str) -> DataFrame:
    """A page for each value of ``by``: texts in order between start and end."""
    held = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(by).agg(F.concat(F.lit(start), F.array_join(F.transform(held, lambda x: x[text]), ""), F.lit(end)).alias("html"))


CARD = """'<div class="card ' || p_type || '"><h3>' || p_name || '</h3><p>' || (p_size % 3) || ' in stock</p></div>'"""


@query(f"""
WITH c AS (SELECT p_partkey // 200 AS page_id, length({CARD}) AS n, row_number() OVER (PARTITION BY p_partkey // 200, p_type, p_name, p_size % 3 ORDER BY p_partkey) AS place FROM part),
s AS (SELECT page_id, count(*) AS cards, count(CASE WHEN place > 1 THEN 1 END) AS removed, CAST(sum(n) AS BIGINT) + {len("<body><main>") + len("</main><footer>end</footer></body>")} AS before, coalesce(CAST(sum(CASE WHEN place > 1 THEN n END) AS BIGINT), 0) AS gone FROM c GROUP BY page_id)
SELECT page_id, CAST(removed AS INT) AS removed, before, before - gone AS after FROM s
""")
def card_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 200 product cards each, without the cards that repeat an earlier one: how many, and characters before and after."""
    card = F.concat(F.lit('<div class="card '), "p_type", F.lit('"><h3>'), "p_name", F.lit("</h3><p>"), (F.col("p_size") % 3).cast("string"), F.lit(" in stock</p></div>"))
    cards = load(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 200).alias("page_id"), "p_partkey", card.alias("card"))
    pages = joined(cards, "page_id", "p_partkey", "card", "<body><main>", "</main><footer>end</footer></body>")
    return html.pruned(pages, "page_id", "html").select("page_id", "removed", "before", "after")


@query()
def page_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pages without repeated cards; that a page's elements need a parser is why there is no SQL."""
    return html.pruned(load(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "removed", "before", "after")


@query("""
SELECT p_partkey AS page_id, chapter, item, value FROM part, (VALUES (1), (2), (3), (4)) k(k),
  LATERAL (SELECT CASE WHEN k < 3 THEN 'General & more' ELSE 'Size' END AS chapter, CASE k WHEN 1 THEN 'Name' WHEN 2 THEN 'Brand' WHEN 3 THEN 'Inches' ELSE 'Kind' END AS item,
    CASE k WHEN 1 THEN p_name WHEN 2 THEN p_brand WHEN 3 THEN CAST(p_size AS VARCHAR) ELSE p_type END AS value)
""")
def spec_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter, item and value of specification pages, one for each product: tables with open cells, and definition lists."""
    page = F.concat(
        F.lit("<h2>General &amp; more</h2><script>var t='<td>no</td>'</script><table><tr><th>Name<td>"), "p_name", F.lit("<tr><td>Brand</td><td><b>"), "p_brand",
        F.lit('</b></td></tr></table><h3>Size</h3><dl><dt>Inches<dd title="a > b">'), F.col("p_size").cast("string"), F.lit("<dt>Kind</dt><dd>"), "p_type", F.lit("</dd></dl><p>end"),
    )
    return html.page_triples(spread(load(spark, sf_dir, "part"), "p_partkey").select("p_partkey", page.alias("page")), "p_partkey", "page")


def cents() -> Column:
    """A product's price as text with two decimals."""
    c = F.round(F.col("p_retailprice") * 100).cast("long")
    return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"
AMOUNT = f"CAST(CAST({CENTS} // 100 AS VARCHAR) || '.' || lpad(CAST({CENTS} % 100 AS VARCHAR), 2, '0') AS DECIMAL(18, 2))"


def ld(body: Column) -> Column:
    return F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))


def product(name: Column) -> Column:
    """A product's JSON."""
    return F.concat(F.lit('{"@type":"Product","name":"'), name, F.lit('","offers":{"price":"'), cents(), F.lit('"}}'))


@query(f"""
WITH r AS (
  SELECT p_partkey AS page_id, 'ld' AS kind, 0 AS place, n, p_name || CASE n WHEN 0 THEN '' ELSE ' b' END AS name, {AMOUNT} AS price FROM part, (VALUES (0), (1)) v(n) WHERE p_partkey % 6 = 0
  UNION ALL SELECT p_partkey, 'ld', 1, NULL, NULL, NULL FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT p_partkey, 'page', 0, 0, p_name, {AMOUNT} FROM part WHERE p_partkey % 6 = 1
  UNION ALL SELECT p_partkey, 'stream', 0, 0, p_name, {AMOUNT} FROM part WHERE p_partkey % 6 = 2
  UNION ALL SELECT p_partkey, 'data-info', n, 0, p_name || CASE n WHEN 0 THEN '' ELSE ' & <c>' END, {AMOUNT} FROM part, (VALUES (0), (1)) v(n) WHERE p_partkey % 6 = 3
  UNION ALL SELECT p_partkey, 'ld', n, k, p_name || CASE WHEN n = 0 THEN ' g' ELSE ' l' END || k, {AMOUNT} FROM part, (VALUES (0), (1)) v(n), (VALUES (0), (1)) w(k) WHERE p_partkey % 6 = 4)
SELECT page_id, kind, CAST(place AS BIGINT) AS place, CAST(n AS BIGINT) AS n, name, price FROM r
""")
def inline_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product in pages made of the products: lists of linked data (one script broken), page data, streams, widgets, graphs and item lists."""
    p = product
    name, quoted = F.col("p_name"), lambda x: F.replace(F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    plus = lambda x: F.concat(name, F.lit(x))
    pushed = F.replace(p(name), F.lit('"'), F.lit('\\"'))
    push = lambda x: F.concat(F.lit('<script>self.__next_f.push([1,"'), x, F.lit('"])</script>'))
    page = (
        F.when(F.col("k") == 0, F.concat(ld(F.concat(F.lit("["), p(name), F.lit(","), p(plus(" b")), F.lit("]"))), ld(F.lit('{"broken'))))
        .when(F.col("k") == 1, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), p(name), F.lit("</script>")))
        .when(F.col("k") == 2, F.concat(push(F.substring(pushed, F.lit(1), F.lit(20))), F.lit("<p>between</p>"), push(F.substring(pushed, F.lit(21), F.length(pushed)))))
        .when(F.col("k") == 3, F.concat(F.lit('<div data-info="'), quoted(p(name)), F.lit('"></div><i data-info="'), quoted(p(plus(" & <c>"))), F.lit('"></i>')))
        .when(
            F.col("k") == 4,
            F.concat(
                ld(F.concat(F.lit('{"@graph":['), p(plus(" g0")), F.lit(","), p(plus(" g1")), F.lit("]}"))),
                ld(F.concat(F.lit('{"@type":"ItemList","itemListElement":[{"position":1,"item":'), p(plus(" l0")), F.lit("},"), p(plus(" l1")), F.lit("]}"))),
            ),
        )
        .otherwise(F.lit("<p>nothing</p>"))
    )
    pages = spread(load(spark, sf_dir, "part"), "p_partkey").withColumn("k", F.pmod("p_partkey", F.lit(6))).select(F.col("p_partkey").alias("page_id"), page.alias("html"))
    found = payloads.things(payloads.payloads(pages, "html", ["page_id"]))
    price = payloads.text_at(F.col("thing"), "$.offers.price").try_cast("decimal(18,2)")
    return found.select("page_id", "kind", F.col("at").alias("place"), "n", payloads.text_at(F.col("thing"), "$.name").alias("name"), price.alias("price"))


@query(f"""
SELECT p_partkey AS page_id, p_partkey % 5 <> 4 AS valid, CASE WHEN p_partkey % 5 IN (0, 1) THEN {AMOUNT} END AS price,
  CASE p_partkey % 5 WHEN 0 THEN {AMOUNT} WHEN 1 THEN CAST({AMOUNT} + 200 AS DECIMAL(18, 2)) END AS of_65 FROM part
""")
def jsonld_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices out of linked data made of the products: product, variants, lists of offers, searches and broken scripts."""
    more = F.concat((F.floor(F.round(F.col("p_retailprice") * 100).cast("long") / 100) + 200).cast("string"), F.lit("."), F.substring_index(cents(), ".", -1))
    k = F.pmod("p_partkey", F.lit(5))
    body = (
        F.when(k == 0, product(F.col("p_name")))
        .when(k == 1, F.concat(F.lit('{"@type":"ProductGroup","hasVariant":[{"size":"55","offers":{"price":"'), cents(), F.lit('"}},{"size":"65","offers":{"price":"'), more, F.lit('"}}]}')))
        .when(k == 2, F.concat(F.lit('{"@type":"Product","offers":{"@type":"AggregateOffer","lowPrice":"'), cents(), F.lit('"}}')))
        .when(k == 3, F.concat(F.lit('{"@type":"Product","url":"https://x.example/search?q='), "p_name", F.lit('","offers":{"price":"'), cents(), F.lit('"}}')))
        .otherwise(F.lit("{broken"))
    )
    docs = spread(load(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").alias("page_id"), F.explode(extraction.json_ld(ld(body))).alias("doc"))
    good = F.when(F.try_parse_json("doc").isNotNull(), F.col("doc"))
    return docs.select("page_id", good.isNotNull().alias("valid"), extraction.ld_price(good).alias("price"), extraction.ld_price(good, F.lit("65")).alias("of_65"))


@query(f"""
SELECT p_partkey AS product, CASE WHEN p_partkey % 4 < 3 THEN CAST(p_partkey * 10 + i AS VARCHAR) END AS item, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(p_size + 20 AS VARCHAR) || 'U' || (p_partkey % 10) || 'N' END AS model,
  CASE WHEN p_partkey % 4 < 2 AND i = 0 THEN CAST({AMOUNT} AS DOUBLE) END AS price
FROM part, (VALUES (0), (1)) v(i) WHERE i = 0 OR p_partkey % 4 < 3
""")
def nested_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three levels of catalogue answers made of the products, 50 products each, flattened; what is missing stays null and keeps its row."""
    key, k = F.col("p_partkey"), F.pmod("p_partkey", F.lit(4))
    title = F.concat(F.lit("TV "), F.when(key % 3 != 0, F.concat((F.col("p_size") + 20).cast("string"), F.lit("U"), F.pmod(key, F.lit(10)).cast("string"), F.lit("N"))).otherwise(F.lit("LED")))
    offer = F.when(k < 2, F.concat(F.lit('[{"commertialOffer":{"Price":'), cents(), F.lit(',"ListPrice":9999}}]'))).otherwise(F.lit('[{"commertialOffer":{"Price":null}}]'))
    item = lambda i, sellers: F.concat(F.lit('{"itemId":"'), (key * 10 + i).cast("string"), F.lit('","sellers":'), sellers, F.lit("}"))
    items = F.when(k < 3, F.concat(item(0, offer), F.lit(","), item(1, F.lit("[]")))).otherwise(F.lit(""))
    one = F.concat(F.lit('{"productId":"'), key.cast("string"), F.lit('","productName":"'), title, F.lit('","items":['), items, F.lit("]}"))
    parts = load(spark, sf_dir, "part").select(F.floor(key / 50).alias("answer"), "p_partkey", one.alias("one"))
    docs = parts.groupBy("answer").agg(F.concat(F.lit('{"products":['), F.array_join(F.collect_list("one"), ","), F.lit("]}")).alias("doc"))
    found = extraction.api_rows(docs, "doc", "products", {"product": "productId", "title": "productName", "items": "items"}, ["answer"])
    rows = found.select("product", "title", F.explode_outer(F.from_json("items", "array<struct<itemId:string,sellers:array<struct<commertialOffer:struct<Price:double,ListPrice:double>>>>>")).alias("i"))
    price = F.get(F.col("i.sellers"), F.lit(0))["commertialOffer"]["Price"]
    return rows.select(F.col("product").cast("long").alias("product"), F.col("i.itemId").alias("item"), urls.model_in_title(F.col("title")).alias("model"), price.alias("price"))


#: Names as one brand's pages have them: fixed values of the specification's example.
PATHS = payloads.SpecPaths("specification", "csChapter", "csChapterName", "csItem", "csItemName", "csValue", "csValueName")


@query("""
WITH m AS (SELECT p_brand AS series, CAST(p_partkey AS VARCHAR) AS model FROM part WHERE p_size <= 5),
s AS (SELECT p_brand AS series, min(p_partkey) AS k FROM part GROUP BY 1), p AS (SELECT s.series, part.* FROM s JOIN part ON p_partkey = k),
r AS (SELECT series, 0 AS chapter_order, 'Display' AS chapter, 0 AS row_order, 'Size' AS item, p_size || ' / ' || (p_size + 1) AS value FROM p
  UNION ALL SELECT series, 0, 'Display', 1, 'Panel', CASE WHEN p_size % 2 = 0 THEN p_type END FROM p
  UNION ALL SELECT series, 1, 'Audio', 0, NULL, NULL FROM p)
SELECT series, model, CAST(chapter_order AS BIGINT) AS chapter_order, chapter, CAST(row_order AS BIGINT) AS row_order, item, value FROM r JOIN m USING (series)
""")
def spec_rows_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters, items and joined values of JSON embedded in a page of each series, for each model of the series."""
    size = F.col("p_size").cast("string")
    named = lambda text: F.concat(F.lit('{"csValueName":"'), text, F.lit('"}'))
    panel = F.when(F.col("p_size") % 2 == 0, named(F.col("p_type"))).otherwise(F.lit(""))
    doc = F.concat(
        F.lit('{"specification":{"csChapter":[{"csChapterName":"Display","csItem":[{"csItemName":"Size","csValue":['), named(size), F.lit(","), named((F.col("p_size") + 1).cast("string")),
        F.lit(']},{"csItemName":"Panel","csValue":['), panel, F.lit(']}]},{"csChapterName":"Audio","csItem":[]}]}}'),
    )
    part = load(spark, sf_dir, "part")
    page = F.concat(F.lit('<p>x</p><script id="__NEXT_DATA__" type="application/json">'), doc, F.lit("</script>"))
    pages = part.groupBy(F.col("p_brand").alias("series")).agg(F.min_by(page, "p_partkey").alias("html"))
    rows = payloads.spec_rows(payloads.payloads(pages, "html", ["series"]).filter("kind = 'page'"), "doc", ["series"], PATHS)
    models = part.filter("p_size <= 5").select(F.col("p_brand").alias("series"), F.col("p_partkey").cast("string").alias("model"))
    return payloads.for_models(rows, models, ["series"]).select("series", "model", "chapter_order", "chapter", "row_order", "item", "value")


CODE = "CASE p_partkey % 7 WHEN 0 THEN CAST(p_size + 20 AS VARCHAR) || 'U' || (p_partkey % 40) || 'N-PRO' WHEN 1 THEN 'U' || (p_partkey % 40) || 'N' ELSE CAST(p_size + 20 AS VARCHAR) || 'U' || (p_partkey % 40) || 'N' END"


@query(f"""
WITH p AS (SELECT p_partkey, {CODE} AS model, lower('Shop ' || p_name || ' (' || CASE WHEN p_partkey % 3 = 0 THEN 'x' ELSE '' END || {CODE} || ') 4K TV') AS title FROM part),
l AS (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY 1), m AS (SELECT DISTINCT model FROM p),
c AS MATERIALIZED (SELECT m.model, p.p_partkey, p.title FROM m JOIN p ON contains(p.title, lower(m.model))),
h AS (SELECT model, p_partkey FROM c WHERE len(list_filter(range(1, len(title) + 1), lambda i: substr(title, i, len(model)) = lower(model)
  AND regexp_matches(substr(' ' || title, greatest(1, i - 1), CASE WHEN i > 1 THEN 2 ELSE 1 END), '([^a-z0-9]|[0-9]{{2}})$') AND NOT regexp_matches(substr(title, i + len(model), 1), '[a-z0-9]'))) > 0)
SELECT model, count(*) AS products, CAST(coalesce(sum(lines), 0) AS BIGINT) AS lines, min(p_partkey) AS first FROM h LEFT JOIN l ON l_partkey = p_partkey GROUP BY model
""")
def model_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models found as words of the titles of all products, and how many order lines those products have: each model met only by titles with its rarest word."""
    key = F.col("p_partkey")
    number, tail = F.pmod(key, F.lit(40)).cast("string"), F.pmod(key, F.lit(7))
    code = F.concat(F.when(tail == 1, "").otherwise((F.col("p_size") + 20).cast("string")), F.lit("U"), number, F.lit("N"), F.when(tail == 0, "-PRO").otherwise(""))
    title = F.concat(F.lit("Shop "), "p_name", F.lit(" ("), F.when(key % 3 == 0, "x").otherwise(""), code, F.lit(") 4K TV"))
    products = load(spark, sf_dir, "part").select("p_partkey", code.alias("model"), title.alias("title"))
    found = matching.word_matches(products.select("model").distinct(), products, "model", "title", "p_partkey", f"{work_dir(spark)}/postings")
    lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("key")).agg(F.count(F.lit(1)).alias("lines"))
    return found.join(lines, "key", "left").groupBy("model").agg(F.count(F.lit(1)).alias("products"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.min("key").alias("first"))


@query("""
WITH e AS (SELECT event_id % 4 AS file, event_id, event_id % 7 = 3 AS bad, CASE WHEN event_id < 4 THEN 1 ELSE 0 END + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS extra FROM events)
SELECT file, CAST(sum(1 + extra) OVER (PARTITION BY file ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS line, CASE WHEN NOT bad THEN event_id END AS event_id, bad,
  CASE WHEN bad OR event_id % 5 = 0 THEN 'kind' ELSE '' END AS missing FROM e
""")
def json_lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of JSON documents in files made of the events: headers, blank lines and bad lines count, and bad ones keep theirs."""
    where, key = work_dir(spark), F.col("event_id")
    good = F.concat(F.lit('{"id":'), key.cast("string"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit(',"kind":"'), "event_type", F.lit('"'))), F.lit("}"))
    text = F.concat(F.when(key < 4, '{"_schema":1}\n').otherwise(""), F.when(key % 10 == 0, "\n").otherwise(""), F.when(key % 7 == 3, '{"id":').otherwise(good))
    rows = load(spark, sf_dir, "events").select(text.alias("value"), key.alias("n"), (key % 4).alias("file"))
    rows.repartition(4, "file").sortWithinPartitions("file", "n").select("value", "file").write.partitionBy("file").text(f"{where}/lines")
    lines = tables.json_lines(spark, f"{where}/lines", ("id", "kind"))
    doc = F.try_variant_get("doc", "$.id", "long")
    return lines.select(F.regexp_extract("file", "file=([0-9]+)", 1).cast("long").alias("file"), "line", doc.alias("event_id"), F.col("doc").isNull().alias("bad"), F.array_join(F.array_except("missing", F.when(F.col("doc").isNull(), F.array(F.lit("id"))).otherwise(F.array().cast("array<string>"))), ",").alias("missing"))


@query("""
WITH p AS (SELECT regexp_replace(lower(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '')), '/+$', '') AS k, page_id, html FROM pages WHERE url IS NOT NULL),
s AS (SELECT k, max(TIMESTAMP '2026-01-01' + to_days(CAST(page_id % 20 AS INTEGER))) AS fetched_at FROM p WHERE page_id % 3 <> 0 GROUP BY k)
SELECT page_id, CASE WHEN fetched_at IS NULL THEN 'absent' WHEN fetched_at >= TIMESTAMP '2026-01-14' THEN 'fresh' ELSE 'stale' END AS state, fetched_at FROM p LEFT JOIN s ON p.k = s.k
""")
def cached_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All addresses looked up in a store that has two thirds of the pages, of up to 20 days: fresh, stale or absent."""
    day = F.timestamp_add("DAY", (F.col("page_id") % 20).cast("int"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    all_pages = load(spark, sf_dir, "pages")
    where = work_dir(spark)
    name = "page_store_" + where.rsplit("-", 1)[-1]
    cache.keep_pages(all_pages.filter("page_id % 3 <> 0").select("url", "html", day.alias("fetched_at")), name, f"{where}/store", 16)
    found = cache.look_up(spark, all_pages.filter("url IS NOT NULL").select("page_id", "url"), name, F.lit("2026-01-21 00:00:00").cast("timestamp_ntz"), 7)
    return found.select("page_id", "state", "fetched_at")


@query("""
WITH a AS (SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS n, count(*) OVER () AS c FROM part) WHERE n * 5 <= c * 4),
b AS (SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (ORDER BY md5(p_partkey || '/2'), p_partkey) AS n, count(*) OVER () AS c FROM part) WHERE n * 5 <= c * 4),
n AS (SELECT (SELECT count(*) FROM a) AS n_first, (SELECT count(*) FROM b) AS n_second, (SELECT count(*) FROM a SEMI JOIN b USING (p_partkey)) AS n_both, (SELECT count(*) FROM part) AS n_true),
u AS (SELECT *, n_first + n_second - n_both AS n_union FROM n)
SELECT *, greatest(n_union, CAST(floor((n_first + 1) * (n_second + 1) / (n_both + 1)) AS BIGINT) - 1) AS estimate,
  n_union >= greatest(n_union, CAST(floor((n_first + 1) * (n_second + 1) / (n_both + 1)) AS BIGINT) - 1) * CAST(0.95 AS DOUBLE) AS enough FROM u
""")
def recovered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products read in two orders, each cut off after four fifths: recovered, estimated and true numbers, and whether that is enough."""
    part = spread(load(spark, sf_dir, "part").select("p_partkey"), "p_partkey")
    total = part.count()
    text = F.col("p_partkey").cast("string")
    cut = [number_rows(part.withColumn("h", F.md5(t.cast("binary"))), F.conv(F.substring("h", 1, 12), 16, 10).cast("long"), ["h", "p_partkey"], "n").filter(F.col("n") * 5 <= total * 4) for t in (text, F.concat(text, F.lit("/2")))]
    return incremental.recovery(*cut, ["p_partkey"], 0.95).withColumn("n_true", F.lit(total).cast("long"))

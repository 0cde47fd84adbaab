"""Fields out of stored pages and JSON."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.urls import clean_url, first_group, json_path, match_url
from tidemark.operators import html

LD = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
NEXT_DATA = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'
NEXT_PUSH = r'(?s)self\.__next_f\.push\(\[\d+,"(.*?)"\]\)'
#: Fixed limits of the page classifier, in characters.
SHELL, LARGE = 5 * 1024, 20 * 1024
TRIPLE = T.StructType([T.StructField(name, T.StringType()) for name in ("chapter", "item", "value")])


def json_ld(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(LD), F.lit(1))


def next_data(html: Column) -> Column:
    return first_group(html, NEXT_DATA)


def next_stream(html: Column) -> Column:
    """The pushes of a streamed page put together."""
    return F.regexp_replace(F.array_join(F.regexp_extract_all(html, F.lit(NEXT_PUSH), F.lit(1)), ""), r'\\"', '"')


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a[^>]* href=["']([^"']*)["']"""), F.lit(1))


def locations(sitemap: Column) -> Column:
    return F.regexp_extract_all(sitemap, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))


def marker_counts(pages: DataFrame, id_column: str, html: str, markers: list[str]) -> DataFrame:
    """id, marker and how often it stands in the page."""
    count = lambda m: ((F.length(html) - F.length(F.replace(F.col(html), F.lit(m), F.lit("")))) / len(m)).cast("long")
    pairs = F.array(*[F.struct(F.lit(m).alias("marker"), count(m).alias("hits")) for m in markers])
    return pages.select(id_column, F.inline(pairs))


#: Keys under which pages keep their specifications as JSON.
JSON_KEYS = (
    "specification", "csChapter", "classifications", "techSpecs", "technicalSpecs",
    "productSpecs", "specifications", "attributeGroups", "featureBullets", "specGroups",
)


def key_counts(pages: DataFrame, id_column: str, html: str, keys: tuple[str, ...] = JSON_KEYS) -> DataFrame:
    """id, key and how often the page has it as a JSON key, escaped quotes included; no row for a key that it lacks."""
    count = lambda k: F.regexp_count(html, F.lit(rf'["\\]*{k}["\\]*\s*:')).cast("long")
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), count(k).alias("hits")) for k in keys])
    return pages.select(id_column, F.inline(pairs)).filter("hits > 0")


def first_of(*steps: Column) -> Column:
    """The first step that finds something; an empty text finds nothing."""
    return F.coalesce(*[F.nullif(F.trim(s), F.lit("")) for s in steps])


def category_page(doc: Column) -> Column:
    """A JSON-LD document that describes a list, not a product."""
    get = lambda p: F.get_json_object(doc, p)
    no_price = (get("$.offers['@type']") == "AggregateOffer") & get("$.offers.price").isNull()
    search = F.contains(F.coalesce(get("$.url"), F.lit("")), F.lit("/search"))
    crowd = (get("$.aggregateRating.ratingCount").try_cast("long") > 1000) & (get("$.category") == get("$.name"))
    return F.coalesce(no_price, F.lit(False)) | search | F.coalesce(crowd, F.lit(False))


def ld_price(doc: Column, size: Column | None = None) -> Column:
    """Price by priority: the product's offer, then the variant of the size, or the first; null for category pages."""
    variants = F.from_json(F.get_json_object(doc, "$.hasVariant"), "array<struct<size:string,name:string,offers:struct<price:string>>>")
    of_size = F.filter(variants, lambda v: (v["size"] == size) | F.contains(v["name"], size)) if size is not None else variants
    fit = F.coalesce(F.get(of_size, F.lit(0)), F.get(variants, F.lit(0)) if size is None else F.lit(None))
    price = F.coalesce(F.get_json_object(doc, "$.offers.price"), fit["offers"]["price"])
    return F.when(~category_page(doc), price.try_cast("decimal(18,2)"))


#: Where a blocked response shows what, as texts in lower case, and what it then is; the first that fits counts.
BLOCK_MARKS = (
    ("title", ("just a moment",), "cloudflare"),
    ("title", ("robot or human",), "challenge"),
    ("title", ("access denied",), "akamai"),
    ("url", ("/blocked?url=", "/account-verification", "/select-country", "are-you-robot"), "challenge"),
    ("body", ("are-you-robot", "verify your identity"), "challenge"),
    ("body", ("captcha-delivery.com",), "datadome"),
)
#: A mark that counts where there is no title, and one that short pages or absent ones alone mean.
UNTITLED_MARK, WEAK_MARK = "/tspd/", "captcha"


def page_class(status: Column, title: Column, final_url: Column, html: Column) -> Column:
    """What a stored response is; a status of 200 alone says nothing. Title, then url, then body, then its length."""
    low, head, length = F.lower(html), F.lower(F.coalesce(title, F.lit(""))), F.length(html)
    url = F.lower(F.coalesce(final_url, F.lit("")))
    has = lambda text, *marks: F.coalesce(reduce(Column.__or__, [F.contains(text, F.lit(m)) for m in marks]), F.lit(False))
    seen = {"title": head, "url": url, "body": low}
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for where, marks, kind in BLOCK_MARKS:
        out = out.when(has(seen[where], *marks), kind)
    return (
        out.when((head == "") & has(low, UNTITLED_MARK), "f5")
        .when(has(low, WEAK_MARK) & ((status == 404) | (length <= LARGE)), "challenge")
        .when(status.isin(403, 429), "blocked")
        .when(status == 404, "not_found")
        .when((status >= 500) | (status < 0), "unreachable")
        .when(length < SHELL, "shell")
        .otherwise("ok")
    )


@dataclass(frozen=True)
class Page:
    """Visible text of a page, and rows of its tables and definition lists."""

    html: str

    @property
    def words(self) -> list[str]:
        return html.words(self.html)

    def triples(self) -> list[tuple[str, str, str]]:
        return list(html.triples(self.html))


def parsed(text: str | None) -> Page:
    return Page(text or "")


@F.pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    """Text of a page without scripts and styles; unclosed tags do no harm."""
    return pages.map(lambda x: " ".join(parsed(x).words))


@F.udtf(returnType=TRIPLE)
class SpecTriples:
    """Chapter, item and value of every row of a page's tables and definition lists."""

    def eval(self, page: str):
        yield from parsed(page).triples()


def api_rows(docs: DataFrame, column: str, list_path: str, fields: dict[str, str], keep: list[str]) -> DataFrame:
    """A row for each element of the list at a dotted path of a JSON column; fields: name and dotted path of each.

    A document without that list gives no rows, so that another method can take its place.
    """
    items = F.from_json(F.get_json_object(column, json_path(list_path)), "array<string>")
    found = docs.select(*keep, F.explode(items).alias("_item"))
    return found.select(*keep, *[F.get_json_object("_item", json_path(path)).alias(name) for name, path in fields.items()])


def first_method(methods: list[tuple[str, DataFrame]], entity: str) -> DataFrame:
    """Rows of the first method that has any for an entity, with its name: the methods are read once, in one union."""
    tagged = [df.select("*", F.lit(name).alias("method"), F.lit(i).alias("_rank")) for i, (name, df) in enumerate(methods)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    best = every.groupBy(F.col(entity).alias("_e")).agg(F.min("_rank").alias("_best"))
    return every.join(best, (F.col(entity) == F.col("_e")) & (F.col("_rank") == F.col("_best"))).drop("_e", "_best", "_rank")


def widget_json(html: Column, attribute: str) -> Column:
    """The JSON in an attribute of the first element that has it, entities undone."""
    raw = first_group(html, rf"""(?s)\b{attribute}=(?:"([^"]*)"|'[^']*')""")
    single = first_group(html, rf"""(?s)\b{attribute}='([^']*)'""")
    plain = F.coalesce(raw, single)
    for entity, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return plain


#: Words of accessories in titles and addresses.
ACCESSORIES = ("mount", "stand", "cable", "remote", "soporte", "control remoto", "antena", "barra de sonido")


def tv_title(title: Column, low: int = 15, high: int = 110) -> Column:
    """Strict: a size from ``low`` to ``high`` inches and no accessory word."""
    clean = ~F.lower(title).rlike(r"\b(" + "|".join(ACCESSORIES) + r")")
    sized = first_group(title, r"(?i)(\d{2,3}) ?(?:\"|”|''|inch|pulgadas|pouces)").try_cast("int")
    return F.coalesce(clean & sized.between(low, high), F.lit(False))


def tv_model_title(title: Column) -> Column:
    """Lenient: something like a model number makes it a TV."""
    return F.coalesce(title.rlike(r"\b\d{2,3}[A-Z][A-Z0-9]{2,12}\b"), F.lit(False))


def brand_sitemap(url: Column, brand: str) -> Column:
    """Addresses that name the brand and a tv, and no accessory."""
    low = F.lower(url)
    return F.contains(low, F.lit(brand.lower())) & F.contains(low, F.lit("tv")) & ~low.rlike("mount|stand|cable|remote")


def dedupe_cards(cards: DataFrame, tag: str, css: str, text: str) -> DataFrame:
    """One card of each tag, class and text."""
    return cards.withColumn("_t", F.xxhash64(F.trim(F.col(text)))).dropDuplicates([tag, css, "_t"]).drop("_t")


def next_page(numbers: Column, current: Column) -> Column:
    """The smallest page number above the current one."""
    return F.array_min(F.filter(numbers, lambda n: n > current))


def merge_series(models: DataFrame, model: str, family: str, series: str, rule: Column) -> DataFrame:
    """Models by family, else by series, else by a rule on the model: key and sorted models."""
    key = F.coalesce(F.nullif(F.col(family), F.lit("")), F.nullif(F.col(series), F.lit("")), rule)
    return models.groupBy(key.alias("series_key")).agg(F.sort_array(F.collect_set(model)).alias("models"))


def join_addresses(wanted: DataFrame, pages: DataFrame, url: str, page_url: str, size: str, page_size: str) -> DataFrame:
    """Pages of addresses, by the whole normalised address; where that finds none, by its last part and the size."""
    left = wanted.withColumn("_u", match_url(clean_url(F.col(url))))
    right = pages.withColumn("_u", match_url(clean_url(F.col(page_url))))
    whole = left.join(right, "_u").withColumn("by", F.lit("address"))
    rest = left.join(right.select("_u"), "_u", "left_anti")
    code = lambda df: df.withColumn("_c", F.regexp_extract("_u", r"([a-z0-9]+)$", 1)).filter("_c <> ''").drop("_u")
    part = code(rest).join(code(right), "_c").filter(F.col(size).eqNullSafe(F.col(page_size))).withColumn("by", F.lit("code"))
    return whole.drop("_u").unionByName(part.drop("_c"))


def dead_links(texts: DataFrame, files: DataFrame, text: str, name: str) -> DataFrame:
    """Names of Markdown files that texts refer to and that are not there."""
    named = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?:[a-z_]+/)?([a-z_]+\.md)"), F.lit(1)))).alias("link")).distinct()
    return named.join(files.select(F.col(name).alias("link")), "link", "left_anti")


#: Assumed weights of a page's score, in percent: models found, prices found, purity of the links.
SCORE_WEIGHTS = (50, 30, 20)


def page_score(coverage: Column, priced: Column, purity: Column) -> Column:
    """0 to 100 from three shares; 70 passes."""
    a, b, c = SCORE_WEIGHTS
    one = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(x, F.lit(0.0))))
    return F.floor(one(coverage) * float(a) + one(priced) * float(b) + one(purity) * float(c) + F.lit(0.5)).cast("long")

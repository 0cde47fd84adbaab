"""All data that a stored page carries in its markup, as VARIANT rows: scripts of linked data, page data, streams and widgets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.extraction import LD, NEXT_DATA, next_stream

#: Entities of attribute values, undone in this order.
ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def attribute_values(html: Column, attribute: str) -> Column:
    """Every value of an attribute, in quotes of either kind, entities undone."""
    found = F.concat(F.regexp_extract_all(html, F.lit(rf'(?s)\b{attribute}="([^"]*)"'), F.lit(1)), F.regexp_extract_all(html, F.lit(rf"(?s)\b{attribute}='([^']*)'"), F.lit(1)))

    def plain(value: Column) -> Column:
        for entity, sign in ENTITIES:
            value = F.replace(value, F.lit(entity), F.lit(sign))
        return value

    return F.transform(found, plain)


def payloads(pages: DataFrame, html: str, keep: list[str], attributes: tuple[str, ...] = ("data-info",)) -> DataFrame:
    """keep, kind, at, text and doc of every payload of every page; doc is null where the text is no JSON.

    Kinds: ``ld`` for each script of linked data, ``page`` for each __NEXT_DATA__, ``stream`` for the pushes of a page
    put together, and the name of each attribute. ``at`` counts within a kind.
    """
    column = F.col(html)
    stream = next_stream(column)
    texts = {
        "ld": F.regexp_extract_all(column, F.lit(LD), F.lit(1)), "page": F.regexp_extract_all(column, F.lit(NEXT_DATA), F.lit(1)),
        "stream": F.when(stream != "", F.array(stream)).otherwise(F.array().cast("array<string>")), **{a: attribute_values(column, a) for a in attributes},
    }

    def tagged(kind: str, found: Column) -> Column:
        rows = F.coalesce(found, F.array().cast("array<string>"))
        return F.transform(rows, lambda t, i: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("at"), t.alias("text")))

    each = F.concat(*[tagged(kind, found) for kind, found in texts.items()])
    return pages.select(*keep, F.inline(each)).withColumn("doc", F.try_parse_json("text"))


def things(found: DataFrame) -> DataFrame:
    """A row for each thing of each payload, ``n`` within it: the elements of a list, of an ``@graph`` or of an item list, else the document itself."""
    many = lambda path: F.try_variant_get("doc", path, "array<variant>")
    wrapped = F.transform(many("$.itemListElement"), lambda x: F.coalesce(F.try_variant_get(x, "$.item", "variant"), x))
    every = F.coalesce(many("$"), many("$['@graph']"), wrapped, F.when(F.col("doc").isNotNull(), F.array("doc")))
    return found.select("*", F.posexplode_outer(every).alias("n", "thing")).withColumn("n", F.col("n").cast("long"))


def text_at(thing: Column, path: str) -> Column:
    return F.try_variant_get(thing, path, "string")


@dataclass(frozen=True)
class SpecPaths:
    """Where a page's embedded JSON has its specification: names of fields, as pages have them."""

    root: str
    chapters: str
    chapter: str
    items: str
    item: str
    values: str
    value: str
    join: str = " / "


def spec_rows(docs: DataFrame, doc: str, keep: list[str], paths: SpecPaths) -> DataFrame:
    """keep, chapter, item, value and their places: chapters, items and joined values flattened from a VARIANT column.

    A chapter without items keeps a row, and so does an item without values; a document without chapters has none.
    """
    get = lambda at, path, kind: F.try_variant_get(at, path, kind)
    rows = docs.select(*keep, F.posexplode(get(doc, f"$.{paths.root}.{paths.chapters}", "array<variant>")).alias("chapter_order", "_c"))
    rows = rows.select(*keep, F.col("chapter_order").cast("long"), get("_c", f"$.{paths.chapter}", "string").alias("chapter"), F.posexplode_outer(get("_c", f"$.{paths.items}", "array<variant>")).alias("row_order", "_i"))
    values = F.transform(get("_i", f"$.{paths.values}", "array<variant>"), lambda v: get(v, f"$.{paths.value}", "string"))
    value = F.nullif(F.array_join(F.filter(values, lambda v: v.isNotNull()), paths.join), F.lit(""))
    return rows.select(*keep, "chapter_order", "chapter", F.coalesce("row_order", F.lit(0)).cast("long").alias("row_order"), get("_i", f"$.{paths.item}", "string").alias("item"), value.alias("value"))


def for_models(rows: DataFrame, models: DataFrame, by: list[str]) -> DataFrame:
    """Every row of a specification for every model of its series, by an equi-join; a series without models gives none."""
    return rows.join(models, by)

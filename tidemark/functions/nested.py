"""Maps, arrays and JSON fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.urls import json_path, size_inch

#: Codes that a currency field may hold; anything else in its place is a misread field.
CURRENCIES = ("USD", "CAD", "MXN", "BRL", "CLP", "COP", "PEN", "ARS", "EUR", "GBP", "PLN", "CZK", "JPY", "KRW", "CNY", "TRY", "THB", "RUB")


def kv_lookup(table: Column, keys: str) -> Column:
    """The value of the first entry of a map whose key contains one of ``a|b|c``, in the order of these words."""
    entries = F.map_entries(table)
    return F.coalesce(*[F.get(_having(entries, word), F.lit(0))["value"] for word in keys.split("|")])


def _having(entries: Column, word: str) -> Column:
    return F.filter(entries, lambda e: F.contains(F.lower(e["key"]), F.lit(word.lower())))


def has_path(doc: Column, dotted: str) -> Column:
    """Does the document have the field? A document that cannot be read has none."""
    return F.when(F.try_parse_json(doc).isNotNull(), F.get_json_object(doc, json_path(dotted)).isNotNull()).otherwise(F.lit(False))


def any_path(doc: Column, *dotted: str) -> Column:
    """The first of several fields that is there."""
    return F.coalesce(*[F.get_json_object(doc, json_path(d)) for d in dotted])


def contains_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.contains(F.lower(text), F.lit(word.lower()))
    return F.coalesce(out, F.lit(False))


def in_stock(availability: Column) -> Column:
    """By the stated availability alone; a price says nothing. Unknown stays null."""
    word = F.lower(F.regexp_replace(availability, "^.*/", ""))
    return F.when(word.isin("instock", "limitedavailability", "onlineonly"), True).when(word.isin("outofstock", "soldout", "discontinued"), False)


def known_currency(code: Column) -> Column:
    return F.when(F.upper(F.trim(code)).isin(*CURRENCIES), F.upper(F.trim(code)))


def own_models(header: Column, table: Column) -> Column:
    """Models that a page reports itself: the first of its header and up to two of its table, of the header's size."""
    first = F.slice(header, 1, 1)
    size = size_inch(F.get(first, F.lit(0)))
    agreeing = F.filter(F.slice(table, 1, 2), lambda m: size.isNull() | size_inch(m).eqNullSafe(size))
    return F.array_distinct(F.concat(first, agreeing))


def decoded(text: Column) -> Column:
    """Base64 as text."""
    return F.decode(F.unbase64(text), "UTF-8")


def saved_share(before: Column, after: Column) -> Column:
    """What a change saves, in ten-thousandths of what it took before."""
    return F.when(before > 0, F.floor((before - after) / before * F.lit(10000.0) + F.lit(0.5)).cast("long"))

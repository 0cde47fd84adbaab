"""Declarative shop and specification schemas: checked before any plan is built."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, urls
from tidemark.operators.extraction import first_of, json_ld


class Discover(Enum):
    """How a site's models are found."""

    ANCHOR = "dom_anchor"
    TWO_LEVEL = "dom_anchor_two_level"
    API = "xhr_api"


class Paginate(Enum):
    NONE = "none"
    URL = "url_page"
    QUERY = "query_param"
    CLICK = "click_more"
    SNIPPET = "js_snippet"
    API = "bv_api"


class OnMiss(Enum):
    """There is no way to take the first hit where nothing matches."""

    SKIP = "skip"


def _enum_problem(kind: type[Enum], value: str, where: str) -> list[str]:
    allowed = [x.value for x in kind]
    return [] if value in allowed else [f"{where}: {value!r} is not one of {', '.join(allowed)}"]


def brand(text: Column) -> Column:
    """A brand's name as shops show it: without tags, a label before a colon or a leading by; null if nothing is left."""
    return urls.blank_to_null(F.regexp_replace(money.plain_text(text), r"(?i)^(?:[^:]{1,20}: ?|by )", ""))


#: Transforms that a field may name.
TRANSFORMS = {
    "clean_text": lambda c, currency: money.plain_text(c),
    "money": lambda c, currency: money.money(c, F.lit(currency)),
    "size_inch": lambda c, currency: urls.size_inch(c),
    "rating": lambda c, currency: F.replace(F.nullif(F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)", 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"),
    "bool_present": lambda c, currency: F.coalesce(c != "", F.lit(False)),
    "upper_alnum": lambda c, currency: urls.upper_alnum(c),
    "liverpool_money": lambda c, currency: money.peso_price(c),
    "currency_mx": lambda c, currency: F.when(urls.blank_to_null(c).isNotNull(), F.lit("MXN")),
    "brand": lambda c, currency: brand(c),
}


@dataclass(frozen=True)
class Field:
    """A field: patterns on the page and JSON-LD paths, in order; the first that finds something wins."""

    name: str
    regex: tuple[str, ...] = ()
    jsonld: tuple[str, ...] = ()
    transform: str | None = None

    def problems(self) -> list[str]:
        out = [] if self.regex or self.jsonld else [f"{self.name}: no way to find it"]
        for pattern in self.regex:
            try:
                groups = re.compile(pattern).groups
            except re.error as e:
                out.append(f"{self.name}: {pattern!r} is no pattern ({e})")
            else:
                out += [] if groups else [f"{self.name}: {pattern!r} has no group"]
        out += [] if self.transform in (None, *TRANSFORMS) else [f"{self.name}: no transform {self.transform!r}"]
        return out

    def column(self, html: Column, currency: str) -> Column:
        doc = F.get(json_ld(html), F.lit(0))
        steps = [F.regexp_extract(html, p, 1) for p in self.regex] + [F.get_json_object(doc, urls.json_path(p)) for p in self.jsonld]
        found = first_of(*steps)
        return (TRANSFORMS[self.transform](found, currency) if self.transform else found).alias(self.name)


@dataclass(frozen=True)
class ShopSchema:
    """A shop: where its pages are, how they are matched and which fields they have."""

    code: str
    search_url: str
    currency: str = "USD"
    discover: str = Discover.ANCHOR.value
    paginate: str = Paginate.NONE.value
    on_no_match: str = OnMiss.SKIP.value
    min_core_len: int = 4
    reports_model: bool = False
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def problems(self) -> list[str]:
        """All that is wrong with the schema; an empty list means it can be used."""
        out = [] if re.fullmatch("[a-z0-9_]+", self.code) else [f"code: {self.code!r}"]
        out += [] if "{q}" in self.search_url or "{model}" in self.search_url else ["search_url: neither {q} nor {model}"]
        out += _enum_problem(Discover, self.discover, "discover") + _enum_problem(Paginate, self.paginate, "paginate")
        out += _enum_problem(OnMiss, self.on_no_match, "on_no_match")
        if self.min_core_len < 4 and not self.reports_model:
            out.append("min_core_len: under 4 needs pages that report their own model")
        names = [f.name for f in self.fields]
        out += [f"fields: {n} twice" for n in sorted({n for n in names if names.count(n) > 1})]
        return out + [p for f in self.fields for p in f.problems()]

    def extract(self, pages: DataFrame, html: str = "html") -> DataFrame:
        """The fields of every stored page, as columns beside what it had."""
        if problems := self.problems():
            raise ValueError("; ".join(problems))
        return pages.select("*", *[f.column(F.col(html), self.currency) for f in self.fields])

    def search_addresses(self, models: DataFrame, brand: str, model: str) -> DataFrame:
        query = F.concat_ws(" ", F.col(brand), F.col(model))
        return models.withColumn("search_url", urls.fill(self.search_url, q=query, brand=F.col(brand), model=F.col(model)))

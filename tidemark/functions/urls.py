"""URL and model-number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def clean_url(url: Column) -> Column:
    """Without query, fragment and one closing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/$", "")


def match_url(url: Column) -> Column:
    """For comparing: lower-case, without closing slashes."""
    return F.lower(F.regexp_replace(url, "/+$", ""))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(clean_url(url), "/"), -1)


def looks_like_model_url(url: Column) -> Column:
    """The last segment has a letter next to two digits."""
    return F.lower(last_segment(url)).rlike("[a-z][0-9]{2}|[0-9]{2}[a-z]")


def upper_alnum(text: Column) -> Column:
    return F.upper(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def strip_leading_size(model: Column) -> Column:
    return F.regexp_replace(model, r"^\d{2,3}", "")


def core_model(model: Column) -> Column:
    """Without a leading size and the endings pro and max, as upper-case letters and digits."""
    return upper_alnum(F.regexp_replace(strip_leading_size(model), "(?i)[- ]?(pro|max)$", ""))


def size_inch(text: Column) -> Column:
    """Inches named as such, else the first number of two or three digits."""
    named = first_group(text, r"(?i)(\d{2,3}) ?(?:pulgadas|pouces|inch|\"|”)")
    return F.coalesce(named, first_group(text, r"(\d{2,3})")).try_cast("int")


def model_in_title(title: Column) -> Column:
    """A size with the letters and digits after it, or an empty string."""
    return F.regexp_extract(F.upper(title), r"(\d{2}[A-Z]{1,3}\d?[A-Z]{0,3}\d?)", 1)


def model_words(title: Column, stop: list[str]) -> Column:
    """Words that could be model numbers: a letter and a digit at least, and not stopped."""
    words = F.regexp_extract_all(F.upper(title), F.lit(r"\b([A-Z0-9][A-Z0-9-]{4,20})\b"), F.lit(1))
    return F.filter(words, lambda w: w.rlike("[A-Z]") & w.rlike("[0-9]") & ~w.isin(*stop))


def clean_search_text(text: Column) -> Column:
    """Without brackets that hold CJK characters and without other CJK; ASCII brackets stay."""
    cjk = r"[　-ヿ㐀-鿿＀-￯]"
    inside = F.regexp_replace(text, r"[（(\[【][^）)\]】]*" + cjk + r"[^）)\]】]*[）)\]】]|（[^）]*）", "")
    return F.trim(F.regexp_replace(F.regexp_replace(inside, cjk, ""), " +", " "))


def json_path(dotted: str) -> str:
    """``a.b.0.c`` as ``$.a.b[0].c``."""
    parts = [f"[{p}]" if p.isdigit() else f".{p}" for p in dotted.split(".") if p]
    return "$" + "".join(parts)


def fill(template: str, **columns: Column) -> Column:
    """``{name}`` replaced by the column of that name."""
    out = F.lit(template)
    for name, column in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(column, F.lit("")))
    return out


#: Fixed forms of a shop's own numbers in addresses: category and number before .html, ten characters behind dp, a marked number at the end.
SKUS = (r"/f-[^/?#-]+-([A-Za-z0-9]+)\.html", r"/(?:dp|gp/product)/([A-Z0-9]{10})(?:[/?#]|$)", r"-p-(HBV[A-Z0-9]+)(?:[/?#]|$)")
#: Fixed form of a review's number in addresses.
REVIEW = r"[?&]ReviewCD=(\d+)"


def sku(url: Column) -> Column:
    """The shop's number of a product by the first form that its address has; null without one."""
    return F.coalesce(*[first_group(url, p) for p in SKUS])


def review_number(url: Column) -> Column:
    return first_group(url, REVIEW)

"""Money as whole minor units: sums of longs do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column) -> Column:
    """Rounds a non-negative double half up to a long."""
    return F.floor(x + F.lit(0.5)).cast("long")


def cents(price: Column) -> Column:
    return half_up(price * F.lit(100.0))


def dollars(minor: Column) -> Column:
    return minor.cast("double") / F.lit(100.0)


def mean_cents(minor: Column) -> Column:
    """Aggregate: the rounded mean of minor units."""
    return half_up(F.sum(minor).cast("double") / F.count(minor).cast("double"))


def plain_text(text: Column) -> Column:
    """Without tags and with no-break spaces as spaces; cents in <sup> follow a comma."""
    cents_up = F.regexp_replace(text, r"(?i)([€$£])? ?<sup> ?(\d\d) ?</sup>", ",$2")
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(cents_up, "<[^>]*>", " "), "&nbsp;| | ", " "), " +", " "))


#: Currencies of the countries that site codes end in.
COUNTRY_CURRENCY = {
    "ar": "ARS", "au": "AUD", "bo": "BOB", "br": "BRL", "ca": "CAD", "cl": "CLP", "cn": "CNY", "co": "COP", "de": "EUR", "es": "EUR", "fr": "EUR", "in": "INR", "it": "EUR", "jp": "JPY",
    "kr": "KRW", "mx": "MXN", "nl": "EUR", "nz": "NZD", "pe": "PEN", "pl": "PLN", "ru": "RUB", "tr": "TRY", "uk": "GBP", "us": "USD", "za": "ZAR",
}


def site_currency(code: Column) -> Column:
    """The currency of a site code's country, which follows its last underscore; null for other codes and countries."""
    known = F.create_map(*[F.lit(x) for pair in COUNTRY_CURRENCY.items() for x in pair])
    return F.try_element_at(known, F.lower(F.nullif(F.regexp_extract(code, r"_([A-Za-z]{2})$", 1), F.lit(""))))


def peso_price(text: Column) -> Column:
    """The first amount written as dollars with grouped thousands and two decimals, ``$12,999.00``; null without one."""
    found = F.nullif(F.regexp_extract(text, r"\$ ?([0-9]{1,3}(?:,[0-9]{3})*\.[0-9]{2})(?![0-9])", 1), F.lit(""))
    return F.replace(found, F.lit(",")).try_cast("decimal(18,2)")


#: How a currency writes thousands and decimals.
DOT_THOUSANDS = ["CLP", "COP", "ARS"]
COMMA_DECIMAL = ["EUR", "BRL", "TRY"]
NO_DECIMALS = ["JPY", "CLP", "KRW"]
#: A number with its separators, in groups of three or as in India of two and at last three, and the marks that stand before or behind an amount.
NUMBER = (
    r"[0-9]{1,2}(?:,[0-9]{2})+,[0-9]{3}(?:\.[0-9]{1,2})?(?![0-9]|[.,][0-9])|[0-9]{1,3}(?:[ .,'’][0-9]{3})+(?:[.,][0-9]{1,2})?(?![0-9]|[.,][0-9])|[0-9]++(?:[.,][0-9]++)?+(?![.,][0-9])"
)
BEFORE, BEHIND = r"(?:[A-Z]{1,3})?[$£¥￥₩₹]|[€₺](?=[0-9-])|USD|EUR|JPY|CLP|INR", r"[€₺円元](?! ?[0-9])|TL\b|EUR\b|USD\b|JPY\b|INR\b"
#: No number before it, and not in brackets by itself, which some write for a debt.
OPEN = r"(?<![0-9.,])(?!(?<=\()[-−]?[0-9.,]+\))"
AMOUNT = rf"{OPEN}(?:[-−]?(?:{BEFORE}) ?[-−]?(?:{NUMBER})|[-−]?(?:{NUMBER}) ?(?:{BEHIND}))"
#: Words next to an amount that make it a discount or a part of the price.
SAVED, OFF = r"(?i:\b(?:save|you save|ahorra|ahorre|descuento de|économisez|sparen sie)) ?", r" ?(?i:off\b|オフ|引き|割引|de descuento|de dscto)"
PART = r" ?(?i:/ ?(?:mo|month|mes)\b|per month|a month|al mes|mensuales|monthly)"
NO_PRICE = rf"{SAVED}(?:{AMOUNT})|(?:{AMOUNT})(?:{OFF}|{PART})"


def number(token: Column, currency: Column) -> Column:
    """Value of one number: a last separator before one or two digits is that of the decimals.

    Null where a currency that writes decimals after a dot has a dot before three digits or more: it may be either.
    """
    plain = F.regexp_replace(token, r"[^0-9.,]", "")
    sign = F.when(token.rlike("[-−]"), -1).otherwise(1)
    decimals = F.regexp_extract(plain, r"[.,]([0-9]{1,2})$", 1)
    whole = F.regexp_replace(F.regexp_replace(plain, r"[.,][0-9]{1,2}$", ""), "[.,]", "")
    grouped = currency.isin(*NO_DECIMALS, *DOT_THOUSANDS, *COMMA_DECIMAL)
    text = (
        F.when((decimals != "") & currency.isin(*NO_DECIMALS), F.when(decimals.rlike("^0+$"), whole))
        .when(decimals != "", F.concat(whole, F.lit("."), decimals))
        .when(grouped, whole)
        .when(~plain.rlike(r"\.[0-9]{3,}$"), F.regexp_replace(plain, ",", ""))
    )
    return (sign * F.nullif(text, F.lit("")).try_cast("decimal(18,2)")).cast("decimal(18,2)")


def money(raw: Column, currency: Column) -> Column:
    """The one amount of a text as DECIMAL(18,2), or null; never 0 for something that cannot be read.

    Numbers next to a currency mark come before all others. Of several, the first before the yen sign counts; other
    different amounts are equally good, and give null. Discounts and instalments are not the price, and beside them a
    number needs a mark to be it.
    """
    whole = plain_text(raw)
    text = F.regexp_replace(whole, NO_PRICE, " ; ")
    marked = F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0))
    every = F.regexp_extract_all(text, F.lit(rf"{OPEN}[-−]?(?:{NUMBER})"), F.lit(0))
    tokens = F.when(F.size(marked) > 0, marked).when(text == whole, every)
    values = F.array_distinct(F.transform(tokens, lambda t: number(t, currency)))
    first = F.regexp_extract(text, rf"([-−]?(?:{NUMBER})) ?円", 1)
    return F.when(first != "", number(first, currency)).when(F.size(values) == 1, F.element_at(values, 1)).cast("decimal(18,2)")


def money_parts(value: Column, decimals: Column) -> Column:
    """Amount of two attributes, whole units and decimals; null if the units are no number. No decimals are none."""
    units, rest = F.regexp_replace(value, r"[ .,]", ""), F.coalesce(F.trim(decimals), F.lit(""))
    text = F.when(units.rlike(r"^-?[0-9]+$") & rest.rlike(r"^[0-9]{0,2}$"), F.concat(units, F.lit("."), F.rpad(rest, 2, "0")))
    return text.try_cast("decimal(18,2)")


def first_amount(*amounts: Column) -> Column:
    """The first source that has an amount: the order is JSON field, attribute, structured data, text."""
    return F.coalesce(*amounts)


#: Fixed thresholds of a price difference, as shares of the older price in ten-thousandths.
SAME, SUSPECT = 500, 5000


def difference_class(old: Column, new: Column) -> Column:
    """same, move or suspect for two amounts in minor units; unknown if one is missing."""
    share = F.abs(new - old) * F.lit(10000)
    return (
        F.when(old.isNull() | new.isNull() | (old <= 0), "unknown")
        .when(share <= old * F.lit(SAME), "same")
        .when(share > old * F.lit(SUSPECT), "suspect")
        .otherwise("move")
    )


#: Fixed threshold: days that must lie between two readings before a difference says anything.
MEANINGFUL_DAYS = 7


def difference_verdict(old: Column, new: Column, days: Column, same_title: Column, page_ok: Column) -> Column:
    """same, suspect or unknown as in difference_class; a move only of a live page with the same title after over 7 days, else unsure."""
    kind = difference_class(old, new)
    sure = F.coalesce((days > MEANINGFUL_DAYS) & same_title & page_ok, F.lit(False))
    return F.when((kind == "move") & ~sure, "unsure").otherwise(kind)

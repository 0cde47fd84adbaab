"""Amounts of money in texts and attributes made of the products; small fixed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.plans.catalog import query


def rows(spark: SparkSession, columns: str, *values: tuple) -> DataFrame:
    """A literal table without a Python worker; columns: ``name type, ...``."""
    names = [c.strip().split(" ", 1) for c in columns.split(", ")]
    structs = [F.struct(*[literal(v).cast(kind).alias(name) for v, (name, kind) in zip(row, names)]) for row in values]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def literal(value):
    if isinstance(value, list):
        return F.array(*[literal(v) for v in value]) if value else F.array().cast("array<string>")
    return F.lit(value)


#: Currency and text of a price v (whole units, 1,000 or more) by the form's number, with decimals d.
PRICE_FORMS = (
    ("USD", "Now ${comma}.{d} with 2 year warranty"), ("EUR", "{dot},{d} €"), ("JPY", "{comma}円(税込{more}円)"), ("CLP", "65 pulgadas ${dot}"), ("USD", "Save 20 ${comma}.{d}"),
    ("CLP", "${dot} ${dotmore}"), ("USD", "-${comma}.{d}"), ("EUR", "{space},{d}&nbsp;€"), ("EUR", "€{dot}<sup>{d}</sup>"), ("USD", "no price today"), ("USD", "{comma}.{d}"), ("CLP", "CLP {dot},00"),
    ("INR", "₹{lakh}.{d}"), ("EUR", "−{dot},{d} €"), ("JPY", "{more}円OFF {comma}円"), ("USD", "Save ${comma} today"), ("USD", "${comma}/mo for 24 months"), ("USD", "{plain}.{d}9"),
)


@query("""
WITH t AS (SELECT p_partkey, p_partkey % 18 AS form, 1000 + p_partkey * 137 % 900000 AS v, p_partkey % 90 + 10 AS d FROM part)
SELECT p_partkey, form, CAST(CASE WHEN form IN (5, 9, 15, 16, 17) THEN NULL WHEN form IN (2, 3, 11, 14) THEN v WHEN form IN (6, 13) THEN -(v + d / 100.0) ELSE v + d / 100.0 END AS DECIMAL(18, 2)) AS amount FROM t
""")
def money_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price text for every product, in eighteen forms, some with two prices, sizes, discounts or instalments, and the amount read."""
    from tidemark.sources.tables import load, spread

    n = F.col("p_partkey")
    form, v, d = F.pmod(n, F.lit(18)), F.lit(1000) + F.pmod(n * F.lit(137), F.lit(900000)), (F.pmod(n, F.lit(90)) + 10).cast("string")
    swap = lambda x, by: F.translate(F.format_number(x, 0), ",", by)
    parts = {"comma": swap(v, ","), "dot": swap(v, "."), "space": swap(v, " "), "more": swap(v + 1100, ","), "dotmore": swap(v + 40000, "."), "d": d, "plain": v.cast("string")}
    part = lambda x, size: F.lpad(x.cast("string"), size, "0")
    thousands, lakhs = F.floor(v / 1000), F.floor(v / 100000)
    parts["lakh"] = F.concat(F.when(lakhs > 0, F.concat(lakhs.cast("string"), F.lit(","), part(thousands % 100, 2))).otherwise(thousands.cast("string")), F.lit(","), part(v % 1000, 3))

    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (form + 1).cast("int"))
    # A row's own form is picked before it is filled in, not filled in eighteen times.
    raw = reduce(lambda pattern, p: F.replace(pattern, F.lit("{" + p[0] + "}"), p[1]), parts.items(), pick([p for _, p in PRICE_FORMS]))
    table = spread(load(spark, sf_dir, "part"), "p_partkey").select("p_partkey", form.alias("form"), raw.alias("raw"), pick([c for c, _ in PRICE_FORMS]).alias("currency"))
    return table.select("p_partkey", "form", money.money(F.col("raw"), F.col("currency")).alias("amount"))


@query("""
SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 0 THEN p_size * 1000 ELSE p_size * 1000 + p_partkey % 100 / 100.0 END AS DECIMAL(18, 2)) AS amount FROM part
""")
def money_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole units and decimals as two attributes; the text is asked only where they are missing."""
    from tidemark.sources.tables import load, spread

    n, units = F.col("p_partkey"), F.format_number(F.col("p_size") * 1000, 0)
    cents = F.lpad(F.pmod(n, F.lit(100)).cast("string"), 2, "0")
    kind = F.pmod(n, F.lit(4))
    value = F.when(kind == 3, F.lit("sold out")).when(kind != 2, F.translate(units, ",", "."))
    text = F.when(kind == 2, F.concat(F.lit("$"), units, F.lit("."), cents)).otherwise(F.lit("see shop"))
    read = money.first_amount(money.money_parts(value, F.when(kind != 0, cents)), money.money(text, F.lit("USD")))
    return spread(load(spark, sf_dir, "part"), "p_partkey").select("p_partkey", read.alias("amount"))

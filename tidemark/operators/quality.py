"""Data quality and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed shares, in percent, of the coverage verdict.
SUCCESS, PARTIAL = 95.0, 80.0


def missing(column: Column) -> Column:
    """Null or blank text."""
    return column.isNull() | (F.trim(column.cast("string")) == "")


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, filled, rows and share in ten-thousandths, by one pass over the table."""
    totals = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(~missing(F.col(c))).alias(f"f{i}") for i, c in enumerate(columns)])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"f{i}").alias("filled")) for i, c in enumerate(columns)]))
    share = F.floor(F.col("p.filled").cast("double") / F.col("rows").cast("double") * F.lit(10000.0) + F.lit(0.5)).cast("long")
    return totals.select("rows", pairs.alias("p")).select("p.column", "p.filled", "rows", share.alias("share"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias("_k")), F.col(child_key) == F.col("_k"), "left_anti")


def reconcile(parts: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows that only one of the two has, repeats counted: side and rows for both sides."""
    side = lambda a, b, name: a.exceptAll(b).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("side"), "rows")
    return side(parts, whole, "parts").unionByName(side(whole, parts, "whole"))


def coverage_percent(text: Column) -> Column:
    """The number before a percent sign, else the leading number."""
    marked = F.regexp_extract(text, r"(\d+(?:\.\d+)?) *%", 1)
    leading = F.regexp_extract(text, r"^ *(\d+(?:\.\d+)?)", 1)
    return F.coalesce(F.nullif(marked, F.lit("")), F.nullif(leading, F.lit(""))).try_cast("double")


def coverage_verdict(percent: Column) -> Column:
    return F.when(percent.isNull(), "unknown").when(percent >= SUCCESS, "success").when(percent >= PARTIAL, "partial").otherwise("failed")


def full_difference(a: DataFrame, b: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose values differ, or that one side lacks."""
    left = a.select(*keys, F.struct(*values).alias("_a"))
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*values).alias("_b"))
    same = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}")) if same is None else same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = left.join(right, same, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    return both.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], F.col("_a").alias("left"), F.col("_b").alias("right"))

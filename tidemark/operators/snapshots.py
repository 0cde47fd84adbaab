"""Snapshots over time: latest, changes, first and last seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_week, week_index
from tidemark.functions.money import difference_class


def latest(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The values of each key's last row by ``order``: an aggregation, so a key's rows are never sorted in one task."""
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("v")
    return df.groupBy(keys).agg(newest).select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def as_of(events: DataFrame, at: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """For each row (key, time) of ``at`` the last value at or before it, in one pass over both sorted together."""
    both = at.select(key, time, F.lit(None).alias(value), F.lit(1).alias("_asked")).unionByName(
        events.select(key, time, value, F.lit(0).alias("_asked"))
    )
    before = Window.partitionBy(key).orderBy(time, "_asked").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(before)).filter("_asked = 1").drop("_asked")


def changes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Adds previous, the value one row before, and verdict, the class of the difference."""
    w = Window.partitionBy(keys).orderBy(order)
    out = df.withColumn("previous", F.lag(value).over(w))
    return out.withColumn("verdict", F.when(F.col("previous").isNull(), "first").otherwise(difference_class(F.col("previous"), F.col(value))))


def direction(df: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Per key: do all real moves go one way? up, down, mixed or none."""
    sign = F.signum((F.col(new) - F.col(old)).cast("double")).cast("int")
    moved = F.when(difference_class(F.col(old), F.col(new)).isin("move", "suspect"), sign)
    out = df.groupBy(key).agg(F.min(moved).alias("lo"), F.max(moved).alias("hi"), F.count(moved).alias("moves"))
    kind = F.when(F.col("moves") == 0, "none").when(F.col("lo") > 0, "up").when(F.col("hi") < 0, "down").otherwise("mixed")
    return out.select(key, "moves", kind.alias("direction"))


def seen(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """First and last week of each key, as labels and as week numbers."""
    out = df.groupBy(keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    return out.select(
        *keys, iso_week(F.col("_first")).alias("first_week"), iso_week(F.col("_last")).alias("last_week"), week_index(F.col("_last")).alias("last_index")
    )


def concentration(df: DataFrame, group: Column, amount: Column, top: int = 3) -> DataFrame:
    """Herfindahl index and share of the ``top`` largest, in ten-thousandths, of whole amounts by group."""
    sums = df.groupBy(group.alias("g")).agg(F.sum(amount).alias("v"))
    every = Window.partitionBy()
    share = sums.withColumn("t", F.sum("v").over(every)).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("v"), "g")))
    bp = F.floor(F.col("v").cast("double") / F.col("t").cast("double") * F.lit(10000.0) + F.lit(0.5)).cast("long")
    return share.agg(
        F.count(F.lit(1)).alias("groups"), F.sum(bp * bp).alias("hhi"), F.sum(F.when(F.col("rank") <= top, bp).otherwise(F.lit(0).cast("long"))).alias("top_share")
    )

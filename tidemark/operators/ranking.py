"""Numbering all rows of a table without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Ranges of ``number_all`` at least, rows of one range on average, and keys sampled for each range.
RANGES, PER_RANGE, SAMPLED = 64, 1_000_000, 32


def number_all(df: DataFrame, by: list[Column], order: list, name: str = "n", per_range: int = PER_RANGE) -> DataFrame:
    """Adds ``name``: 1, 2, ... in ``order``, cut into ranges by all of ``by`` and not by a first number alone.

    The order must be that of ``by``, each ascending and nulls first; so a first value that most rows share is cut by
    the next. Bounds come from keys picked by their hash, a fixed number for each range; df is read three times. Rows
    that are alike in all of ``by`` stay in one range.
    """
    rows, key = df.count(), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(by)])
    ranges = max(RANGES, -(-rows // per_range))
    picked = df.select(key.alias("k")).filter(F.pmod(F.xxhash64("k"), F.lit(max(1, rows // (ranges * SAMPLED)))) == 0).distinct()
    kind = picked.schema["k"].dataType.simpleString()
    seen = [tuple(r["k"]) for r in picked.orderBy("k").collect()]
    bounds = [seen[i * len(seen) // ranges] for i in range(1, ranges)] if len(seen) >= ranges else seen
    cuts = F.array(*[F.struct(*map(F.lit, b)) for b in bounds]).cast(f"array<{kind}>")
    return _numbered(df.withColumn("_range", F.size(F.filter(cuts, lambda b: b < key))), order, name)


def number_rows(df: DataFrame, by: Column, order: list, name: str = "n", buckets: int = 64) -> DataFrame:
    """Adds ``name``: 1, 2, ... in ``order``, whose first part must be the number ``by``, ascending.

    Approximate quantiles of ``by``, which are few and fixed before anything is dealt, cut the rows into ranges; rows
    are numbered within a range, and a range by the rows before it. Nulls of ``by`` come first.
    """
    value, held = by.cast("double"), F.col("_value")
    cuts = df.select(value.alias("v")).approxQuantile("v", [i / buckets for i in range(1, buckets)], 0.001) if buckets > 1 else []
    bounds = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]).cast("array<double>")
    # That the value is asked for twice keeps it a column of its own, which is not computed again for every bound.
    ranged = df.withColumn("_value", value).withColumn("_range", F.when(held.isNotNull(), F.size(F.filter(bounds, lambda b: b < held))).otherwise(0)).drop("_value")
    return _numbered(ranged, order, name)


def _numbered(ranged: DataFrame, order: list, name: str) -> DataFrame:
    before = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"))
    start = F.coalesce(F.sum("_c").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = before.select(F.col("_range").alias("_r"), start.alias("_before"))
    numbered = ranged.withColumn(name, F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return numbered.join(F.broadcast(before), F.col("_range") == F.col("_r")).withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_range", "_r", "_before")

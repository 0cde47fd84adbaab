"""Loading again without doubling: first wins, insert or ignore, new ids, upserts by week."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import number_rows


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, which should be unique within a key; no task sorts the rows of a key."""
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def insert_or_ignore(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """target and the incoming rows whose key it lacks; of incoming rows with one key the first."""
    fresh = first_wins(incoming, keys, order).join(target.select(keys).distinct(), keys, "left_anti")
    return target.unionByName(fresh.select(target.columns))


def append_with_new_ids(target: DataFrame, incoming: DataFrame, id_column: str, order: list[str], buckets: int = 64) -> DataFrame:
    """target and the incoming rows under ids from max(id) + 1 on, in ``order`` (a number first); old_id keeps theirs."""
    top = target.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    moved = number_rows(incoming, F.col(order[0]), [F.col(c).asc_nulls_first() for c in order], "_n", buckets).crossJoin(F.broadcast(top))
    moved = moved.withColumn("old_id", F.col(id_column)).withColumn(id_column, (F.col("_top") + F.col("_n")).cast(target.schema[id_column].dataType))
    return target.withColumn("old_id", F.col(id_column)).unionByName(moved.select(*target.columns, "old_id"))


def upsert_week(target: DataFrame, incoming: DataFrame, week: str, keys: list[str]) -> DataFrame:
    """target with the incoming rows in place of those of the same week and key."""
    kept = target.join(incoming.select(week, *keys).distinct(), [week, *keys], "left_anti")
    return kept.unionByName(incoming.select(target.columns))


def recover(orders: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of a list that can only be read in part, from several orders of it, each cut off somewhere: each key once, with how many orders had it."""
    every = reduce(DataFrame.unionByName, orders)
    return every.groupBy(*key).agg(F.count(F.lit(1)).alias("seen"))


def recovery(first: DataFrame, second: DataFrame, key: list[str], enough: float = 0.99) -> DataFrame:
    """One row: rows of either order and of both, their union, an estimate of all, and whether reading may stop.

    The estimate is that of capture and recapture in Chapman's form, which is defined for an empty overlap as well:
    what two independent readings share says how much both have missed. Orders that put the same rows first share too
    much, and the estimate is then too low; it is never below the union.
    """
    marked = first.select(*key).distinct().withColumn("side", F.lit(1)).unionByName(second.select(*key).distinct().withColumn("side", F.lit(2)))
    each = marked.groupBy(*key).agg(F.sum("side").alias("sides"))
    n = each.agg(F.count_if(F.col("sides") != 2).alias("n_first"), F.count_if(F.col("sides") != 1).alias("n_second"), F.count_if(F.col("sides") == 3).alias("n_both"), F.count(F.lit(1)).alias("n_union"))
    chapman = F.floor((F.col("n_first") + 1) * (F.col("n_second") + 1) / (F.col("n_both") + 1)) - 1
    estimate = F.greatest("n_union", chapman).cast("long")
    return n.withColumn("estimate", estimate).withColumn("enough", F.col("n_union") >= F.col("estimate") * F.lit(enough))

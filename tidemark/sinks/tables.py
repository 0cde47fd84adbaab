"""Writing tables: append, replace, back up, keyed ignore."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.incremental import first_wins


def target(spark: SparkSession, path: str) -> str:
    """Where a table is written: its path, or the same path below the session's tidemark.sandbox, if that is set.

    With a sandbox the writers neither read nor change what stands at the path itself.
    """
    sandbox = spark.conf.get("tidemark.sandbox", None)
    return f"{sandbox.rstrip('/')}/{re.sub('^[A-Za-z][A-Za-z0-9+.-]*:/*', '', path).lstrip('/')}" if sandbox else path


def append_snapshot(df: DataFrame, path: str, by: str = "captured_week") -> None:
    """Adds rows to the folders of their week and changes none that are there."""
    df.write.mode("append").partitionBy(by).parquet(target(df.sparkSession, path))


def _existing(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def insert_new(df: DataFrame, path: str, keys: list[str], order: list[str], by: str | None = None) -> None:
    """Appends the rows whose key the table lacks, so that running again adds nothing."""
    path, fresh = target(df.sparkSession, path), first_wins(df, keys, order)
    if _existing(df.sparkSession, path):
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(keys), keys, "left_anti")
    writer = fresh.write.mode("append")
    (writer.partitionBy(by) if by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions that df has rows of, and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(target(df.sparkSession, path))


def backup_then_delete(table: DataFrame, doomed: Column, backup_path: str, kept_path: str) -> None:
    """Writes the rows to go to one place and all others, nulls of the condition too, to another."""
    going, spark = F.coalesce(doomed, F.lit(False)), table.sparkSession
    table.filter(going).write.mode("errorifexists").parquet(target(spark, backup_path))
    table.filter(~going).write.mode("errorifexists").parquet(target(spark, kept_path))


def update_where_missing(df: DataFrame, column: str, derived: Column) -> DataFrame:
    """The derived value where the column is null or 0; a value that cannot be derived stays null."""
    return df.withColumn(column, F.when(F.coalesce(F.col(column), F.lit(0)) == 0, derived).otherwise(F.col(column)))


def export_csv(df: DataFrame, folder: str, country: str, day: str, kind: str = "prices") -> str:
    """One export of a country and day as CSV with a header; returns its path."""
    path = target(df.sparkSession, f"{folder}/{kind}_{country}_{day}")
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def grouped_sheet(df: DataFrame, brand: str, model: str, shop: str, price: str, shops: list[str]) -> DataFrame:
    """A price sheet: a header row for each brand, then its models, a column for each shop with its lowest price."""
    body = df.groupBy(F.col(brand).alias("brand"), F.col(model).alias("model")).pivot(shop, shops).agg(F.min(price))
    body = body.withColumn("is_header", F.lit(False))
    heads = df.select(F.col(brand).alias("brand")).distinct().withColumn("model", F.lit(None).cast("string")).withColumn("is_header", F.lit(True))
    both = body.unionByName(heads, allowMissingColumns=True)
    return both.select("brand", "model", "is_header", *shops)

"""A store of fetched pages, looked up by address: fresh pages are used, stale and absent ones are the work that is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.urls import clean_url, match_url
from tidemark.sinks.tables import target


def page_key(url: Column) -> Column:
    """The key of an address: a hash of its normal form."""
    return F.xxhash64(match_url(clean_url(url)))


def keep_pages(pages: DataFrame, name: str, path: str, buckets: int = 64) -> None:
    """Writes url, html and fetched_at as the table ``name``, in buckets by key and sorted; of one key the latest page stays.

    The choice is by an aggregation that combines before it shuffles. The hash of the content says later whether a page has changed.
    """
    rows = pages.select(page_key(F.col("url")).alias("key"), "url", "fetched_at", F.xxhash64("html").alias("content"), "html").filter("url IS NOT NULL")
    last = rows.groupBy("key").agg(F.max_by(F.struct("url", "fetched_at", "content", "html"), F.struct("fetched_at", "content")).alias("p")).select("key", "p.*")
    spark = pages.sparkSession
    last.repartition(buckets, "key").write.bucketBy(buckets, "key").sortBy("key").option("path", target(spark, path)).saveAsTable(name)


def look_up(spark: SparkSession, wanted: DataFrame, name: str, now: Column, most_days: int, refetch: bool = False) -> DataFrame:
    """wanted (url and more) with state ``fresh``, ``stale`` or ``absent``, and html, fetched_at and content of the stored page, if any.

    Only the addresses asked for are dealt out; the store is read bucket by bucket, where it lies. With ``refetch`` all
    that is stored is stale.
    """
    store = spark.table(name).select(F.col("key").alias("_k"), "fetched_at", "content", "html")
    asked = wanted.withColumn("_key", page_key(F.col("url")))
    met = asked.hint("shuffle_merge").join(store, F.col("_key") == F.col("_k"), "left")
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("fetched_at").cast("timestamp"))
    fresh = (age <= most_days * 86_400_000_000) & F.lit(not refetch)
    return met.withColumn("state", F.when(F.col("_k").isNull(), "absent").when(fresh, "fresh").otherwise("stale")).drop("_key", "_k")


def work_list(found: DataFrame) -> DataFrame:
    """Addresses to fetch: stale and absent ones, once each."""
    return found.filter("state <> 'fresh'").select("url").distinct()

"""The weekly price board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_week
from tidemark.functions.money import cents, dollars, mean_cents
from tidemark.plans.catalog import query
from tidemark.sources.tables import load


@query("""
WITH p AS (
  SELECT r_name AS region, strftime(l_shipdate, '%G-W%V') AS week, l_suppkey AS shop,
    CAST(floor(l_extendedprice / l_quantity * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS c
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey),
g AS (
  SELECT region, week, min(c) AS lo, count(*) AS offers, count(DISTINCT shop) AS shops,
    CAST(floor(CAST(sum(c) AS DOUBLE) / CAST(count(c) AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS mean
  FROM p GROUP BY region, week)
SELECT region, week, CAST(lo AS DOUBLE) / CAST(100 AS DOUBLE) AS lowest, CAST(mean AS DOUBLE) / CAST(100 AS DOUBLE) AS average,
  offers, shops, CAST(mean - lag(mean) OVER (PARTITION BY region ORDER BY week) AS DOUBLE) / CAST(100 AS DOUBLE) AS change
FROM g
""")
def weekly_price_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and ISO week: lowest and mean unit price, offers, shops, and the mean's change since the week before."""
    places = load(spark, sf_dir, "supplier").join(F.broadcast(load(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    places = places.join(F.broadcast(load(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    price = load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("shop"), iso_week(F.col("l_shipdate")).alias("week"), cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("c")
    )
    week = (
        price.join(places, F.col("shop") == F.col("s_suppkey"))
        .groupBy(F.col("r_name").alias("region"), "week")
        .agg(F.min("c").alias("lo"), mean_cents(F.col("c")).alias("mean"), F.count(F.lit(1)).alias("offers"), F.count_distinct("shop").alias("shops"))
    )
    before = F.lag("mean").over(Window.partitionBy("region").orderBy("week"))
    return week.select(
        "region", "week", dollars(F.col("lo")).alias("lowest"), dollars(F.col("mean")).alias("average"), "offers", "shops", dollars(F.col("mean") - before).alias("change")
    )

"""Exact quantiles of groups of any size: a sketch of fixed size bounds them, and only what lies between the bounds is ranked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.streaming.run import work_dir

#: Size of the sketch, and the share of rows on either side of a quantile that its bounds allow for: first about four times the sketch's error, then more, then all.
K, WIDTHS = 2048, (0.01, 0.1, 1.0)


def exact_quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float], widths: tuple[float, ...] = WIDTHS) -> DataFrame:
    """group and, for each name of shares, the quantile of a whole-number column as a double, interpolated between neighbours.

    A bound that misses its quantile, which the counts below it show, is taken wider for the groups concerned, in the end
    all of the group: the result is exact whatever the sketch says. Null values are left out; a null group is one.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("long").alias("v"))
    spark, path = df.sparkSession, f"{work_dir(df.sparkSession)}/bounds"
    sketches = rows.groupBy("g").agg(F.kll_sketch_agg_bigint("v", F.lit(K)).alias("s"), F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))

    def bound(share: float, width: float, end: str) -> F.Column:
        return F.kll_sketch_get_quantile_bigint("s", F.lit(min(1.0, max(0.0, share + width)))) if abs(width) < 1 else F.col(end)

    each = [F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"), F.array(*[bound(p, -w, "least") for w in widths]).alias("lo"), F.array(*[bound(p, w, "most") for w in widths]).alias("hi")) for name, p in shares.items()]
    sketches.select("g", "n", F.inline(F.array(*each))).write.parquet(path)  # a sketch is random: its bounds are taken once
    bounds, found = spark.read.parquet(path), []
    for i in range(len(widths)):
        own = bounds.select(F.col("g").alias("h"), "n", "name", "p", F.col("lo")[i].alias("lo"), F.col("hi")[i].alias("hi"))
        met = rows.join(own, rows["g"].eqNullSafe(own["h"])).filter(F.col("v") <= F.col("hi"))
        held = met.groupBy("h", "name", "p", "n", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.partitionBy("h", "name").orderBy(F.asc_nulls_first("v")))  # what lies below comes first, as one row
        place = F.col("p") * (F.col("n") - 1)
        picked = held.withColumn("upto", upto).groupBy("h", "name").agg(
            F.min(F.when(F.col("upto") > F.floor(place), F.struct("upto", "v"))).alias("low"), F.min(F.when(F.col("upto") > F.ceil(place), F.struct("upto", "v"))).alias("high"), F.max(place - F.floor(place)).alias("part")
        )
        low, high = F.col("low.v"), F.col("high.v")
        answer = picked.select("h", "name", (low + F.col("part") * (high - low)).alias("q")).filter("q IS NOT NULL")
        found.append(answer)
        if i + 1 == len(widths):
            break
        got = answer.select(F.col("h").alias("h0"), F.col("name").alias("name0"))
        bounds = bounds.join(got, bounds["g"].eqNullSafe(got["h0"]) & (bounds["name"] == got["name0"]), "left_anti")
        if bounds.isEmpty():
            break
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(F.col("h").alias(group)).agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in shares])

"""Price queries: lineitem rows are price snapshots, suppliers shops, parts products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_week
from tidemark.functions.money import cents, difference_class, dollars, mean_cents
from tidemark.operators import snapshots
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans.catalog import query
from tidemark.sources.tables import load

#: SQL for unit prices in cents, and for dollars of a number of cents.
CENTS = "CAST(floor(l_extendedprice / l_quantity * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
LIST = "CAST(floor(p_retailprice * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
DOLLARS = "CAST({} AS DOUBLE) / CAST(100 AS DOUBLE)"
SHARE = "CAST(floor(CAST({} AS DOUBLE) / CAST({} AS DOUBLE) * CAST(10000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"


def prices(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product"), F.col("l_suppkey").alias("shop"), cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("c"), *more
    )


def share(part, whole):
    return F.floor(part.cast("double") / whole.cast("double") * F.lit(10000.0) + F.lit(0.5)).cast("long")


#: Order lines that a task gets.
PER_TASK = 500_000


@query("""
SELECT r_name AS region, n_name AS country, CAST(GROUPING_ID(r_name, n_name) AS BIGINT) AS level, count(DISTINCT s_suppkey) AS shops,
  count(l_orderkey) AS offers, count(DISTINCT l_partkey) AS products
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN lineitem ON l_suppkey = s_suppkey
GROUP BY ROLLUP (r_name, n_name)
""")
def region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shops, offers and products by region and country, with subtotals and the total.

    Lines are counted by shop first, and dealt by product in tasks of PER_TASK, where each product's countries are put in
    order: it counts in every country, in the first country of each region, and in the first of all. So no line is
    repeated for levels, and what a task holds does not grow with the table.
    """
    places = load(spark, sf_dir, "supplier").join(F.broadcast(load(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    places = places.join(F.broadcast(load(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    places = places.select("s_suppkey", F.col("r_name").alias("region"), F.col("n_name").alias("country"))
    lines, level = load(spark, sf_dir, "lineitem"), F.grouping_id().cast("long").alias("level")
    offers = lines.groupBy("l_suppkey").agg(F.count("l_orderkey").alias("n"))
    shops = places.join(offers, F.col("l_suppkey") == F.col("s_suppkey"), "left").rollup("region", "country")
    shops = shops.agg(level, F.count_distinct("s_suppkey").alias("shops"), F.coalesce(F.sum("n"), F.lit(0)).alias("offers"))
    sold = lines.filter("l_partkey IS NOT NULL").select("l_partkey", "l_suppkey").join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    sold = sold.select("l_partkey", "region", "country").repartition(max(1, -(-lines.count() // PER_TASK)), "l_partkey").distinct()
    first = lambda *by: (F.row_number().over(Window.partitionBy("l_partkey", *by).orderBy("region", "country")) == 1).cast("long")
    marked = sold.select("region", "country", first("region").alias("in_region"), first().alias("in_all"))
    places_of = marked.groupBy("region", "country").agg(F.count(F.lit(1)).alias("in_country"), F.sum("in_region").alias("in_region"), F.sum("in_all").alias("in_all"))
    products = places_of.rollup("region", "country").agg(level, *[F.sum(c).alias(c) for c in ("in_country", "in_region", "in_all")])
    products = products.select(F.col("region").alias("r"), F.col("country").alias("c"), F.col("level").alias("l"), F.when(F.col("level") == 0, F.col("in_country")).when(F.col("level") == 1, F.col("in_region")).otherwise(F.col("in_all")).alias("products"))
    same = F.col("region").eqNullSafe(F.col("r")) & F.col("country").eqNullSafe(F.col("c")) & (F.col("level") == F.col("l"))
    return shops.join(products, same, "left").select("region", "country", "level", "shops", "offers", F.coalesce("products", F.lit(0)).alias("products"))


@query(f"""
SELECT product, shop, {DOLLARS.format("c")} AS price, captured_at FROM (
  SELECT l_partkey AS product, l_suppkey AS shop, {CENTS} AS c, l_shipdate AS captured_at,
    row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem)
WHERE n = 1
""")
def latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last snapshot of each product and shop."""
    rows = prices(spark, sf_dir, F.col("l_shipdate").alias("captured_at"), "l_orderkey", "l_linenumber")
    last = snapshots.latest(rows, ["product", "shop"], ["captured_at", "l_orderkey", "l_linenumber"], ["c", "captured_at"])
    return last.select("product", "shop", dollars(F.col("c")).alias("price"), "captured_at")


@query(f"""
SELECT product, {DOLLARS.format("min(c)")} AS lowest, arg_min(shop, {{c: c, shop: shop}}) AS shop, count(DISTINCT shop) AS shops
FROM (SELECT l_partkey AS product, l_suppkey AS shop, {CENTS} AS c FROM lineitem) GROUP BY product
""")
def lowest_shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest offer of each product and the shop that makes it; of equal offers the lower shop."""
    return prices(spark, sf_dir).groupBy("product").agg(
        dollars(F.min("c")).alias("lowest"), F.min_by("shop", F.struct("c", "shop")).alias("shop"), F.count_distinct("shop").alias("shops")
    )


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "SELECT product, "
    + ", ".join(f"""CAST(min(CASE WHEN r_name = '{r}' THEN c END) AS DOUBLE) / CAST(100 AS DOUBLE) AS {r.lower().replace(" ", "_")}""" for r in REGIONS)
    + f""" FROM (SELECT l_partkey AS product, r_name, {CENTS} AS c FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY product"""
)
def shop_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest price of each product by region, a column each."""
    places = load(spark, sf_dir, "supplier").join(F.broadcast(load(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    places = places.join(F.broadcast(load(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name")
    wide = prices(spark, sf_dir).join(places, F.col("shop") == F.col("s_suppkey")).groupBy("product").pivot("r_name", REGIONS).agg(F.min("c"))
    return wide.select("product", *[dollars(F.col(f"`{r}`")).alias(r.lower().replace(" ", "_")) for r in REGIONS])


@query(f"""
WITH s AS (SELECT p_brand AS brand, sum({CENTS.replace(" / l_quantity", "")}) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
t AS (SELECT brand, v, sum(v) OVER () AS t, row_number() OVER (ORDER BY v DESC, brand) AS rank FROM s),
b AS (SELECT rank, {SHARE.format("v", "t")} AS bp FROM t)
SELECT count(*) AS groups, CAST(sum(bp * bp) AS BIGINT) AS hhi, CAST(sum(CASE WHEN rank <= 3 THEN bp ELSE 0 END) AS BIGINT) AS top_share FROM b
""")
def brand_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Herfindahl index and three-brand share of revenue."""
    sold = load(spark, sf_dir, "lineitem").select("l_partkey", cents(F.col("l_extendedprice")).alias("c"))
    both = sold.join(load(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return snapshots.concentration(both, F.col("p_brand"), F.col("c"))


@query(f"""
WITH q AS (SELECT p_brand AS brand, quantile_cont({LIST}, 0.25) AS q1, quantile_cont({LIST}, 0.5) AS q2, quantile_cont({LIST}, 0.75) AS q3
  FROM part GROUP BY p_brand),
b AS (SELECT p_brand AS brand, {LIST} AS c, CASE WHEN {LIST} <= q1 THEN 1 WHEN {LIST} <= q2 THEN 2 WHEN {LIST} <= q3 THEN 3 ELSE 4 END AS band
  FROM part JOIN q ON p_brand = brand)
SELECT brand, CAST(band AS BIGINT) AS band, count(*) AS products, {DOLLARS.format("min(c)")} AS lowest, {DOLLARS.format("max(c)")} AS highest
FROM b GROUP BY brand, band
""")
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List prices of each brand in four bands cut at its exact quartiles."""
    part = load(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), cents(F.col("p_retailprice")).alias("c"))
    cuts = exact_quantiles(part, "brand", "c", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    band = F.when(F.col("c") <= F.col("q1"), 1).when(F.col("c") <= F.col("q2"), 2).when(F.col("c") <= F.col("q3"), 3).otherwise(4)
    return (
        part.join(cuts, "brand")
        .groupBy("brand", band.cast("long").alias("band"))
        .agg(F.count(F.lit(1)).alias("products"), dollars(F.min("c")).alias("lowest"), dollars(F.max("c")).alias("highest"))
    )


@query("""
SELECT CASE WHEN p_size < 1 THEN CAST(0 AS BIGINT) WHEN p_size >= 51 THEN CAST(6 AS BIGINT) ELSE CAST(floor((p_size - 1) / 10.0) AS BIGINT) + 1 END AS band,
  count(*) AS products, CAST(min(p_size) AS BIGINT) AS smallest, CAST(max(p_size) AS BIGINT) AS largest FROM part GROUP BY 1
""")
def size_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by size in five bands of ten inches."""
    size = F.col("p_size")
    return (
        load(spark, sf_dir, "part")
        .groupBy(F.width_bucket(size.cast("double"), F.lit(1.0), F.lit(51.0), F.lit(5)).cast("long").alias("band"))
        .agg(F.count(F.lit(1)).alias("products"), F.min(size).cast("long").alias("smallest"), F.max(size).cast("long").alias("largest"))
    )


#: The types that get a column; others stay out of the matrix.
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "SELECT brand, "
    + ", ".join(f"CAST(floor(CAST(sum(c) FILTER (kind = '{t}') AS DOUBLE) / CAST(count(c) FILTER (kind = '{t}') AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS {t.lower()}" for t in TYPES)
    + f" FROM (SELECT p_brand AS brand, p_type AS kind, {LIST} AS c FROM part) GROUP BY brand"
)
def competitor_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean list price in cents by brand (rows) and type (columns)."""
    part = load(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), cents(F.col("p_retailprice")).alias("c"))
    wide = part.groupBy("brand").pivot("kind", TYPES).agg(mean_cents(F.col("c")))
    return wide.select("brand", *[F.col(t).alias(t.lower()) for t in TYPES])


@query("""
SELECT p_brand AS brand, p_type AS kind, strftime(min(l_shipdate), '%G-W%V') AS first_week
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_type
""")
def new_series_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The week in which each brand and type is first seen."""
    both = load(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate").join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return snapshots.seen(both.withColumnsRenamed({"p_brand": "brand", "p_type": "kind"}), ["brand", "kind"], "l_shipdate").select("brand", "kind", "first_week")


@query("""
WITH s AS (SELECT l_partkey AS product, strftime(max(l_shipdate), '%G-W%V') AS last_week,
  CAST(floor((date_diff('day', DATE '1970-01-01', CAST(max(l_shipdate) AS DATE)) + 3) / 7.0) AS BIGINT) AS last_index FROM lineitem GROUP BY l_partkey)
SELECT product, last_week, m - last_index AS weeks_since FROM (SELECT *, max(last_index) OVER () AS m FROM s) WHERE m - last_index > 8
""")
def delisted_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products not seen in the last eight weeks of all data."""
    seen = snapshots.seen(load(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "product"), ["product"], "l_shipdate")
    newest = seen.agg(F.max("last_index").alias("m"))
    since = F.col("m") - F.col("last_index")
    return seen.crossJoin(F.broadcast(newest)).filter(since > 8).select("product", "last_week", since.alias("weeks_since"))


ORDERED = "l_shipdate, l_orderkey, l_linenumber, l_suppkey, c"
CLASS = """CASE WHEN o IS NULL OR c IS NULL OR o <= 0 THEN 'unknown' WHEN abs(c - o) * 10000 <= o * 500 THEN 'same'
  WHEN abs(c - o) * 10000 > o * 5000 THEN 'suspect' ELSE 'move' END"""


def _steps(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    rows = prices(spark, sf_dir, "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    w = Window.partitionBy(key).orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "c")
    return rows.withColumn("o", F.lag("c").over(w))


@query(f"""
WITH s AS (SELECT l_partkey AS product, c, o, {CLASS} AS verdict FROM (
  SELECT *, lag(c) OVER (PARTITION BY l_partkey ORDER BY {ORDERED}) AS o FROM (SELECT *, {CENTS} AS c FROM lineitem)) WHERE o IS NOT NULL)
SELECT product, {DOLLARS.format("o")} AS before, {DOLLARS.format("c")} AS after, verdict FROM s WHERE verdict = 'suspect'
""")
def price_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a product's price by more than half."""
    steps = _steps(spark, sf_dir, "product").filter(F.col("o").isNotNull()).withColumn("verdict", difference_class(F.col("o"), F.col("c")))
    return steps.filter("verdict = 'suspect'").select("product", dollars(F.col("o")).alias("before"), dollars(F.col("c")).alias("after"), "verdict")


@query(f"""
WITH s AS (SELECT l_partkey AS product, l_suppkey AS shop, {CLASS} AS verdict FROM (
  SELECT *, lag(c) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {ORDERED}) AS o FROM (SELECT *, {CENTS} AS c FROM lineitem)))
SELECT verdict, count(*) AS steps, count(DISTINCT product) AS products FROM s GROUP BY verdict
""")
def price_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps between snapshots of one product in one shop, by class."""
    rows = prices(spark, sf_dir, "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    w = Window.partitionBy("product", "shop").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "c")
    steps = rows.withColumn("verdict", difference_class(F.lag("c").over(w), F.col("c")))
    return steps.groupBy("verdict").agg(F.count(F.lit(1)).alias("steps"), F.count_distinct("product").alias("products"))


@query(f"""
WITH s AS (SELECT l_suppkey AS shop, CAST(sign(c - o) AS INT) AS d, {CLASS} AS verdict FROM (
  SELECT *, lag(c) OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {ORDERED}) AS o FROM (SELECT *, {CENTS} AS c FROM lineitem))),
g AS (SELECT shop, count(CASE WHEN verdict IN ('move', 'suspect') THEN d END) AS moves, min(CASE WHEN verdict IN ('move', 'suspect') THEN d END) AS lo,
  max(CASE WHEN verdict IN ('move', 'suspect') THEN d END) AS hi FROM s GROUP BY shop)
SELECT shop, moves, CASE WHEN moves = 0 THEN 'none' WHEN lo > 0 THEN 'up' WHEN hi < 0 THEN 'down' ELSE 'mixed' END AS direction FROM g
""")
def direction_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do a shop's prices all move one way?"""
    rows = prices(spark, sf_dir, "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")
    w = Window.partitionBy("product", "shop").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "c")
    return snapshots.direction(rows.withColumn("o", F.lag("c").over(w)), "shop", "o", "c")


@query(f"""
WITH b AS (SELECT p_brand AS brand, {LIST} AS l, {CENTS} AS c FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT brand, count(*) AS offers, count(CASE WHEN c < l THEN 1 END) AS discounted,
  coalesce(max(CASE WHEN c < l THEN {SHARE.format("(l - c)", "l")} END), 0) AS deepest FROM b GROUP BY brand
""")
def discount_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers under the list price by brand, and the deepest discount in ten-thousandths."""
    lists = load(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), cents(F.col("p_retailprice")).alias("l"))
    both = prices(spark, sf_dir).join(lists, F.col("product") == F.col("p_partkey"))
    under = F.col("c") < F.col("l")
    return both.groupBy("brand").agg(
        F.count(F.lit(1)).alias("offers"),
        F.count_if(under).alias("discounted"),
        F.coalesce(F.max(F.when(under, share(F.col("l") - F.col("c"), F.col("l")))), F.lit(0).cast("long")).alias("deepest"),
    )


@query("""
SELECT week, count(*) AS offers, count(DISTINCT l_suppkey) AS shops, regexp_matches(week, '^[0-9]{4}-W(0[1-9]|[1-4][0-9]|5[0-3])$') AS valid
FROM (SELECT strftime(l_shipdate, '%G-W%V') AS week, l_suppkey FROM lineitem) GROUP BY week
""")
def iso_week_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week labels and whether each is well formed."""
    rows = load(spark, sf_dir, "lineitem").select(iso_week(F.col("l_shipdate")).alias("week"), "l_suppkey")
    found = rows.groupBy("week").agg(F.count(F.lit(1)).alias("offers"), F.count_distinct("l_suppkey").alias("shops"))
    return found.withColumn("valid", F.col("week").rlike("^[0-9]{4}-W(0[1-9]|[1-4][0-9]|5[0-3])$"))

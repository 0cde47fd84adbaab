"""Ordered-event queries: users stand for sites, error events for blocked fetches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.plans.catalog import query
from tidemark.plans.prices import SHARE, share
from tidemark.sources.tables import load

#: SQL of the events with the run of errors that ends at each.
RUNS = """
m AS (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad FROM events),
i AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM m),
r AS (SELECT *, CAST(sum(bad) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM i)
"""
ORDER = ["ts", "event_id"]
FAILED = "event_type = 'error'"


@query(f"""WITH {RUNS}
SELECT user_id, event_id, ts, run FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM r WHERE run = 3) WHERE n = 1
""")
def breaker_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event at which each user's breaker first trips: three errors in a row."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return runs.trips(events, "user_id", ORDER, F.expr(FAILED), runs.THRESHOLDS["search"]).select("user_id", "event_id", "ts", "run")


@query(f"""WITH {RUNS}
SELECT user_id, event_id, event_type FROM (SELECT *, max(CASE WHEN run >= 3 THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t FROM r) WHERE coalesce(t, 0) = 0
""")
def breaker_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events up to and with the trip."""
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return runs.survivors(events, "user_id", ORDER, F.expr(FAILED), runs.THRESHOLDS["search"]).select("user_id", "event_id", "event_type")


#: Stages of a site's visits by the event's number, and what an event stands for.
VISITS = """
v AS (SELECT user_id, event_id, ['search', 'product', 'review'][1 + event_id % 3] AS stage,
  CASE event_type WHEN 'error' THEN 'blocked' WHEN 'view' THEN 'no_price' ELSE 'ok' END AS status FROM events),
c AS (SELECT *, 'search' AS counter, 'circuit_break' AS kind, 3 AS lim, status = 'blocked' AS bad FROM v WHERE stage = 'search'
  UNION ALL SELECT *, 'product', 'circuit_break', 5, status = 'blocked' FROM v WHERE stage = 'product'
  UNION ALL SELECT *, 'no_price', 'no_price_circuit', 10, status = 'no_price' FROM v WHERE stage = 'product' AND status <> 'blocked'
  UNION ALL SELECT *, 'review', 'circuit_break', 3, status = 'blocked' FROM v WHERE stage = 'review'),
g AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, counter ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS island FROM c),
n AS (SELECT *, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, counter, island ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM g)
"""


@query(f"""WITH {VISITS}
SELECT user_id, stage, event_id, kind, counter, run FROM (SELECT *, row_number() OVER (PARTITION BY user_id, stage ORDER BY event_id) AS k FROM n WHERE run = lim) WHERE k = 1
""")
def breaker_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rows of all breakers: searches, products, products without a price, and reviews, each with its own threshold."""
    stage = F.element_at(F.array(*map(F.lit, ("search", "product", "review"))), (F.col("event_id") % 3 + 1).cast("int"))
    status = F.when(F.col("event_type") == "error", "blocked").when(F.col("event_type") == "view", "no_price").otherwise("ok")
    visits = load(spark, sf_dir, "events").select("user_id", "event_id", stage.alias("stage"), status.alias("status"))
    return runs.circuit_errors(visits, "user_id", "stage", "status", ["event_id"]).select("user_id", "stage", "event_id", "kind", "counter", "run")


@query("""
WITH p AS (SELECT DISTINCT CAST(event_id // 50 AS BIGINT) AS page, user_id, event_type FROM events),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY page) = 1 THEN 1 ELSE 0 END AS new FROM p),
b AS (SELECT page, CAST(sum(new) AS BIGINT) AS new_keys FROM f GROUP BY page),
i AS (SELECT *, sum(CASE WHEN new_keys > 0 THEN 1 ELSE 0 END) OVER (ORDER BY page ROWS UNBOUNDED PRECEDING) AS island FROM b),
r AS (SELECT *, sum(CASE WHEN new_keys = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY page ROWS UNBOUNDED PRECEDING) AS run FROM i)
SELECT page, new_keys, coalesce(max(CASE WHEN run >= 2 THEN 1 ELSE 0 END) OVER (ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS read FROM r
""")
def stop_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 50 events: which are read if reading stops after two pages without a new user and type."""
    events = load(spark, sf_dir, "events").select(F.expr("event_id div 50").alias("page"), "user_id", "event_type")
    return runs.stop_after(events, [], "page", ["user_id", "event_type"], 2)


@query("""
SELECT user_id, event_id, CAST(g AS BIGINT) AS gap_us FROM (
  SELECT user_id, event_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM events) WHERE g > 3600000000
""")
def freshness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come more than an hour after the user's one before; of events at one time the lowest id."""
    return runs.gaps(load(spark, sf_dir, "events"), "user_id", "ts", 3600, order=("event_id",)).select("user_id", "event_id", "gap_us")


@query("""
WITH g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
s AS (SELECT *, CAST(sum(CASE WHEN g IS NULL OR g > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g)
SELECT user_id, session, min(ts) AS started, max(ts) AS ended, count(*) AS rows FROM s GROUP BY user_id, session
""")
def session_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user, split by half an hour without events."""
    return runs.sessions(load(spark, sf_dir, "events"), "user_id", "ts", ["event_id"], 1800)


CONTINUITY = """SELECT {key} AS series, count(*) AS rows, count(DISTINCT {n}) AS numbers, count(*) - count(DISTINCT {n}) AS duplicates,
  CAST(max({n}) - min({n}) + 1 - count(DISTINCT {n}) AS BIGINT) AS missing FROM {table} GROUP BY {key}"""


@query(CONTINUITY.format(key="l_orderkey", n="l_linenumber", table="lineitem"))
def order_line_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps and repeats of line numbers within an order."""
    return runs.continuity(load(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "series"), "series", "l_linenumber")


@query(CONTINUITY.format(key="conv_id", n="turn", table="conversations"))
def turn_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the turns of a conversation, which have neither."""
    return runs.continuity(load(spark, sf_dir, "conversations").withColumnRenamed("conv_id", "series"), "series", "turn")


@query(f"""
SELECT event_type AS status, n, {SHARE.format("n", "sum(n) OVER ()")} AS share FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
""")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type, with the share of all in ten-thousandths."""
    counts = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", share(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query("""
SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS started, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2
""")
def tumbling_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-day windows from Monday to Sunday."""
    week = F.window("ts", "7 days", "7 days", "4 days")
    found = load(spark, sf_dir, "events").groupBy(week, "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))
    return found.select(F.col("window.start").cast("timestamp_ntz").alias("started"), "event_type", "n", "users")


@query("""
SELECT event_type, count(*) AS n, count(CASE WHEN json_valid(props) THEN 1 END) AS valid, CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS total,
  count(DISTINCT props->>'$.k') AS kinds FROM events GROUP BY event_type
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in props: validity, and sum and kinds of their field k."""
    k = F.get_json_object("props", "$.k")
    return (
        load(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.try_parse_json("props").isNotNull()).alias("valid"),
            F.sum(k.try_cast("long")).alias("total"), F.count_distinct(k).alias("kinds"),
        )
    )


@query("""
SELECT user_id, event_id, CAST(n AS BIGINT) AS attempt, n > 3 AS flagged FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'error') WHERE n <= 8
""")
def attempt_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's failures numbered, up to the cap of eight attempts; those after the third are flagged."""
    failed = load(spark, sf_dir, "events").filter(F.expr(FAILED)).select("user_id", "event_id", "ts")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy(*ORDER)).cast("long")
    return failed.withColumn("attempt", n).filter("attempt <= 8").select("user_id", "event_id", "attempt", (F.col("attempt") > 3).alias("flagged"))

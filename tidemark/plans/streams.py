"""Queries that run a stream over a stored table until it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import query
from tidemark.plans.states import RUNS, VISITS
from tidemark.streaming import breaker, keyed
from tidemark.streaming.run import available_now, table_stream


@query(f"""WITH {RUNS}
SELECT user_id, event_id, run FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM r WHERE run = 3) WHERE n = 1
""")
def breaker_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of each user's breaker, found by the stream."""
    events = table_stream(spark, sf_dir, "events")
    marked = events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("failed"))
    return available_now(breaker.breaker(marked)).select("user_id", "event_id", "run")


@query("SELECT user_id, event_type FROM events GROUP BY user_id, event_type")
def first_seen_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user and event type once, however often the stream brings it."""
    events = table_stream(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return available_now(breaker.new_keys(events, ["user_id", "event_type"], "ts", "3650 days")).select("user_id", "event_type")


@query(f"""WITH {VISITS}
SELECT user_id, stage, event_id, kind, counter, run FROM (SELECT *, row_number() OVER (PARTITION BY user_id, stage ORDER BY event_id) AS k FROM n WHERE run = lim) WHERE k = 1
""")
def circuit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error rows of all four breakers, found by the stream on keyed state."""
    stage = F.element_at(F.array(*map(F.lit, ("search", "product", "review"))), (F.col("event_id") % 3 + 1).cast("int"))
    status = F.when(F.col("event_type") == "error", "blocked").when(F.col("event_type") == "view", "no_price").otherwise("ok")
    visits = table_stream(spark, sf_dir, "events").select(F.col("user_id").alias("site"), stage.alias("stage"), F.col("event_id").alias("seq"), status.alias("status"))
    return available_now(keyed.circuits(visits)).withColumnsRenamed({"site": "user_id", "seq": "event_id"}).select("user_id", "stage", "event_id", "kind", "counter", "run")


@query("""
WITH p AS (SELECT DISTINCT CAST(user_id % 5 AS VARCHAR) AS scope, CAST(event_id // 100 AS BIGINT) AS page, user_id, event_type FROM events),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY scope, user_id, event_type ORDER BY page) = 1 THEN 1 ELSE 0 END AS new FROM p),
b AS (SELECT scope, page, CAST(sum(new) AS BIGINT) AS new_keys FROM f GROUP BY scope, page),
i AS (SELECT *, sum(CASE WHEN new_keys > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scope ORDER BY page ROWS UNBOUNDED PRECEDING) AS island FROM b),
r AS (SELECT *, sum(CASE WHEN new_keys = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scope, island ORDER BY page ROWS UNBOUNDED PRECEDING) AS run FROM i)
SELECT scope, page, new_keys FROM (SELECT *, coalesce(max(CASE WHEN run >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY scope ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM r) WHERE over = 0
""")
def known_pages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 100 events of each scope, read by the stream until two pages in a row bring no new user and type."""
    events = table_stream(spark, sf_dir, "events")
    key = F.concat_ws("/", F.col("user_id").cast("string"), "event_type")
    pages = events.select((F.col("user_id") % 5).cast("string").alias("scope"), F.floor(F.col("event_id") / 100).alias("page"), key.alias("key"))
    return available_now(keyed.known_pages(pages)).select("scope", "page", "new_keys")

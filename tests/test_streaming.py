"""Streams give what the batch operators give, whatever files the rows come in."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.streaming import breaker, keyed
from tidemark.streaming.run import available_now

BASE = dt.datetime(2026, 1, 5)


def stream(spark, df, folder, files):
    """df as a stream that takes a file a batch, in the order of column ``part``."""
    for i in range(files):
        df.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)


def test_breaker_state_lasts_over_batches(spark, tmp_path):
    rng = random.Random(7)
    rows = [(u, i, BASE + dt.timedelta(minutes=i), rng.random() < 0.5, i // 40) for i in range(160) for u in range(3)]
    df = spark.createDataFrame([(u, i * 10 + u, t, f, p) for u, i, t, f, p in rows], "user_id long, event_id long, ts timestamp, failed boolean, part int")
    got = available_now(breaker.breaker(stream(spark, df, str(tmp_path / "in"), 4))).select("user_id", "event_id", "run").collect()
    want = runs.trips(df, "user_id", ["ts", "event_id"], F.col("failed"), 3).select("user_id", "event_id", "run").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3


def test_new_keys_come_once(spark, tmp_path):
    rows = [(i % 5, BASE + dt.timedelta(hours=i), i // 20) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, part int")
    got = available_now(breaker.new_keys(stream(spark, df, str(tmp_path / "in"), 3), ["k"], "ts")).collect()
    assert sorted(r["k"] for r in got) == [0, 1, 2, 3, 4]


def test_reading_stops_when_nothing_is_new(spark, tmp_path):
    pages = [["a", "b"], ["b"], ["c"], ["a"], ["b"], ["d"]]
    df = spark.createDataFrame([("s", p, k, p // 2) for p, keys in enumerate(pages) for k in keys], "scope string, page long, key string, part int")
    got = available_now(breaker.stop_when_known(stream(spark, df, str(tmp_path / "in"), 3))).orderBy("page").collect()
    assert [(r["page"], r["new_keys"]) for r in got] == [(0, 2), (1, 0), (2, 1), (3, 0), (4, 0)]
    batch = runs.stop_after(df, ["scope"], "page", ["key"], 2).filter("read").orderBy("page").collect()
    assert [(r["page"], r["new_keys"]) for r in batch] == [(r["page"], r["new_keys"]) for r in got]


def test_weeks_close_with_the_watermark(spark, tmp_path):
    rows = [(BASE + dt.timedelta(days=d), "x", 0 if d < 20 else 1) for d in range(0, 40, 2)]
    df = spark.createDataFrame(rows, "ts timestamp, kind string, part int")
    got = available_now(breaker.weekly_counts(stream(spark, df, str(tmp_path / "in"), 2), "ts", ["kind"])).collect()
    assert {r["window"]["start"].weekday() for r in got} == {0} and sum(r["n"] for r in got) <= len(rows)


def test_a_named_stream_resumes(spark, tmp_path):
    folder, kind = str(tmp_path / "in"), "user_id long, event_id long, ts timestamp, failed boolean"
    name, runs_of = f"resume-{tmp_path.name}", []
    for part in ([1, 2], [3, 4], []):
        if part:
            rows = [(7, i, BASE + dt.timedelta(minutes=i), True) for i in part]
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(spark.createDataFrame([], kind).schema).parquet(folder)
        runs_of.append([tuple(r) for r in available_now(breaker.breaker(source), name=name).select("user_id", "event_id", "run").collect()])
    assert runs_of == [[], [(7, 3, 3)], [(7, 3, 3)]]


def visits(rng, n, parts):
    stages = ["search", "product", "review", "series"]
    return [(i % 6, stages[rng.randrange(4)], i, rng.choice(["blocked", "blocked", "failed", "no_price", "no_price", "ok", None]), i * parts // n) for i in range(n)]


def test_circuits_match_the_batch_form_over_batches(spark, tmp_path):
    rows = visits(random.Random(11), 1200, 5)
    df = spark.createDataFrame(rows, "site long, stage string, seq long, status string, part int")
    limits = {"product": 4, "no_price": 5, "series": 2}
    got = available_now(keyed.circuits(stream(spark, df, str(tmp_path / "in"), 5), limits)).select("site", "stage", "seq", "kind", "counter", "run").collect()
    want = runs.circuit_errors(df, "site", "stage", "status", ["seq"], limits).select("site", "stage", "seq", "kind", "counter", "run").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r["counter"] for r in want} == {"search", "product", "no_price", "review", "series"}


def test_circuits_resume_after_a_run_that_ended_half_way(spark, tmp_path):
    rows, folder, name = visits(random.Random(12), 600, 4), str(tmp_path / "in"), f"circuits-{tmp_path.name}"
    df = spark.createDataFrame(rows, "site long, stage string, seq long, status string, part int")
    for half in ((0, 1), (2, 3)):
        for i in half:
            df.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(folder)
        got = available_now(keyed.circuits(source), name=name).select("site", "stage", "seq", "counter").collect()
    want = runs.circuit_errors(df, "site", "stage", "status", ["seq"]).select("site", "stage", "seq", "counter").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and want


def test_known_pages_write_only_what_is_new(spark, tmp_path):
    rows = [("s", p, f"k{k}", p // 3) for p in range(18) for k in range(p * 20, p * 20 + 25)]
    df = spark.createDataFrame(rows, "scope string, page long, key string, part int")
    out = keyed.known_pages(stream(spark, df, str(tmp_path / "in"), 6))
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    updated = [int(p["stateOperators"][0]["numRowsUpdated"]) for p in query.recentProgress if p["numInputRows"]]
    assert len(updated) == 6 and max(updated) <= 3 * 25 + 2
    got = sorted((r["page"], r["new_keys"]) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == [(p, 25 if p == 0 else 20) for p in range(18)]


def test_known_pages_match_the_batch_form(spark, tmp_path):
    rng = random.Random(13)
    rows = [(s, p, str(rng.randrange(25)) if rng.random() < 0.95 else None, p // 8) for s in ("a", "b", None) for p in range(24) for _ in range(4)]
    df = spark.createDataFrame(rows, "scope string, page long, key string, part int")
    for quiet in (1, 2):
        got = available_now(keyed.known_pages(stream(spark, df, str(tmp_path / f"in{quiet}"), 3), quiet)).collect()
        batch = runs.stop_after(df.fillna("", ["key"]), ["scope"], "page", ["key"], quiet).filter("read").collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(((r["scope"], r["page"], r["new_keys"]) for r in batch), key=str)

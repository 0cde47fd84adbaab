"""Queries on copies of the tables: ties, rows dealt by their number, and plans that do a row's work once."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import ranking, runs
from tidemark.plans import made, prices
from tidemark.sources import tables


def test_of_events_at_one_time_the_lowest_id_has_the_gap(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(copy * 100 + at, 7, base + dt.timedelta(hours=2 * at)) for copy in reversed(range(9)) for at in range(5)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz").coalesce(1)
    events.write.parquet(str(tmp_path / "events.parquet"))
    want = [(at, 7_200_000_000) for at in range(1, 5)]
    assert sorted(tuple(r)[1:] for r in entry.queries()["freshness_gaps"](spark, str(tmp_path)).collect()) == want
    for per_range in (5, 20):
        got = runs.gaps(events, "user_id", "ts", 3600, per_range, ("event_id",)).collect()
        assert sorted((r["event_id"], r["gap_us"]) for r in got) == want, per_range


def shown(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def products(spark, path, rows):
    part = spark.range(1, rows + 1).selectExpr("id AS p_partkey", "concat('name ', id) AS p_name", "concat('brand', id % 9) AS p_brand", "concat('type', id % 5) AS p_type", "CAST(id % 50 + 1 AS INT) AS p_size", "id / 4.0D AS p_retailprice")
    part.coalesce(1).write.parquet(f"{path}/part.parquet")
    return str(path)


def test_rows_are_dealt_by_their_number(spark, tmp_path):
    assert tables.spread(spark.range(100), "id", 100).rdd.getNumPartitions() == spark.range(100).rdd.getNumPartitions()
    many = tables.spread(spark.range(1000).coalesce(1), "id", 10)
    assert many.rdd.getNumPartitions() == 100
    assert sorted(r["id"] for r in many.collect()) == list(range(1000))


@pytest.mark.parametrize("query, rows", [("spec_triples", 80_004)])
def test_pages_made_of_one_small_file_are_read_by_several_tasks(spark, tmp_path, query, rows):
    df = entry.queries()[query](spark, products(spark, tmp_path, 20_001))
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == rows


def test_responses_are_made_once_and_read_without_patterns(spark, tmp_path):
    df = entry.queries()["block_cases"](spark, products(spark, tmp_path, 10_008))
    plan = shown(df)
    assert "RepartitionByExpression" in plan
    assert "RLIKE" not in plan and plan.count("rpad(") == 1
    assert {r["kind"]: r["responses"] for r in df.collect()} == kinds(10_008)


def kinds(rows):
    found = {}
    for k in range(1, rows + 1):
        kind = made.RESPONSES[k % len(made.RESPONSES)][5]
        found[kind] = found.get(kind, 0) + 1
    return found


def test_a_price_form_is_filled_in_once(spark, tmp_path):
    plan = shown(entry.queries()["money_texts"](spark, products(spark, tmp_path, 10_008)))
    assert "RepartitionByExpression" in plan
    assert plan.count(", {lakh},") <= 1


def test_a_rank_does_not_compute_its_value_for_every_bound(spark):
    df = spark.range(1000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("h"))
    by = F.conv(F.substring("h", 1, 12), 16, 10).cast("long")
    got = ranking.number_rows(df, by, ["h", "id"])
    assert not re.search(r"lambda[^,]* < [^,]*conv\(", shown(got))
    assert [r["n"] for r in got.orderBy("h").collect()] == list(range(1, 1001))
    odd = spark.createDataFrame([(1, None), (2, 5.0), (3, float("nan")), (4, None), (5, -1.0)], "id int, v double")
    rows = ranking.number_rows(odd, F.col("v"), [F.col("v").asc_nulls_first(), "id"], buckets=3).collect()
    assert {r["id"]: r["n"] for r in rows} == {1: 1, 4: 2, 5: 3, 2: 4, 3: 5}


def test_no_line_is_repeated_for_the_levels_of_a_rollup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prices, "PER_TASK", 50, raising=False)
    shops = [(i, i % 5) for i in range(1, 21)] + [(21, None), (22, 4), (22, 4)]
    nations = [(0, "A", 0), (1, "B", 0), (2, "A", 1), (3, None, 1), (4, "E", 2)]
    regions = [(0, "one"), (1, "two"), (2, None)]
    lines = [(None if i % 11 == 0 else i, None if i % 13 == 0 else i * i % 37, i % 24) for i in range(400)]
    tables_of = {
        "supplier": ("s_suppkey long, s_nationkey int", shops), "nation": ("n_nationkey int, n_name string, n_regionkey int", nations), "region": ("r_regionkey int, r_name string", regions),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long", lines),
    }
    for name, (schema, rows) in tables_of.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = entry.queries()["region_rollup"](spark, str(tmp_path))
    want = {}
    for shop, nation in shops:
        for key, name, region in nations:
            if key == nation:
                place = dict(regions)[region]
                for group in ((place, name, 0), (place, None, 1), (None, None, 3)):
                    own = want.setdefault(group, [set(), 0, set()])
                    own[0].add(shop)
                    own[1] += sum(s == shop and o is not None for o, _, s in lines)
                    own[2] |= {p for _, p, s in lines if s == shop and p is not None}
    assert {(r["region"], r["country"], r["level"]): (r["shops"], r["offers"], r["products"]) for r in df.collect()} == {g: (len(s), n, len(p)) for g, (s, n, p) in want.items()}
    assert not [line for line in shown(df).splitlines() if "Expand" in line and "l_partkey" in line]

"""Operators whose plans must hold at scale: quantiles, the page store, recovery and passages, against brute force and by their plans."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental, matching
from tidemark.operators.quantiles import exact_quantiles
from tidemark.sources import pages as cache


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def quantile(values, p):
    values, place = sorted(values), p * (len(values) - 1)
    low = int(place)
    return values[low] + (place - low) * (values[min(low + 1, len(values) - 1)] - values[low])


@pytest.mark.parametrize("widths", [(0.01, 0.1, 1.0), (0.0, 0.001, 1.0), (1.0,)])
def test_quantiles_are_exact_whatever_the_sketch_says(spark, widths):
    rng = random.Random(5)
    groups = {"one": [7], "two": [3, 9], "ties": [5] * 100 + [6] * 3, None: [1, 2, 3, 4], "many": [rng.randrange(10**9) for _ in range(20_000)], "skew": [int(rng.paretovariate(0.5) * 10) for _ in range(5000)]}
    table = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("nulls", None)], "g string, v long").repartition(5)
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.77, "e": 1.0}
    got = {r["g"]: [r[n] for n in shares] for r in exact_quantiles(table, "g", "v", shares, widths).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx([quantile(vs, p) for p in shares.values()], rel=1e-12), g


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, v long"), "g", "v", {"q": 0.5}).count() == 0


def test_a_look_up_leaves_the_store_where_it_lies(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    pages = [(f"https://X.example/p/{i}/", f"<p>{i}</p>", base + dt.timedelta(days=i % 20)) for i in range(200)] + [("https://x.example/p/5?ref=1", "<p>new</p>", base + dt.timedelta(days=19)), (None, "x", base)]
    name = f"store_{tmp_path.name.replace('-', '_')}"
    cache.keep_pages(spark.createDataFrame(pages, "url string, html string, fetched_at timestamp"), name, str(tmp_path / "store"), 8)
    assert spark.table(name).count() == 200
    wanted = spark.createDataFrame([(f"http://x.example/p/{i}" if i == 999 else f"https://x.example/p/{i}", i) for i in (5, 6, 19, 300, 999)] + [(None, -1)], "url string, n int")
    found = cache.look_up(spark, wanted, name, F.lit(base + dt.timedelta(days=20)), 7)
    got = {r["n"]: (r["state"], r["html"]) for r in found.collect()}
    assert got == {5: ("fresh", "<p>new</p>"), 6: ("stale", "<p>6</p>"), 19: ("fresh", "<p>19</p>"), 300: ("absent", None), 999: ("absent", None), -1: ("absent", None)}
    assert {r["url"] for r in cache.work_list(found).collect()} == {"https://x.example/p/6", "https://x.example/p/300", "http://x.example/p/999", None}
    assert {r["state"] for r in cache.look_up(spark, wanted.filter("n < 100"), name, F.lit(base), 7, refetch=True).filter("n > 0").collect()} == {"stale"}
    text = found._jdf.queryExecution().sparkPlan().toString() + plan(found)
    assert len(re.findall(r"Exchange hashpartitioning", plan(found).split("== Initial Plan ==")[-1])) == 1 and "Bucketed: true" in text
    spark.sql(f"DROP TABLE {name}")


def test_recovery_from_two_orders(spark):
    rng = random.Random(6)
    every = list(range(3000))
    a, b = rng.sample(every, 2400), rng.sample(every, 2200)
    one, two = (spark.createDataFrame([(i,) for i in x + x[:50]], "k int") for x in (a, b))
    r = incremental.recovery(one, two, ["k"]).first()
    both, union = len(set(a) & set(b)), len(set(a) | set(b))
    assert (r["n_first"], r["n_second"], r["n_both"], r["n_union"]) == (2400, 2200, both, union)
    assert r["estimate"] == max(union, 2401 * 2201 // (both + 1) - 1) and abs(r["estimate"] - 3000) < 90 and not r["enough"]
    assert {x["k"] for x in incremental.recover([one, two], ["k"]).collect()} == set(a) | set(b)
    nothing = incremental.recovery(one.limit(0), two.limit(0), ["k"]).first()
    assert (nothing["n_union"], nothing["estimate"], nothing["enough"]) == (0, 0, True)


def test_passages_take_documents_apart_once(spark, tmp_path):
    rng = random.Random(7)
    bits = ["the ", "of ", "a", "ab", "word ", "longer ", "x1 ", ". ", ", ", "é", "\n", "-", "the of the ", "Zz"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 60))) for _ in range(150)] + ["", None, "the " * 3000]
    passages = [t[k : k + rng.choice([1, 2, 3, 5, 9, 15, 30, 60])] for t in texts[:120] if t for k in [rng.randrange(len(t))]] + ["", None, "absent passage"]
    items = spark.createDataFrame(list(enumerate(passages)), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = matching.passages_in(items, docs, str(tmp_path / "postings"))
    assert {tuple(r) for r in found.collect()} == {(i, j) for i, p in enumerate(passages) if p for j, t in enumerate(texts) if t and p in t}
    kinds = {r["kind"] for r in spark.read.parquet(str(tmp_path / "postings")).select("kind").distinct().collect()}
    long = spark.createDataFrame([(1, "x word longer the of")], "item_id int, text string")
    matching.passages_in(long, docs, str(tmp_path / "one")).collect()
    assert len(kinds) > 3 and {r["kind"] for r in spark.read.parquet(str(tmp_path / "one")).select("kind").distinct().collect()} <= {12}
    assert matching.passages_in(items.filter("item_id < 0"), docs).count() == 0

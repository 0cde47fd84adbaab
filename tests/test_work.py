"""Lists of pages, site codes, keys in addresses, ranges of time and of order, and writers in a sandbox."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidemark.functions import money, urls
from tidemark.operators import paging, ranking, runs
from tidemark.plans.config import Field, ShopSchema
from tidemark.sinks import state, tables


def history(rng, n=400):
    """Events of a hot user, a few others and none, with ties, missing times and pauses."""
    start, out = dt.datetime(2024, 1, 1), []
    for i in range(n):
        user = rng.choice([1, 1, 1, 2, 3, None])
        out.append((i, user, None if rng.random() < 0.03 else start + dt.timedelta(seconds=rng.choice([60, 3600]) * rng.randrange(200))))
    return out


def test_sessions_and_gaps_are_the_same_in_any_number_of_ranges(spark):
    rng = random.Random(3)
    rows = history(rng)
    events = spark.createDataFrame(rows, "id int, user int, ts timestamp")
    want_gaps, want = [], []
    for user in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[0]))
        pieces, last = [], None
        for i, (_, _, at) in enumerate(own):
            since = (at - last).total_seconds() if at and last else None
            if i == 0 or since is None or since > 1800:
                pieces.append([])
            pieces[-1].append(at)
            if since is not None and since > 1800:
                want_gaps.append((user, at, int(since * 1_000_000)))
            last = at
        want += [(user, k + 1, min(filter(None, p), default=None), max(filter(None, p), default=None), len(p)) for k, p in enumerate(pieces)]
    for per_range in (10_000, 150, 40, 7):
        got = [tuple(r) for r in runs.sessions(events, "user", "ts", ["id"], 1800, per_range).select("user", "session", "started", "ended", "rows").collect()]
        assert sorted(got, key=str) == sorted(want, key=str), per_range
        found = [(r["user"], r["ts"], r["gap_us"]) for r in runs.gaps(events, "user", "ts", 1800, per_range).collect()]
        assert sorted(found, key=str) == sorted(want_gaps, key=str), per_range
    none = spark.createDataFrame([], events.schema)
    assert runs.sessions(none, "user", "ts", ["id"], 1800).count() == runs.gaps(none, "user", "ts", 1800).count() == 0


def test_failure_runs_without_and_with_ranges(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 1, 2]), i // 2, rng.random() < 0.8) for i in range(300)]
    events = spark.createDataFrame(rows, "id int, k int, at int, bad boolean")
    want, run = {}, {}
    for i, k, _, bad in rows:
        want[i] = run[k] = run.get(k, 0) + 1 if bad else 0
    for per_range in (10_000, 60, 20):
        got = {r["id"]: r["run"] for r in runs.failure_runs(events, "k", ["at", "id"], F.col("bad"), per_range).collect()}
        assert got == want, per_range


def test_all_rows_are_numbered_where_most_share_a_first_value(spark):
    rng = random.Random(7)
    rows = [(rng.choice([100, 100, 100, 100, 50, None]), rng.choice([1, 1, 1, 2, 9]), f"h{rng.randrange(10**6)}") for _ in range(3000)]
    df = spark.createDataFrame(rows, "purity int, hits int, host string")
    by = [F.col("purity"), F.col("hits"), F.col("host")]
    got = ranking.number_all(df, by, ["purity", "hits", "host"], "n", per_range=20).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["n"])] == want and sorted(r["n"] for r in got) == list(range(1, 3001))
    assert ranking.number_all(spark.createDataFrame([], df.schema), by, ["purity", "hits", "host"]).count() == 0
    same = spark.createDataFrame([(1, 1, "a")] * 50, df.schema)
    assert sorted(r["n"] for r in ranking.number_all(same, by, ["host"], "n", per_range=5).collect()) == list(range(1, 51))


def test_lists_end_for_each_reason(spark):
    pages = {
        "empty": [["a", "b"], ["c", "d"], [], ["e"]], "known": [["a", "b"], ["b", "a"], ["c"]], "full": [["a", "b"], ["c", "d"], ["e", "f"], ["g"]], "short": [["a", "b"], ["c"]],
        "long": [[x + "1", x + "2"] for x in "ab"], "limit": [["a"], ["b"], ["c"], ["d"], ["e"]], "gone": [None, ["a"]], "nulls": [[None, "a"], [None]], None: [["a"]],
    }
    total = {"short": 3, "long": None, "limit": 99}
    rows = [(s, i, keys, total.get(s, 50)) for s, p in pages.items() for i, keys in enumerate(p)]
    df = spark.createDataFrame(rows, "s string, p long, k array<string>, t long")
    got = {}
    for r in sorted(paging.read_pages(df, "s", "p", "k", "t", 2, 4, 5).collect(), key=lambda r: r["page"]):
        got.setdefault(r["scope"], []).append((r["new_keys"], r["taken"], r["stop"]))
    assert got == {
        "empty": [(2, 2, None), (2, 2, None), (0, 0, "empty_page")], "known": [(2, 2, None), (0, 0, "page_all_known")], "full": [(2, 2, None), (2, 2, None), (2, 1, "max_reviews")],
        "short": [(2, 2, None), (1, 1, "exhausted")], "long": [(2, 2, None), (2, 2, None)], "limit": [(1, 1, None), (1, 1, None), (1, 1, None), (1, 1, "max_pages")],
        "gone": [(0, 0, "empty_page")], "nulls": [(1, 1, None), (0, 0, "empty_page")], None: [(1, 1, None)],
    }
    assert paging.read_pages(df.limit(0), "s", "p", "k", "t", 2, 4, 5).count() == 0


def test_addresses_of_each_kind(spark):
    rows = [(k, "https://x.example/l?a=1" if k == "query_param" else "https://x.example/l/", n) for k, n in (("none", 99), ("url_page", 61), ("query_param", 31), ("click_more", 31), ("bv_api", 500), ("other", 9), (None, 9), ("url_page", None))]
    got = {}
    for r in paging.page_addresses(spark.createDataFrame(rows, "k string, u string, n long"), "u", "k", "n", 30, 50, "from", 70).collect():
        got.setdefault((r["k"], r["n"]), []).append((r["page"], r["start"], r["address"]))
    assert {k: len(v) for k, v in got.items()} == {("none", 99): 1, ("url_page", 61): 3, ("query_param", 31): 2, ("click_more", 31): 2, ("bv_api", 500): 3, ("url_page", None): 1}
    assert got["url_page", 61][2] == (3, 60, "https://x.example/l/page/3") and got["query_param", 31][1] == (2, 30, "https://x.example/l?a=1&from=30")
    assert got["bv_api", 500][2] == (3, 60, "https://x.example/l/?offset=60&limit=30") and {a for *_, a in got["click_more", 31]} == {"https://x.example/l/"}


def test_codes_keys_and_transforms(spark):
    one = spark.createDataFrame([("shop_ru", "shop_RU_x", "https://a/f-107-aaarz6.html?x", "https://b/dp/B07ABCDEF1/ref", "https://b/dp/B07ABCDEF12", "$12,999.00 $1.00", "12,999.00", "<b>Marca: Any Name</b>4,5")], "a string, b string, c string, d string, e string, f string, g string, h string")
    got = one.select(
        money.site_currency(F.col("a")), money.site_currency(F.col("b")), urls.sku(F.col("c")), urls.sku(F.col("d")), urls.sku(F.col("e")), money.peso_price(F.col("f")).cast("double"), money.peso_price(F.col("g")),
        urls.review_number(F.lit("x?ReviewCD=12&y")), urls.review_number(F.lit("x?reviewcd=12")),
    ).first()
    assert tuple(got) == ("RUB", None, "aaarz6", "B07ABCDEF1", None, 12999.0, None, "12", None)
    shop = ShopSchema("s", "https://x/?q={q}", fields=(Field("brand", ("<b>(.*?)</b>",), transform="brand"), Field("stars", ("</b>(.*)",), transform="rating"), Field("none", ("<u>(.*?)</u>",), transform="currency_mx")))
    assert shop.extract(one.select("h"), "h").select("brand", "stars", "none").first() == ("Any Name", 4.5, None)


def test_every_writer_stays_in_the_sandbox(spark, tmp_path):
    df = spark.createDataFrame([("w1", 1, 5.0), ("w1", 2, None)], "captured_week string, k int, price double")
    out, box = tmp_path / "real", tmp_path / "box"
    spark.conf.set("tidemark.sandbox", str(box))
    try:
        tables.append_snapshot(df, f"{out}/snap")
        tables.backup_then_delete(df, F.col("price") > 1, f"{out}/gone", f"{out}/kept")
        path = tables.export_csv(df, str(out), "us", "20261001")
        assert state.write_state(df, f"{out}/state") == 1 and state.write_state(df, f"{out}/state") == 2
        assert state.read_state(spark, f"{out}/state", "captured_week string, k int, price double").count() == 2
        assert path.startswith(str(box)) and spark.read.csv(path, header=True).count() == 2 and not os.path.exists(out)
    finally:
        spark.conf.unset("tidemark.sandbox")
    assert state.read_state(spark, f"{out}/state", "k int").count() == 0

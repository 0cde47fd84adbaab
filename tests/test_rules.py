"""Rules on small tables: incremental loads, runs, reports, schemas, readers and writers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import extraction, incremental, matching, quality, reviews, runs, snapshots
from tidemark.plans.config import Field, ShopSchema
from tidemark.sinks import state as run_state
from tidemark.sinks import tables as sinks
from tidemark.sinks.report import Report
from tidemark.sources import tables as sources


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_loading_again_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a", "old")], "p int, k string, o string")
    incoming = spark.createDataFrame([(1, "a", "new"), (2, "b", "new"), (2, "b", "newer")], "p int, k string, o string")
    once = incremental.insert_or_ignore(target, incoming, ["p", "k"], ["o"])
    assert rows(once) == [(1, "a", "old"), (2, "b", "new")]
    assert rows(incremental.insert_or_ignore(once, incoming, ["p", "k"], ["o"])) == rows(once)


def test_insert_new_is_rerun_safe(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    sinks.insert_new(df, path, ["k"], ["v"])
    sinks.insert_new(df, path, ["k"], ["v"])
    assert rows(spark.read.parquet(path)) == [(1, "x"), (2, "z")]


def test_new_ids_follow_the_largest(spark):
    target = spark.createDataFrame([(7, "a")], "id long, n string")
    got = incremental.append_with_new_ids(target, spark.createDataFrame([(3, "c"), (1, "b")], "id long, n string"), "id", ["id"], buckets=3)
    assert rows(got.select("id", "n", "old_id")) == [(7, "a", 7), (8, "b", 1), (9, "c", 3)]


def test_week_upsert(spark):
    old = spark.createDataFrame([("w1", 1, 5), ("w1", 2, 6), ("w2", 1, 7)], "w string, k int, v int")
    new = spark.createDataFrame([("w2", 1, 9)], "w string, k int, v int")
    assert rows(incremental.upsert_week(old, new, "w", ["k"])) == [("w1", 1, 5), ("w1", 2, 6), ("w2", 1, 9)]


def events(spark, marks):
    return spark.createDataFrame([("s", i, m) for i, m in enumerate(marks)], "site string, seq int, mark string")


def test_breaker_positions(spark):
    bad = F.col("mark") == "b"
    trip = lambda marks, n: [r["seq"] for r in runs.trips(events(spark, marks), "site", ["seq"], bad, n).collect()]
    assert trip("bbbo", 3) == [2]
    assert trip("bbobbb", 3) == [5]
    assert trip("bbobb", 3) == []
    assert len(runs.survivors(events(spark, "bbbooo"), "site", ["seq"], bad, 3).collect()) == 3


def test_why_nothing_matched(spark):
    titles = {
        "65U7SG": ['Screen 55" Class U7SG', "Screen 75 inch U7SG"], "65U8N": ["Screen 65 inch U8N"], "50A9QX": ["Screen 50 inch B1"],
        "55Q7QX": ["Screen refurbished 55 inch Q7QX"], "43K5QX": ["Screen 43 inch K5QX"],
    }
    rules = matching.MatchRules(reject_words=("refurbished",))
    pairs = spark.createDataFrame([(t, x) for t, xs in titles.items() for x in xs], "t string, x string")
    said = matching.matches(F.col("t"), F.col("x"), F.lit(None).cast("string"), F.array().cast("array<string>"), rules)
    got = matching.refusals(pairs.withColumn("m", said), "t", "x", "m", rules)
    assert rows(got) == [
        ("50A9QX", "no_such_series", "", 50), ("55Q7QX", "check_rules", "55", 55), ("65U7SG", "other_sizes", "55/75", 65), ("65U8N", "core_too_short", "65", 65),
    ]


def plain_runs(marks):
    out, run = [], 0
    for bad in marks:
        run = run + 1 if bad else 0
        out.append(run)
    return out


def test_runs_cross_the_ranges_of_the_order(spark):
    rng = random.Random(5)
    marks = {k: [rng.random() < share for _ in range(60)] for k, share in (("a", 0.5), ("b", 0.9), ("c", 1.0), ("d", 0.0), (None, 0.8))}
    df = spark.createDataFrame([(k, i, bad) for k, m in marks.items() for i, bad in enumerate(m)], "k string, i int, bad boolean")
    want = {(k, i): r for k, m in marks.items() for i, r in enumerate(plain_runs(m))}
    got = runs.failure_runs(df, "k", ["i"], F.col("bad"), per_range=17)
    assert {(r["k"], r["i"]): r["run"] for r in got.collect()} == want and got.count() == 300
    ends = {k: next((i for i, r in enumerate(plain_runs(m)) if r == 5), None) for k, m in marks.items()}
    tripped = runs.trips(df, "k", ["i"], F.col("bad"), 5, per_range=17)
    assert {r["k"]: r["i"] for r in tripped.collect()} == {k: i for k, i in ends.items() if i is not None}
    kept = runs.survivors(df, "k", ["i"], F.col("bad"), 5, per_range=17)
    assert {(r["k"], r["i"]) for r in kept.collect()} == {(k, i) for k, m in marks.items() for i in range(60) if ends[k] is None or i <= ends[k]}


def test_reading_stops_across_ranges_without_a_scope(spark):
    rng = random.Random(6)
    pages = [[rng.randrange(12 + p // 3) for _ in range(2)] for p in range(40)]
    known, still, want = set(), 0, []
    for p, keys in enumerate(pages):
        fresh = set(keys) - known
        want.append((p, len(fresh), still < 3))
        known |= fresh
        still = still if still >= 3 else 0 if fresh else still + 1
    df = spark.createDataFrame([(p, k) for p, keys in enumerate(pages) for k in keys], "page long, k int")
    assert rows(runs.stop_after(df, [], "page", ["k"], 3, per_range=9).select("page", "new_keys", "read")) == want
    assert not all(read for _, _, read in want)


def test_each_breaker_has_its_own_counter(spark):
    b, f, n, o = "blocked", "failed", "no_price", "ok"
    visits = {
        ("s", "search"): [b, b, o, b, b, b, o], ("s", "product"): [b, f, b, f, n, b, b, f, b, f], ("t", "product"): [n] * 6 + [b, f] + [n] * 5,
        ("u", "product"): [n] * 9 + [o] + [n] * 9, ("t", "review"): [b, b, None, b, b], ("brand", "series"): [f] * 4 + [o] + [f] * 6,
    }
    df = spark.createDataFrame([(k, s, i, x) for (k, s), xs in visits.items() for i, x in enumerate(xs)], "k string, stage string, i int, status string")
    got = runs.circuit_errors(df, "k", "stage", "status", ["i"]).select("k", "stage", "i", "kind", "counter", "run")
    assert rows(got) == [
        ("brand", "series", 9, "circuit_break", "series", 5), ("s", "product", 9, "circuit_break", "product", 5),
        ("s", "search", 5, "circuit_break", "search", 3), ("t", "product", 11, "no_price_circuit", "no_price", 10),
    ]
    assert runs.circuit_errors(df.limit(0), "k", "stage", "status", ["i"]).count() == 0


def test_a_run_continues_from_its_state(spark, tmp_path):
    path, kind = str(tmp_path / "state"), "site string, status string, at long"
    work = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "site string")
    state = run_state.read_state(spark, path, kind)
    assert run_state.left_to_do(work, state, "site", "status").count() == 4
    first = run_state.advance(state, spark.createDataFrame([("a", "ok", 1), ("b", "blocked", 1), ("b", None, None)], kind), "site", "at")
    assert run_state.write_state(first, path) == 1
    state = run_state.read_state(spark, path, kind)
    assert rows(state) == [("a", "ok", 1), ("b", "blocked", 1)]
    assert {r["site"] for r in run_state.left_to_do(work, state, "site", "status").collect()} == {"b", "c", None}
    assert run_state.write_state(run_state.advance(state, spark.createDataFrame([("b", "no_item", 2)], kind), "site", "at"), path) == 2
    (tmp_path / "state" / "version-00000003").mkdir()  # a run that died while writing
    state = run_state.read_state(spark, path, kind)
    assert rows(state) == [("a", "ok", 1), ("b", "no_item", 2)]
    assert run_state.write_state(state, path) == 3


def test_a_sandbox_leaves_the_table_alone(spark, tmp_path):
    path, df = str(tmp_path / "live"), spark.createDataFrame([(1, "x")], "k int, v string")
    sinks.insert_new(df, path, ["k"], ["v"])
    spark.conf.set("tidemark.sandbox", str(tmp_path / "sandbox"))
    try:
        sinks.insert_new(spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string"), path, ["k"], ["v"])
        assert rows(spark.read.parquet(sinks.target(spark, path))) == [(1, "y"), (2, "z")]
    finally:
        spark.conf.unset("tidemark.sandbox")
    assert rows(spark.read.parquet(path)) == [(1, "x")]


def test_as_of_takes_the_last_at_or_before(spark):
    prices = spark.createDataFrame([("a", 1, 10), ("a", 5, 20)], "k string, t int, v int")
    at = spark.createDataFrame([("a", 0), ("a", 4), ("a", 5), ("b", 9)], "k string, t int")
    assert {(r["k"], r["t"]): r["v"] for r in snapshots.as_of(prices, at, "k", "t", "v").collect()} == {("a", 0): None, ("a", 4): 10, ("a", 5): 20, ("b", 9): None}


def test_star_counts_sum_to_the_total(spark):
    cases = spark.createDataFrame([(t, p) for t in (1, 3, 19, 250) for p in ([20] * 5, [0, 0, 0, 0, 100], [1, 2, 3, 4, 90], [33, 33, 34, 0, 0])], "t long, p array<int>")
    got = cases.select("t", reviews.star_counts(F.col("t"), F.col("p")).alias("s")).collect()
    assert all(sum(r["s"]) == r["t"] for r in got)


def test_keys_and_averages(spark):
    one = spark.createDataFrame([("7", "2026-01-01", "x", 0), (None, "2026-01-01", "x", None)], "id string, d string, a string, total int")
    got = one.select(reviews.review_key("yotpo", F.col("id"), F.col("d"), F.col("a")), reviews.has_reviews(F.col("total"))).collect()
    assert [tuple(r) for r in got] == [("yotpo:7", False), ("2026-01-01|x", False)]


def test_blocked_candidates_hold_the_matches(spark):
    models = spark.createDataFrame([("65U7SG",), ("A65NV",)], "model string")
    catalog = spark.createDataFrame([(1, 'Hisense 65" Class - U7SG Series'), (2, "Hisense 50A65NV"), (3, "Soundbar")], "id int, title string")
    got = {(r["model"], r["id"]) for r in matching.block_candidates(models, catalog, "model", "title").collect()}
    assert ("65U7SG", 1) in got and all(i != 3 for _, i in got)


def test_outcome_tells_failed_from_missing(spark):
    df = spark.createDataFrame([(0, False), (5, False), (5, True)], "n int, b boolean")
    assert [r[0] for r in df.select(matching.outcome(F.col("n"), F.col("b"))).collect()] == ["failed", "no_item", "failed"]


def test_passages(spark):
    docs = spark.createDataFrame([(1, "x the quick brown fox jumps over the lazy dog, twice."), (2, "the quick brown fox"), (3, None)], "doc_id long, text string")
    passages = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog, twice"), (2, "brown fox"), (3, "not there at all, nowhere to be seen in it")], "item_id long, text string")
    assert rows(matching.passages_in(passages, docs)) == [(1, 1), (2, 1), (2, 2)]


def test_reconcile_counts_repeats(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "x int"), spark.createDataFrame([(1,), (2,)], "x int")
    assert rows(quality.reconcile(a, b)) == [("parts", 1), ("whole", 1)]


def test_html_text_and_triples():
    page = extraction.parsed("<h2>Screen</h2><table><tr><th>Size<td>55 in</tr><tr><td>Panel</td><td>VA</td></table><script>no()</script><p>Hi &amp; bye")
    assert list(page.triples()) == [("Screen", "Size", "55 in"), ("Screen", "Panel", "VA")]
    assert page.words[-1] == "Hi & bye" and "no()" not in " ".join(page.words)


def test_schema_problems_and_extraction(spark):
    bad = ShopSchema("Bad Code", "https://x.example/", discover="guess", on_no_match="first", min_core_len=3, fields=(Field("price"), Field("price", regex=("(",))))
    assert len(bad.problems()) == 8
    good = ShopSchema("shop", "https://x.example/?q={q}", "EUR", fields=(Field("price", (r'data-price="([^"]+)"',), ("offers.price",), "money"), Field("name", (), ("name",))))
    html = ['<b data-price="433,74 €"></b>', '<script type="application/ld+json">{"name":"TV","offers":{"price":"12,50"}}</script>', "nothing"]
    got = good.extract(spark.createDataFrame([(i, h) for i, h in enumerate(html)], "id int, html string")).orderBy("id").collect()
    assert [(str(r["price"]) if r["price"] is not None else None, r["name"]) for r in got] == [("433.74", None), ("12.50", "TV"), (None, None)]


def test_report_names_every_source(spark):
    report = Report("Prices", "2026-W40")
    report.paragraph("Eleven shops.", "shop")
    report.table("Lowest", spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int"), ["k"], "price", "x_us")
    text = report.markdown()
    assert report.audit() == [] and "[source: S2, 2026-W40]" in text and "- S2: price, x_us, 2026-W40" in text and text.index("| a | 1 |") < text.index("| b | 2 |")
    report.parts.append("No source.")
    assert len(report.audit()) == 1


def test_readers_and_writers(spark, tmp_path):
    lines = tmp_path / "cases.jsonl"
    lines.write_text('{"_schema": 1}\n\n{"code": "a", "verdict": "x"}\n{broken\n{"code": "b"}\n')
    got = {r["text"]: (r["doc"] is None, r["missing"]) for r in sources.json_lines(spark, str(lines), ("code", "verdict")).selectExpr("text", "cast(doc as string) doc", "missing").collect()}
    assert got['{"code": "b"}'] == (False, ["verdict"]) and got["{broken"][0] and len(got) == 3
    (tmp_path / "m.csv").write_bytes("code,model\n海信,55U8N\n".encode("gb18030"))
    assert rows(sources.csv(spark, str(tmp_path / "m.csv"), "code string, model string", "GB18030")) == [("海信", "55U8N")]
    df = spark.createDataFrame([("w1", 1, 5.0), ("w1", 2, None)], "captured_week string, k int, price double")
    sinks.append_snapshot(df, str(tmp_path / "snap"))
    sinks.replace_partitions(spark.createDataFrame([("w2", 9, 1.0)], df.schema), str(tmp_path / "snap"), "captured_week")
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 3
    sinks.backup_then_delete(df, F.col("price") > 1, str(tmp_path / "gone"), str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "gone")).count() == 1 and spark.read.parquet(str(tmp_path / "kept")).count() == 1
    sheet = sinks.grouped_sheet(spark.createDataFrame([("h", "55U8N", "s1", 5), ("h", "55U8N", "s1", 4)], "b string, m string, s string, p int"), "b", "m", "s", "p", ["s1", "s2"])
    assert {(r["model"], r["is_header"], r["s1"]) for r in sheet.collect()} == {(None, True, None), ("55U8N", False, 4)}
    assert spark.read.csv(sinks.export_csv(df, str(tmp_path), "us", "20261001"), header=True).count() == 2


def test_weeks(spark):
    from tidemark.functions.dates import iso_week

    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2021, 1, 3),)], "d date")
    assert [r[0] for r in df.select(iso_week(F.col("d"))).collect()] == ["2025-W01", "2020-W53"]


def test_rows_are_numbered_in_order(spark):
    import random

    from tidemark.operators.ranking import number_rows

    rng = random.Random(1)
    values = [(i, rng.choice([None, 1, 1, 1, 5, 9, rng.randrange(1000)])) for i in range(500)]
    got = number_rows(spark.createDataFrame(values, "id int, v int"), F.col("v"), [F.col("v").asc_nulls_first(), "id"], buckets=7).collect()
    want = sorted(values, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["n"])] == [i for i, _ in want] and sorted(r["n"] for r in got) == list(range(1, 501))
    assert number_rows(spark.createDataFrame([], "id int, v int"), F.col("v"), ["v", "id"]).count() == 0


def test_money_is_one_amount_or_null(spark):
    from tidemark.functions.money import money

    cases = {
        ("12,345円(税込13,580円)", "JPY"): "12345", ("$359.990 $399.990", "CLP"): None, ("65 pulgadas $359.990", "CLP"): "359990", ("Save 20 $499", "USD"): "499", ("-5.00", "USD"): "-5",
        ("from 3 to 4", "USD"): None, ("$5 or $5.00", "USD"): "5", ("", "USD"): None, (None, "USD"): None, ("1.234.567,89 €", "EUR"): "1234567.89", ("$12.50", "CLP"): None,
        ("₹1,29,999", "INR"): "129999", ("₹12,34,567.50", "INR"): "1234567.5", ("$1.299", "USD"): None, ("1299.999", "USD"): None, ("−5.00 €", "EUR"): "-5", ("(5.00)", "USD"): None, ("1,2,999", "USD"): None,
        ("5,000円OFF 49,800円", "JPY"): "49800", ("Save $100", "USD"): None, ("$499/mo for 24 months", "USD"): None, ("Save $100 now $499.99", "USD"): "499.99", ("20% off $5", "USD"): "5", ("$10 off", "USD"): None,
    }
    table = spark.createDataFrame([(a, b) for a, b in cases], "raw string, currency string")
    for r in table.select("raw", "currency", money(table.raw, table.currency).alias("x")).collect():
        want = cases[r["raw"], r["currency"]]
        assert (r["x"] is None) == (want is None) and (want is None or float(r["x"]) == float(want)), r


def test_passages_of_every_form_are_found(spark):
    from tidemark.operators.matching import passages_in

    passages = ["hello", "a", ".", "hello!", "lo wo", " x", "x y z", "abcdefghijkl", "é", "two words here and more to fill", "\n", "hello, world. this is long enough for the first width"]
    texts = ["say hello ab cd now", "xhelloy!", "a.b", "hello! lo wo x y z", "0abcdefghijklm", "two words here and more to fill it", "", None, "é\n", "oh hello, world. this is long enough for the first width x"]
    items = spark.createDataFrame(list(enumerate([*passages, "", None])), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {(r["item_id"], r["doc_id"]) for r in passages_in(items, docs).collect()}
    assert got == {(i, j) for i, p in enumerate(passages) for j, t in enumerate(texts) if t and p in t}


def test_marked_sections_do_no_harm():
    from tidemark.operators.extraction import parsed

    assert parsed("a <![foo[ x ]]> b").words[-1].endswith("b")
    assert parsed("<![CDATA[ open").words is not None and parsed(None).words == []
    page = parsed("<h2>Screen</h2><table><![if x]><tr><th>Size</th><td>65</td></tr></table>")
    assert list(page.triples()) == [("Screen", "Size", "65")]

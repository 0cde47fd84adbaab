"""Stored pages and files: sitemaps, HTML in any state, payloads and specifications."""

import gzip
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import extraction, html, payloads
from tidemark.sources import sitemaps


# Sitemaps


def urlset(urls):
    return ("<?xml version='1.0'?><urlset>" + "".join(f"<url>\n<loc> {u} </loc></url>" for u in urls) + "</urlset>\n").encode()


def read(content):
    try:
        return list(sitemaps.entries(content))
    except sitemaps.Broken as why:
        return str(why)


def test_entries_of_whole_and_broken_shards():
    urls = [f"https://x.example/p/{i}" for i in range(30_000)]
    plain = urlset(urls)
    packed = gzip.compress(plain)
    assert read(plain) == read(packed) == read(gzip.compress(plain[:1000]) + gzip.compress(plain[1000:])) == urls
    assert read(packed[:-20]) == read(packed[: len(packed) // 2]) == "shortened" and read(plain[:-12]) == "shortened" and read(b"") == "shortened"
    spoiled = bytearray(packed)
    spoiled[len(packed) // 2] ^= 0xFF
    assert read(bytes(spoiled)) in ("damaged", "shortened")
    assert read(b"<urlset><url><loc>https://x.example/?a=1&amp;b=2</loc></url><url><loc><![CDATA[https://x.example/?c&d]]></loc></url></urlset>") == ["https://x.example/?a=1&b=2", "https://x.example/?c&d"]
    assert read(b"<s:urlset><s:url><s:loc>u</s:loc></s:url></s:urlset>") == ["u"] and read(b"<urlset></urlset>") == []
    assert read(gzip.compress(b"<urlset><loc>" + b"x" * 3_000_000 + b"</urlset>")) == []


def test_a_run_reads_what_is_left(spark, tmp_path):
    shards = tmp_path / "shards"
    shards.mkdir()
    names = [f"part{i}.xml.gz" for i in range(5)]
    (tmp_path / "index.xml").write_text("<sitemapindex>" + "".join(f"<sitemap><loc>https://x.example/s/{n}?v=1</loc></sitemap>" for n in names) + "</sitemapindex>")
    for i, n in enumerate(names[:4]):
        whole = gzip.compress(urlset([f"u{i}/{k}" for k in range(i * 10)]))
        (shards / n).write_bytes(whole[:-15] if i == 2 else whole)
    where = [str(tmp_path / x) for x in ("index.xml", "shards", "catalog")]
    run = lambda: sorted(tuple(r) for r in sitemaps.read_left(spark, *where).collect())
    assert [(r[0], r[2]) for r in run()] == [(names[0], None), (names[1], None), (names[2], "shortened"), (names[3], None), (names[4], "absent")]
    assert {r["shard"] for r in sitemaps.urls(spark, where[2]).collect()} == {names[1], names[3]}
    (shards / names[2]).write_bytes(gzip.compress(urlset(["again"])))
    assert run() == [(names[2], 1, None), (names[4], 0, "absent")]
    assert run() == [(names[4], 0, "absent")]
    assert sorted(r["url"] for r in sitemaps.urls(spark, where[2]).collect()) == sorted([f"u1/{k}" for k in range(10)] + [f"u3/{k}" for k in range(30)] + ["again"])


# HTML


def test_tokens_cover_the_page():
    rng = random.Random(3)
    bits = ["<p>", "</p>", "<a href='x>y'>", "<b", "text ", "&amp;", "<br/>", "<!-- c -->", "<!", "</", "<", ">", '"', "'", "=", "<script>", "</script>", "<td class=a>", "é", "\n"]
    for _ in range(500):
        page = "".join(rng.choices(bits, k=rng.randrange(30)))
        at = 0
        for kind, name, value, start, end in html.tokens(page):
            assert start >= at and end > start and (kind != "text" or page[start:end] == value)
            at = end
        list(html.elements(page)), html.words(page), list(html.triples(page)), html.repeated_cards(page)


@pytest.mark.parametrize("bit", ["<a ", '<a b="', "<a b='x>", "<!-- ", "<![", "<", "<div>", "</div>", "= ", "<script>", "<td>", "<a <b> </i>", "<p class=", "&", "<div><p></div>"])
def test_time_is_linear_in_the_page(bit):
    page = bit * (2_000_000 // len(bit))
    start = time.process_time()
    html.words(page), list(html.triples(page)), html.repeated_cards(page)
    assert time.process_time() - start < 20


def test_ten_megabytes_of_open_tags():
    start = time.process_time()
    assert list(html.triples("<a " * 3_500_000)) == [] and time.process_time() - start < 2


def test_words_and_triples_of_odd_markup():
    assert html.words("<p>A&nbsp;b</p><script>x</script><style>y</style> c < d <!-- e --> f<noscript>g</noscript>") == ["A b", "c < d", "f"]
    assert html.words("one <b") == ["one <b"] and html.words("a<!-- b") == ["a"] and html.words("a<script>b") == ["a"] and html.words(None) == []
    page = '<h2>A</h2><table><tr><th>x<td>1<tr><td>y</td><td><b>2</b> 3</td></tr><tr><td>alone</table><h3>B</h3><dl><dt>z<dd title="a > b">4<dt>w</dt><dd>5</dl>'
    assert list(html.triples(page)) == [("A", "x", "1"), ("A", "y", "2 3"), ("B", "z", "4"), ("B", "w", "5")]


def test_repeated_cards_go_from_the_top():
    card = lambda name, extra="": f'<div class="b  a"{extra}><h3>{name}</h3><p><i>in</i> <i>stock</i></p></div>'
    page = f"<ul>{card('x')}{card('y')}{card('x', ' id=7')}</ul><ol>{card('z')}<br>{card('x')}</ol><p>in</p><p>in</p>"
    kept, removed, before, after = next(html.without_repeats(page))
    assert removed == 4 and before == len(page) and after == len(kept)
    assert kept == f"<ul>{card('x')}{card('y').replace('<p><i>in</i> <i>stock</i></p>', '')}</ul><ol>{card('z').replace('<p><i>in</i> <i>stock</i></p>', '')}<br></ol><p>in</p><p>in</p>"
    assert next(html.without_repeats("")) == ("", 0, 0, 0)


def test_a_page_of_one_card_many_times_keeps_one():
    card = '<div class="card"><h3>TV</h3><p>Price <b>1</b></p></div>'
    kept = next(html.without_repeats("<main>" + card * 2000 + "</main><footer>end</footer>"))[0]
    assert kept == f"<main>{card}</main><footer>end</footer>"


# Payloads


def test_payloads_of_each_kind_and_broken_ones(spark):
    pages = [
        (0, '<script type="application/ld+json">[{"name":"a"},{"name":"b"}]</script><SCRIPT TYPE=application/ld+json>{bad</SCRIPT>'),
        (1, '<script id="__NEXT_DATA__" type="application/json">{"name":"c"}</script><i data-info=\'{"name":"d&amp;e"}\'></i><i data-info="{&quot;name&quot;:&quot;f&quot;}">'),
        (2, 'x<script>self.__next_f.push([1,"{\\"na"])</script><script>self.__next_f.push([1,"me\\":\\"g\\"}"])</script>'),
        (3, '<script type="application/ld+json">{"@graph":[{"name":"h"}]}</script><script type="application/ld+json">{"itemListElement":[{"item":{"name":"i"}},{"name":"j"}]}</script>'),
        (4, "<p>nothing</p>"), (5, None), (6, '<script type="application/ld+json">[]</script>'),
    ]
    table = spark.createDataFrame(pages, "id long, html string")
    found = payloads.things(payloads.payloads(table, "html", ["id"])).select("id", "kind", "at", "n", payloads.text_at(F.col("thing"), "$.name"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted([
        (0, "ld", 0, 0, "a"), (0, "ld", 0, 1, "b"), (0, "ld", 1, None, None), (1, "page", 0, 0, "c"), (1, "data-info", 0, 0, "f"), (1, "data-info", 1, 0, "d&e"),
        (2, "stream", 0, 0, "g"), (3, "ld", 0, 0, "h"), (3, "ld", 1, 0, "i"), (3, "ld", 1, 1, "j"), (6, "ld", 0, None, None),
    ], key=str)


def test_specifications_keep_empty_chapters_and_items(spark):
    paths = payloads.SpecPaths("spec", "chapters", "name", "items", "label", "values", "text", " | ")
    docs = [(0, '{"spec":{"chapters":[{"name":"Display","items":[{"label":"Size","values":[{"text":"55"},{"text":"65"}]},{"label":"Panel"}]},{"name":"Audio","items":[]}]}}'), (1, '{"spec":{}}'), (2, "no json"), (3, None)]
    table = spark.createDataFrame(docs, "id long, text string").withColumn("doc", F.try_parse_json("text"))
    got = sorted((tuple(r) for r in payloads.spec_rows(table, "doc", ["id"], paths).collect()), key=str)
    assert got == [(0, 0, "Display", 0, "Size", "55 | 65"), (0, 0, "Display", 1, "Panel", None), (0, 1, "Audio", 0, None, None)]


def test_prices_of_linked_data(spark):
    cases = [
        ('{"@type":"Product","offers":{"price":"399.00"}}', "399.00", "399.00"), ('{"@type":"Product","offers":{"@type":"AggregateOffer","lowPrice":"1"}}', None, None),
        ('{"@type":"ProductGroup","hasVariant":[{"size":"55","offers":{"price":"499.00"}},{"size":"65","offers":{"price":"699.00"}}]}', "499.00", "699.00"),
        ('{"@type":"Product","url":"https://x.example/search?q=tv","offers":{"price":"5.00"}}', None, None), ('{"category":"TV","name":"TV","aggregateRating":{"ratingCount":"1001"},"offers":{"price":"7"}}', None, None),
    ]
    table = spark.createDataFrame(cases, "doc string, a string, b string")
    got = table.select("a", extraction.ld_price(F.col("doc")).cast("string"), "b", extraction.ld_price(F.col("doc"), F.lit("65")).cast("string")).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


# Lines, sheets and models


def test_lines_are_numbered_over_pieces_and_files(spark, tmp_path):
    from tidemark.sources import tables

    rng = random.Random(9)
    want = []
    for name in ("a.jsonl", "b.jsonl", "c.jsonl"):
        lines = [rng.choice(["", "{bad", '{"_schema":1}', '{"code":1}', '{"code":2,"pad":"' + "x" * rng.randrange(300) + '"}']) for _ in range(rng.choice([0, 1, 700]))]
        (tmp_path / name).write_text("".join(x + "\n" for x in lines))
        want += [(name, n, x) for n, x in enumerate(lines, 1)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        numbered = tables.numbered_lines(spark, str(tmp_path)).collect()
        assert len({r["file"] for r in numbered}) <= 3
        assert sorted((r["file"].rsplit("/", 1)[1], r["line"], r["text"]) for r in numbered) == sorted(want)
        docs = tables.json_lines(spark, str(tmp_path), ("code",)).selectExpr("file", "line", "doc is null bad").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"], r["bad"]) for r in docs) == sorted((f, n, x == "{bad") for f, n, x in want if x and "_schema" not in x)


def sheet(path):
    import re
    import zipfile
    from html import unescape

    with zipfile.ZipFile(path) as book:
        assert book.testzip() is None
        body = book.read("xl/worksheets/sheet1.xml").decode()
    return [[unescape(c) for c in re.findall(r"<c [^>]*>(?:<is><t[^>]*>|<v>)(.*?)(?:</t></is>|</v>)</c>", row, re.S)] for row in re.findall(r"<row [^>]*>(.*?)</row>", body, re.S)]


def test_sheets_by_country_and_day(spark, tmp_path):
    from tidemark.sinks.xlsx import export_xlsx

    rows = [("mx", "2026-09-28", i, f"TV <{i}> & é", float(i)) for i in range(5)] + [("cl", "2026-09-28", 1, None, 2.5), (None, "2026-09-29", 2, "x\x01", None)]
    df = spark.createDataFrame(rows, "country string, day string, n int, name string, price double")
    export_xlsx(df, str(tmp_path / "out"), ["country", "day"], ["n"], rows=4)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".xlsx") == ["prices_cl_2026-09-28.xlsx", "prices_mx_2026-09-28.xlsx", "prices_mx_2026-09-28_2.xlsx", "prices_none_2026-09-29.xlsx"]
    assert sheet(tmp_path / "out" / "prices_mx_2026-09-28.xlsx") == [["n", "name", "price"]] + [[str(i), f"TV <{i}> & é", str(float(i))] for i in range(3)]
    assert sheet(tmp_path / "out" / "prices_mx_2026-09-28_2.xlsx")[1:] == [["3", "TV <3> & é", "3.0"], ["4", "TV <4> & é", "4.0"]]
    assert sheet(tmp_path / "out" / "prices_cl_2026-09-28.xlsx")[1:] == [["1", "2.5"]] and sheet(tmp_path / "out" / "prices_none_2026-09-29.xlsx")[1:] == [["2", "x"]]


def test_an_aborted_export_leaves_nothing(spark, tmp_path):
    from tidemark.sinks.xlsx import export_xlsx

    df = spark.range(20).select((F.col("id") % 4).cast("string").alias("country"), F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("n"))
    with pytest.raises(Exception):
        export_xlsx(df, str(tmp_path / "out"), ["country"], ["n"])
    assert not (tmp_path / "out").exists() or not [p for p in (tmp_path / "out").iterdir() if "xlsx" in p.name]


def test_words_of_models_in_titles(spark, tmp_path):
    import re

    from tidemark.operators.matching import word_candidates, word_matches

    rng = random.Random(12)
    models = ["75U6SV", "A65NV", "A4K", "U8Q", "55QD8SF-PRO", "QD8SF", "U7 N", "65", "PRO", "", None, "--", "x.y", "4K TV"]
    bits = ["75u6sv", "50A65NV", "a 4K", "100U8QG", "U8Q", "x50a65nv", "55QD8SF-PRO", "QD8SF PRO", "U7 N", "u7-n", "pro", "4k tv", "65", "1965", "x.y", "xzy", "TV", "é65"]
    titles = [(i, rng.choice([" ", "", "-", "/"]).join(rng.choices(bits, k=rng.randrange(1, 5)))) for i in range(400)] + [(900, None), (901, "")]
    m, t = spark.createDataFrame([(x,) for x in models], "model string"), spark.createDataFrame(titles, "id int, title string")
    got = {(r["key"], r["model"]) for r in word_matches(m, t, "model", "title", "id", str(tmp_path / "a")).collect()}
    rule = lambda x, title: re.search(r"(?:^|[^a-z0-9]|[0-9]{2,3})" + re.escape(x.lower()) + r"(?=[^a-z0-9]|$)", title.lower())
    assert got == {(i, x) for i, title in titles if title for x in models if x and re.search("[A-Za-z0-9]", x) and rule(x, title)}
    many = spark.createDataFrame([(f"{20 + i % 60}U{i}N",) for i in range(2000)], "model string")
    for n in (200, 2000):
        made = spark.range(n).select("id", F.concat(F.lit("Smart TV "), (F.col("id") % 60 + 20).cast("string"), F.lit("U"), F.col("id").cast("string"), F.lit("N 4K")).alias("title"))
        found = word_candidates(many, made, "model", "title", "id", str(tmp_path / f"b{n}"))
        assert found.count() <= 2 * n  # pairs do not grow faster than titles

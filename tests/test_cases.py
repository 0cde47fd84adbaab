"""The matcher's rules on single pairs, and further rules on single texts."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import extraction, matching

MATCHES = (
    ("75U6SV", 'Maker 75U6SV 75" QLED', "", [], 4),
    ("55QD8SF-PRO", "Maker QD8SF Series TV", "", [], 4),
    ("A65NV", "Maker 50A65NV Smart TV", "", [], 4),
    ("A4K", '43" Accesorios a 4K', "", [], 4),
    ("U8Q", "Maker 100U8QG", "", [], 4),
    ("65U7SG", 'Maker 75" Class - U7SG Series', "", [], 4),
    ("65U7SG", 'Maker 65" Class - U7SG Series', "", [], 4),
    ("55U7SG", "Maker TV", "", ["55U78SG", "55U7SG"], 4),
    ("65U7SG", "Maker 65U7SG", "", ["55U78SG", "55U7SG"], 4),
    ("32QD4SV", "Televisor QLED", "https://shop.example.com/tv-32-32qd4sv-0436032p.html", [], 4),
    ("U8N", "Maker 65U8N5 Class", "", [], 4),
    ("U8Q", "Maker 100U8QG", "", [], 3),
    ("65U7SG", "Remote control for 65U7SG", "", [], 4),
)
#: The rule that decides each pair, and whether it matches.
DECIDED = (
    ("exact", True), ("core", True), ("exact", True), ("core_too_short", False), ("core_too_short", False), ("wrong_size", False), ("core", True), ("own_model", True),
    ("own_model_differs", False), ("exact", True), ("core_too_short", False), ("core", True), ("reject_word", False),
)


def test_each_pair_is_decided_by_its_rule(spark):
    table = spark.createDataFrame([(i, *c) for i, c in enumerate(MATCHES)], "id int, target string, title string, url string, models array<string>, least int")
    by = lambda n: matching.matches(F.col("target"), F.col("title"), F.col("url"), F.col("models"), matching.MatchRules(("remote",), True, n))
    got = table.select("id", F.when(F.col("least") == 3, by(3)).otherwise(by(4)).alias("m")).select("id", "m.rule", "m.ok").collect()
    assert {r["id"]: (r["rule"], r["ok"]) for r in got} == dict(enumerate(DECIDED))


def test_candidates_by_core_hold_whole_words(spark):
    models = spark.createDataFrame([(m,) for m, *_ in MATCHES], "model string").distinct()
    titles = spark.createDataFrame([(i, t) for i, (_, t, *_) in enumerate(MATCHES)], "id int, title string")
    found = {(r["id"], r["model"]) for r in matching.block_candidates(models, titles, "model", "title").select("id", "model").collect()}
    assert {(1, "55QD8SF-PRO"), (6, "65U7SG"), (0, "75U6SV")} <= found


@pytest.mark.parametrize("title, strict, lenient", [("TV 65 pulgadas 65U8N", True, True), ("Soporte TV 65 pulgadas", False, False), ("QLED 55QD7N Smart", False, True), ("Reloj 12 pulgadas", False, False), ('Remote for 65" TV', False, False)])
def test_titles_of_televisions(spark, title, strict, lenient):
    row = spark.range(1).select(extraction.tv_title(F.lit(title)), extraction.tv_model_title(F.lit(title))).first()
    assert tuple(row) == (strict, lenient)

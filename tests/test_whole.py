"""Queries that take whole tables, against brute force on small ones."""

import __spark_entry__ as entry


def test_slug_match_takes_every_name_as_a_model(spark, tmp_path):
    names = [f"red n{i % 40}" for i in range(60)] + ["Late 4k Bolt", "late bolt", "tv", "one two three four five", "", None]
    part = [(i + 1, name) for i, name in enumerate(names)]
    spark.createDataFrame(part, "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = {tuple(r) for r in entry.queries()["slug_match_all"](spark, str(tmp_path)).select("model", "hits", "first_product").collect()}
    want = {(f"REDN{i}", 2 if i < 20 else 1, i + 1) for i in range(40)} | {("LATEBOLT", 2, 61)}
    assert got == want


def test_fan_out_takes_every_model(spark, tmp_path):
    tables = {
        "part": ("p_partkey long, p_brand string", [(i, "late" if i > 20 else "early") for i in range(1, 51)] + [(51, None)]),
        "supplier": ("s_suppkey long, s_nationkey long", [(i, i % 3) for i in range(7)] + [(7, None)]),
        "nation": ("n_nationkey long, n_regionkey long", [(0, 0), (1, 0), (2, 1)]),
        "region": ("r_regionkey long, r_name string", [(0, "A"), (1, "B"), (2, "none")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {tuple(r) for r in entry.queries()["model_fan_out_all"](spark, str(tmp_path)).select("brand", "region", "tasks").collect()}
    assert got == {("early", "A", 100), ("early", "B", 40), ("late", "A", 150), ("late", "B", 60), (None, "A", 5), (None, "B", 2)}

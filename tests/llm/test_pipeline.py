"""The pipeline's stages and queries on the smallest tables."""

import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stash(stage(spark, docs, SF))
        assert docs.columns == columns and 0 < docs.count(), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").distinct().collect()}


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_on_nulls_repeated_ids_and_clashing_columns(spark, tmp_path):
    words = "the quick brown fox jumps over a lazy dog and then it sleeps in the warm sun for hours".split()
    rows = [(i, " ".join(words[i % 5 :] + [f"w{i}"] * 3), "en", "a") for i in range(12)] + [(3, "another text that shares an id with a third one", "en", "b")] * 2
    rows += [(None, None, None, None), (None, "a text without an id stays as well", None, None), (50, "", "en", "a"), (51, "1 2 3", "en", "a")]
    table = spark.createDataFrame([(*r, "own", 7) for r in rows], "doc_id long, text string, lang string, source string, keep_id string, size long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert ids <= {*range(12), None} and ids & set(range(12))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_hands_whole_texts_to_python_a_few_megabytes_at_a_time(spark, name, stage):
    for key in corpus_pipeline.BATCHES:
        spark.conf.unset(key)
    stage(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(40), SF)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    long = spark.range(0, 400, 1, 1).select("id", F.repeat(F.lit("word "), 20_000).alias("text"))  # 40 MB
    found = long.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 400
    assert max(r["size"] for r in found) < 5_000_000


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    wanted = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(wanted.columns)
    at = [wanted.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(str, r)) for r in got.collect()) == sorted(tuple(str(r[i]) for i in at) for r in wanted.fetchall())

"""Reading stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task gets of a table whose rows are short, but costly to work on.
PER_TASK = 10_000


def spread(df: DataFrame, by: str, per_task: int = PER_TASK) -> DataFrame:
    """df dealt by ``by``, which should be nearly unique, over tasks in proportion to its rows.

    Readers cut files by their bytes, so a small file goes to one or two tasks, whatever is then made of each row.
    """
    tasks = -(-df.count() // per_task)
    return df.repartition(tasks, by) if tasks > 1 else df


def by_region(parts: dict[str, DataFrame]) -> DataFrame:
    """One table out of regional ones; the region becomes a column."""
    marked = [df.withColumn("region", F.lit(region)) for region, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8", escape: str = "\\") -> DataFrame:
    """A CSV table with a header; for an encoding beyond Spark's own list, such as GB18030, Java's are allowed.

    Within quotes ``escape`` stands before a quote; most writers double the quote, which is an escape of ``"``.
    """
    if encoding.upper() not in ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return spark.read.csv(path, header=True, schema=schema, encoding=encoding, escape=escape, multiLine=False)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1) and text of every line of every file of a folder.

    Lines are counted by the piece of a file that a task reads, and pieces are numbered by what stands before them in
    their file: two narrow passes, the first without the texts, and no task holds a file. Both passes cut alike.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("turn"), F.col("value").alias("text"))
    pieces = lines.groupBy("file", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("from"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("file", "piece", "from", F.coalesce(before, F.lit(0)).alias("before"))
    return lines.join(pieces, ["file", "piece"]).select("file", (F.col("before") + F.col("turn") - F.col("from") + 1).alias("line"), "text")


def json_lines(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """file, line, text, doc and missing of each line that holds a document; doc is null where the line is no JSON.

    Blank lines and header documents (with ``_schema``) are left out; ``missing`` lists required keys that are absent.
    """
    parsed = numbered_lines(spark, path).filter(F.trim("text") != "").withColumn("doc", F.try_parse_json("text"))
    keys = F.coalesce(F.json_object_keys(F.when(F.col("doc").isNotNull(), F.col("text"))), F.array().cast("array<string>"))
    wanted = F.array(*map(F.lit, required)).cast("array<string>")
    return parsed.withColumn("keys", keys).filter(~F.array_contains("keys", "_schema")).withColumn("missing", F.array_except(wanted, "keys")).drop("keys")


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.json(path, multiLine=True, schema=schema)

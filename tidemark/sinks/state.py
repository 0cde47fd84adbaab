"""The state of a run, kept so that the next one continues where it ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.tables import target

#: States in which a piece of work is not taken up again.
DONE = ("ok", "no_item")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written to their end."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version-*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix("version-")) for f in found)


def write_state(state: DataFrame, path: str) -> int:
    """Writes the state as JSON under the next version and returns its number.

    A version counts once it is whole, so a run that dies while it writes leaves the one before in force. What such a
    run left is replaced. One writer at a time.
    """
    path = target(state.sparkSession, path)
    number = max(_versions(state.sparkSession, path), default=0) + 1
    state.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/version-{number:08d}")
    return number


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest whole version; no rows if there is none."""
    path = target(spark, path)
    numbers = _versions(spark, path)
    return spark.read.schema(schema).json(f"{path}/version-{numbers[-1]:08d}") if numbers else spark.createDataFrame([], schema)


def advance(state: DataFrame, results: DataFrame, key: str, time: str) -> DataFrame:
    """The state with the results of a run: of each key the row with the latest time; nulls of it come before all others."""
    both = state.unionByName(results.select(state.columns))
    newest = both.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*state.columns), F.struct(F.col(time).isNotNull(), F.col(time))).alias("_row"))
    return newest.select("_row.*")


def left_to_do(work: DataFrame, state: DataFrame, key: str, status: str, done: tuple[str, ...] = DONE) -> DataFrame:
    """Work whose key the state does not have as done; work without a key is never done."""
    return work.join(state.filter(F.col(status).isin(*done)).select(key).distinct(), key, "left_anti")

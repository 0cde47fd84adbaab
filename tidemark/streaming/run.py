"""Running a stream over what is there and reading the result as a table."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.tables import target


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A folder in spark.checkpoint.dir, a new one if it has no name; in local mode without that setting, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and spark.sparkContext.master.startswith("local-cluster") or not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return target(spark, f"{root or os.path.join(tempfile.gettempdir(), 'tidemark-checkpoints')}/stream-{name or uuid.uuid4().hex}")


def available_now(stream: DataFrame, mode: str = "append", name: str | None = None) -> DataFrame:
    """Reads all that the source holds now, with a checkpoint, writes Parquet and gives it back as a table.

    A run under the ``name`` of an earlier one resumes it: offsets and state are those it left, files it has read are
    not read again, and the table holds the rows of all runs. Without a name nothing is resumed.
    """
    spark = stream.sparkSession
    where = work_dir(spark, name)
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{where}/checkpoint").option("path", f"{where}/out")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table as a stream of files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)

"""What several of the operators need: loading, tables in the shared folder, text by code bytes."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode alone, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "tidemark-checkpoints"))
    return spark.sparkContext.getCheckpointDir()


class _Tables(threading.local):
    """Folders that stash() has written in this thread and that are still there."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_tables = _Tables()


def stash(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: it is computed once, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """A mark for clear(): the tables written from now on come after it."""
    return len(_tables.paths)


def clear(spark: SparkSession, since: int = 0, *keep: DataFrame) -> int:
    """Deletes the tables written after the mark, but for those that keep reads; returns how many."""
    read = [f for df in keep for f in df.inputFiles()]
    own, _tables.paths[since:] = _tables.paths[since:], []
    dropped = [p for p in own if not any(f"/{os.path.basename(p)}/" in f for f in read)]
    for p in dropped:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _tables.paths += [p for p in own if p not in set(dropped)]
    return len(dropped)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

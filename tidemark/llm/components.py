"""Connected components by alternating large-star and small-star steps (DataFrame functions only).

On request each task first turns its own edges into stars, at most one edge a node, which saves rounds. Every step
keeps, for each node, the smallest neighbour, which Spark combines before it shuffles; the neighbours of a hub meet
their hub in a join whose large partitions adaptive execution can split. No task holds the neighbours of a node, and
the driver sees two numbers a round. Each round is written to the shared folder, and the one before it is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import clear, stash, written


def contracted(edges: DataFrame) -> DataFrame:
    """Stars (a, b), a > b, that connect what the edges of each task connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        stars = [(x, r) for x in list(parent) if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in stars], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _starred(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a > b)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stash(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = stash(large.filter("a <> b"))
    lowest = stash(large.groupBy("a").agg(F.min("b").alias("m")))
    small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    return stash(small.select("e.a", "e.b").filter("a <> b").distinct())


def components(edges: DataFrame, contract: bool = False) -> DataFrame:
    """node and component, the smallest node it can reach, for every node of edges (a, b), two longs.

    Nulls and loops are left out; edges may repeat and run either way; no edges give no rows.
    """
    plain = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    mark, spark = written(), edges.sparkSession
    now, state = stash((contracted(plain) if contract else plain).distinct()), None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            break
        now, state = _starred(now), found
        clear(spark, mark, now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

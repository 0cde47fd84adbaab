"""Addresses out of stored sitemaps: an index lists shards, gzip or plain, and a run reads only the shards that are left.

Shards are read as binary files and inflated in bounded pieces, so a task holds one compressed shard and one piece. A
shard counts only when it is whole: a broken or shortened one gives a reason and no addresses, and is read again by the next run.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.tables import replace_partitions, target

#: Bytes of a piece, and the longest entry that may reach over pieces.
PIECE, LONGEST = 1 << 18, 1 << 16
ENTRY = re.compile(rb"<(?:[A-Za-z]+:)?loc>\s*(.*?)\s*</(?:[A-Za-z]+:)?loc>", re.S)
END = re.compile(rb"</(?:[A-Za-z]+:)?(urlset|sitemapindex)>\s*$")
ROWS = "shard string, at long, url string, reason string"
KINDS = (pa.string(), pa.int64(), pa.string(), pa.string())


class Broken(Exception):
    """Why a shard is not whole."""


def inflated(content: bytes) -> Iterator[bytes]:
    """The file in pieces of at most PIECE bytes; gzip members one after another are undone."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + PIECE] for i in range(0, len(content), PIECE))
        return
    rest = content
    while rest:
        member = zlib.decompressobj(31)
        while not member.eof:
            try:
                piece = member.decompress(rest, PIECE)
            except zlib.error as error:
                raise Broken("damaged") from error
            rest = member.unconsumed_tail
            if piece:
                yield piece
            elif not rest and not member.eof:
                raise Broken("shortened")
        rest = member.unused_data


def entries(content: bytes) -> Iterator[str]:
    """Addresses of one sitemap in order; Broken if it is not whole."""
    held = b""
    for piece in inflated(content):
        held += piece
        last = 0
        for found in ENTRY.finditer(held):
            last = found.end()
            raw = found[1]
            yield raw[9:-3].decode("utf-8", "replace") if raw.startswith(b"<![CDATA[") else unescape(raw.decode("utf-8", "replace"))
        held = held[last:]
        if len(held) > LONGEST:
            at = held.rfind(b"<", len(held) - LONGEST)
            held = held[at if at > 0 else len(held) - LONGEST :]
    if not END.search(held):
        raise Broken("shortened")


def shard_name(path: Column) -> Column:
    """The last part of an address or path, which names the shard; a folder written by Spark stands for one file."""
    clean = F.regexp_replace(F.regexp_replace(path, r"[?#].*$", ""), r"/(?:part-[^/]*)?$", "")
    return F.regexp_extract(clean, r"([^/=]*)$", 1)


def scan(files: DataFrame) -> DataFrame:
    """shard, at, url of each entry, and a last row for each file with at = number of entries and the reason it is not whole, else null.

    files: as the binaryFile source gives them. Entries of a broken file come out too; ``whole`` leaves them away.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, n, reason = [], 0, None
                try:
                    for url in entries(content.as_py()):
                        rows.append((shard, n, url, None))
                        n += 1
                        if len(rows) == 8192:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=["shard", "at", "url", "reason"])
                            rows = []
                except Broken as why:
                    reason = str(why)
                rows.append((shard, n, None, reason))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=["shard", "at", "url", "reason"])

    return files.select(shard_name(F.col("path")).alias("shard"), "content").mapInArrow(run, ROWS)


def stored(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)


def read_left(spark: SparkSession, index: str, shards: str, catalog: str) -> DataFrame:
    """Reads the shards that the index lists and that are not done, adds their addresses, and says what came of each.

    index: file of the sitemap index; shards: folder of the stored shards; catalog: folder of the tables ``urls`` (a
    partition a shard, so that a shard that is written twice is there once) and ``done``. Returns shard, urls and
    reason: null if it is done now, ``absent`` if it is not stored, else why it is not whole. What an index lists is
    bounded by the protocol (50,000 shards), so the names of what is left may reach the driver.
    """
    listed = scan(stored(spark, [index])).filter("url IS NOT NULL").select(shard_name(F.col("url")).alias("shard")).distinct()
    left = listed.join(done(spark, catalog), "shard", "left_anti")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(shards).select("path", shard_name(F.col("path")).alias("shard"))
    found = left.join(there, "shard", "left").collect()
    paths = [r["path"] for r in found if r["path"]]
    absent = spark.createDataFrame([(r["shard"], 0, "absent") for r in found if not r["path"]], "shard string, urls long, reason string")
    if not paths:
        return absent
    step = f"{target(spark, catalog)}/step-{uuid.uuid4().hex}"
    scan(stored(spark, paths)).write.parquet(step)
    rows = spark.read.schema(ROWS).parquet(step)
    result = rows.filter("url IS NULL").groupBy("shard").agg(F.sum("at").alias("urls"), F.max("reason").alias("reason"))
    good = result.filter("reason IS NULL").select("shard")
    replace_partitions(rows.filter("url IS NOT NULL").join(good, "shard", "left_semi").select("at", "url", "shard"), f"{catalog}/urls", "shard")
    good.write.mode("append").parquet(f"{target(spark, catalog)}/done")
    return result.unionByName(absent)


def done(spark: SparkSession, catalog: str) -> DataFrame:
    """Shards that are in the catalogue."""
    path = f"{target(spark, catalog)}/done"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "shard string")
    return spark.read.schema("shard string").parquet(path).distinct()


def urls(spark: SparkSession, catalog: str) -> DataFrame:
    """All addresses of the shards that are done: shard, at, url."""
    return spark.read.schema("at long, url string, shard string").parquet(f"{target(spark, catalog)}/urls")

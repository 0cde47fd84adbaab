"""Exact duplicates by a heavy-hitter split (DataFrame functions only).

Misra-Gries (``DataFrame.stat.freqItems``) names at most 1/support digests that may be frequent. Their true
counts are taken by an aggregation that combines before it shuffles; those that really reach the support are the
winners, at most 1/support rows, and are broadcast, so that no row of a frequent text is ever shuffled. What is
left takes the ordinary shuffle by digest: groups are counted by an aggregation and joined back, which adaptive
execution can split. No task holds the rows of a group.

Defined results: a null text counts as empty; of rows with equal text the largest doc_id stays, a null doc_id
only where the group has no other; of repeated rows with that doc_id one stays; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_lower, stash

#: Share of all rows from which a text counts as frequent; 1/SUPPORT bounds the broadcast rows.
SUPPORT = 0.001


def with_digest(docs: DataFrame, name: str) -> DataFrame:
    return docs.withColumn(name, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256))


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    seen = with_digest(docs.select("doc_id", "text"), "text_sha256")
    seen = stash(seen.select(F.col("doc_id").cast("long").alias("doc_id"), "text_sha256", F.monotonically_increasing_id().alias("turn")))
    least = max(2, int(support * seen.count()))
    named = seen.stat.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256"))
    best = F.max(F.struct("doc_id", "turn")).alias("best")  # nulls come before all others
    counted = lambda rows: rows.groupBy("text_sha256").agg(best, F.count(F.lit(1)).alias("group_size"))
    winners = stash(counted(seen.join(F.broadcast(named), "text_sha256", "left_semi")).filter(F.col("group_size") >= least))
    heavy = seen.join(F.broadcast(winners), "text_sha256")
    light = seen.join(F.broadcast(winners), "text_sha256", "left_anti")
    light = light.join(counted(light), "text_sha256")
    kept = (F.col("turn") == F.col("best.turn")).alias("kept")
    return light.unionByName(heavy).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", kept, "text_sha256")


def drop_exact(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """docs with one row of each text: all its columns, whatever their names.

    Rows go by their ids; texts are looked at again only where an id stands for rows that stay and rows that go.
    """
    groups = stash(exact_groups(docs, support).select(F.col("doc_id").alias("__td_id"), "kept", F.col("text_sha256").alias("__td_sha")))
    by_id = stash(groups.groupBy("__td_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("stay")).filter("stay < n"))
    own = docs.withColumn("__td_doc", F.col("doc_id").cast("long"))
    same = F.col("__td_doc").eqNullSafe(F.col("__td_id"))
    whole = own.join(by_id.select("__td_id"), same, "left_anti").select(docs.columns)
    mixed = by_id.filter("stay > 0").select("__td_id")
    if mixed.isEmpty():
        return whole
    stay = groups.filter("kept").select(F.col("__td_id").alias("__td_k"), "__td_sha")
    some = with_digest(own.join(mixed, same, "left_semi"), "__td_digest").dropDuplicates(["__td_doc", "__td_digest"])
    some = some.join(stay, F.col("__td_doc").eqNullSafe(F.col("__td_k")) & (F.col("__td_digest") == F.col("__td_sha")), "left_semi")
    return whole.unionByName(some.select(docs.columns))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
"""

"""Stupid-backoff scores of documents under the bigram counts of a corpus.

S(w | u) = c(u w) / c(u) where the corpus has the pair ``least`` times or more, else ALPHA * c(w) / N; a row's first
word has c(w) / N. A document's score is the sum of the natural logarithms over its words. A word that the corpus does
not have counts as seen once.

The scores are relational: count tables of n-grams, partitioned by hash, meet the documents' n-grams, a row for each
that is distinct in a document, in a join on the n-gram, and what each adds is summed per document. Numpy only makes
n-grams of Arrow batches.

``score`` takes any corpus and any ``least``: pairs meet the pair counts, and then the word whose count they need, the
first word's or, backing off, the second's, meets the word counts. ``score_own`` is for documents that are the corpus
themselves, with every pair counted. No pair backs off then, and the sum over a document is one over its n-grams: a
pair adds ln c for each time it occurs; a word takes ln c away for each time another follows and adds it where it is
first. So the count tables and the documents' n-grams are one relation, partitioned by hash of the n-gram in a single
exchange, and each row gets the count of its n-gram from a window over it. Words with N / 2**HOT_BITS or more occurrences (at most 2**HOT_BITS) and pairs of the VERY_HOT most frequent words
(at most VERY_HOT squared) are counted beforehand, broadcast, and added up where n-grams are made: no n-gram with a
share of over 1 / VERY_HOT of all words is ever shuffled.

Words are as in the other operators (A-Z lower-cased), known by 64 bits of a hash, as are pairs: two n-grams are taken
for one with a chance of 2**-64 for each pair of n-grams.

Defined results: null, empty and word-free texts have no words, a score of 0 and a null mean; rows that share a doc_id
(or have none) are one document, of which each row gets the whole score; an empty table gives no rows. A text is read
whole by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import clear, partitions, stash, written
from tidemark.llm.shingles import chunks, mix, word_hashes

ALPHA = 0.4
#: Broadcast words: those with N / 2**HOT_BITS occurrences or more; words all of whose pairs are broadcast.
HOT_BITS, VERY_HOT = 20, 256
#: Words of the corpus for each partition of n-grams.
WORDS_A_PARTITION = 4_000_000
#: Documents without an id are one document, of this number.
NO_ID = -(1 << 63)

#: With pairs that occur twice or more.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), e AS (
  SELECT doc_id, unnest(ws) AS w, unnest(list_concat([NULL], list_slice(ws, 1, len(ws) - 1))) AS u FROM t WHERE len(ws) > 0
), c1 AS (SELECT w, count(*) AS n FROM e GROUP BY w),
c2 AS (SELECT u, w, count(*) AS n FROM e WHERE u IS NOT NULL GROUP BY u, w),
s AS (
  SELECT e.doc_id, count(*) AS n_words,
    sum(CASE WHEN e.u IS NULL THEN ln(a.n) - ln(z.n) WHEN c2.n >= 2 THEN ln(c2.n) - ln(b.n) ELSE ln(0.4) + ln(a.n) - ln(z.n) END) AS score
  FROM e JOIN c1 a ON a.w = e.w LEFT JOIN c1 b ON b.w = e.u LEFT JOIN c2 ON c2.u = e.u AND c2.w = e.w CROSS JOIN (SELECT count(*) AS n FROM e) z
  GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(s.n_words, 0) AS n_words, round(coalesce(s.score, 0.0), 4) AS log_score, round(s.score / s.n_words, 4) AS mean_log_score
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
"""

#: The model that the corpus itself gives: every pair that occurs is in it.
ORACLE_ALL = ORACLE.replace("c2.n >= 2", "c2.n >= 1")


def words_of(batch: pa.RecordBatch):
    """Ids (null: NO_ID), number of the document in the run, and words (never 0), of runs of rows doc_id, text."""
    ids = batch.column(0).fill_null(NO_ID).to_numpy()
    for start, data, bounds in chunks(batch.column(1)):
        words, doc = word_hashes(data, bounds)
        yield ids[start : start + len(bounds) - 1], doc, np.maximum(words, np.uint64(1))


def rows_of(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    signed = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in signed], names=names.split())


def grouped(doc: np.ndarray, key: np.ndarray, *values: np.ndarray):
    """Distinct pairs of document and key, and the sums of the values."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    starts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))) if len(doc) else np.empty(0, np.int64)
    return doc[starts], key[starts], *(np.add.reduceat(v[order], starts) if len(doc) else v for v in values)


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """w and n: how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in words_of(batch):
                yield rows_of("w n", *np.unique(words, return_counts=True))

    return docs.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def bigrams(docs: DataFrame) -> DataFrame:
    """doc, u, w, n: how often w follows u in the rows of a document; u is 0 before a row's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, doc, words in words_of(batch):
                first = np.zeros(len(words), np.uint64)
                same = doc[1:] == doc[:-1]
                first[1:][same] = words[:-1][same]
                order = np.lexsort((first, words, doc))
                d, u, w = doc[order], first[order], words[order]
                starts = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (u[1:] != u[:-1]) | (w[1:] != w[:-1]))) if len(d) else np.empty(0, np.int64)
                yield rows_of("doc u w n", own[d[starts]], u[starts], w[starts], np.diff(np.append(starts, len(d))))

    return docs.mapInArrow(run, "doc long, u long, w long, n long")


def results(sums: DataFrame) -> DataFrame:
    """A row for each row of a document; sums: doc, words, score and rows of each."""
    each = sums.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    doc_id = F.when(F.col("doc") != F.lit(NO_ID), F.col("doc")).alias("doc_id")
    mean = F.when(F.col("words") > 0, F.round(F.col("score") / F.col("words"), 4)).alias("mean_log_score")
    return each.select(doc_id, F.col("words").alias("n_words"), F.round("score", 4).alias("log_score"), mean)


def score(docs: DataFrame, corpus: DataFrame | None = None, least: int = 1) -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score (four decimals) of every row, under the counts of ``corpus``.

    Pairs that it has fewer than ``least`` times back off. Without a corpus it is docs themselves.
    """
    if corpus is None and least <= 1:
        return score_own(docs)
    docs, known = texts(docs), texts(docs if corpus is None else corpus)
    one = word_counts(known).select(F.col("w").alias("x"), F.col("n").alias("c"))
    two = bigrams(known).filter("u <> 0").groupBy("u", "w").agg(F.sum("n").alias("both")).filter(F.col("both") >= least)
    total = math.log(max(1, one.agg(F.sum("c")).first()[0] or 0))
    pairs = bigrams(docs).join(two, ["u", "w"], "left")
    hit, n = F.col("both").isNotNull(), F.col("n")
    plus = F.when(hit, n * F.log("both")).when(F.col("u") == 0, -n * F.lit(total)).otherwise(n * F.lit(math.log(ALPHA) - total))
    asked = pairs.select("doc", n.alias("words"), plus.alias("plus"), F.when(hit, F.col("u")).otherwise(F.col("w")).alias("x"), F.when(hit, -n).otherwise(n).alias("m"))
    added = asked.join(one, "x", "left").select("doc", "words", (F.col("plus") + F.col("m") * F.log(F.coalesce("c", F.lit(1)))).alias("score"), F.lit(0).alias("rows"))
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.lit(0).cast("long").alias("words"), F.lit(0.0).alias("score"), F.lit(1).alias("rows"))
    return results(added.unionByName(rows).groupBy("doc").agg(*[F.sum(c).alias(c) for c in ("words", "score", "rows")]))


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def frequent_pairs(docs: DataFrame, top) -> np.ndarray:
    """Counts of all pairs of the words in top, a matrix of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = top.value
        m = len(table)
        seen = np.zeros(m * m, np.int64)
        for batch in batches:
            for _, doc, words in words_of(batch):
                at, there = found(table, words)
                both = there[1:] & there[:-1] & (doc[1:] == doc[:-1])
                seen += np.bincount(at[:-1][both] * m + at[1:][both], minlength=m * m) if both.any() else 0
        where = np.flatnonzero(seen)
        yield rows_of("pair n", where, seen[where])

    m = len(top.value)
    out = np.zeros((m, m), np.int64)
    for row in docs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[divmod(row["pair"], m)] = row["n"]
    return out


def ngram_rows(docs: DataFrame, hot, top, pairs, total: int) -> DataFrame:
    """key, doc, n, m, plus: an n-gram's occurrences n in a document, and the m times that its ln c counts.

    The key stands before the document: what differs from row to row is then in one place, and compresses better.
    A row of docs has one of its own as well, with n = 0: its number of words as m, and the sum of what is known already.
    """
    names = "key doc n m plus"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, counts), best, known = hot.value, top.value, np.log(np.maximum(pairs.value, 1))
        logs, all_words, turn = np.log(counts), math.log(max(1, total)), 0
        for batch in batches:
            for own, doc, words in words_of(batch):
                follows = doc[1:] == doc[:-1]
                first, ahead = np.append(True, ~follows)[: len(words)], np.append(follows, False)[: len(words)]
                m = first.astype(np.int64) - ahead
                at, is_hot = found(table, words)
                plus = np.where(is_hot, m * logs[at], 0.0) if len(table) else np.zeros(len(words))
                plus -= first * all_words
                i, there = found(best, words)
                both = there[1:] & there[:-1] & follows
                plus[1:][both] += known[i[:-1][both], i[1:][both]]
                cold = np.flatnonzero(follows & ~both) + 1
                rare = np.flatnonzero(~is_hot)
                key = np.append(mix(words[cold - 1] * np.uint64(3) + mix(words[cold])), mix(words[rare] ^ np.uint64(0x9E6C63D0876A9A47)))
                one = np.ones(len(key), np.int64)
                d, key, n, m = grouped(np.append(doc[cold], doc[rare]), key, one, np.append(one[: len(cold)], m[rare]))
                order = np.lexsort((d, m, n))  # rows alike stand together, which halves what the shuffle writes of them
                yield rows_of(names, key[order], own[d[order]], n[order].astype(np.int32), m[order].astype(np.int32), np.zeros(len(d)))
                each = np.arange(turn, turn + len(own), dtype=np.uint64)
                turn += len(own)
                size = np.bincount(doc, minlength=len(own)).astype(np.int32)
                yield rows_of(names, mix(own.astype(np.uint64) + mix(each)), own, np.zeros(len(own), np.int32), size, np.bincount(doc, plus, len(own)).astype(float))

    return docs.mapInArrow(run, "key long, doc long, n int, m int, plus double")


def score_own(docs: DataFrame) -> DataFrame:
    """As ``score`` under the counts of docs themselves, every pair among them."""
    spark, docs = docs.sparkSession, texts(docs)
    mark = written()
    counted = stash(word_counts(docs))
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot_rows = counted.filter(F.col("n") >= max(1, -(-total >> HOT_BITS))).toPandas().sort_values("w", kind="stable")
    clear(spark, mark)
    ids, counts = hot_rows["w"].to_numpy(np.int64).view(np.uint64), hot_rows["n"].to_numpy(np.int64)
    order = np.argsort(ids)
    ids, counts = ids[order], counts[order]
    best = np.sort(ids[np.argsort(-counts, kind="stable")[:VERY_HOT]])
    hot, top = (spark.sparkContext.broadcast(x) for x in ((ids, counts), best))
    pairs = spark.sparkContext.broadcast(frequent_pairs(docs, top))
    rows = ngram_rows(docs, hot, top, pairs, total).repartition(max(partitions(spark), total // WORDS_A_PARTITION), "key")
    both = rows.withColumn("c", F.sum("n").over(Window.partitionBy("key")))
    own = F.col("n") == 0
    plus = F.when(own, F.col("plus")).otherwise(F.col("m") * F.log("c"))
    sums = both.groupBy("doc").agg(F.sum(plus).alias("score"), F.sum(F.when(own, F.col("m")).otherwise(0)).cast("long").alias("words"), F.sum(F.when(own, 1).otherwise(0)).cast("long").alias("rows"))
    return results(sums)

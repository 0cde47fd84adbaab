"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

The index has a posting (term, document, position) for each word of a document that any test item uses: words that no
item uses can be in no match. Each partition of the documents writes its own segment, sorted by term, so building it
shuffles nothing, and a look-up of few terms skips most of a segment. The postings of a term are its frequency.

Every window of ``WINDOW`` consecutive item words (an item of fewer is one window) is searched for as a phrase: its
terms are ordered by frequency, the list of the rarest is shifted by the difference of their offsets and intersected
with the list of the second, and what is left with the lists of all others, within the documents left. An
intersection is a join by (document, position, term), whose keys hardly repeat, so no frequent term gathers in a task;
equal windows and equal pairs of terms are looked up once. A window with a term that no document has is not searched for.

``phrases`` gives exact matches; ``near`` gives places where all words of a window stand, in any order, within a reach
of its rarest one. Windows and vocabulary are broadcast only where Spark finds them small; else they are shuffled.

Defined results: a null text has no words; an item without words has no window and is found nowhere; an item id that
several rows share is one item, found where any of its rows is; a null item id is an item of its own, written as an
empty text; repeated documents are judged one by one; empty tables give no rows, or no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_lower, stash

#: Consecutive item words that count as copied.
WINDOW = 10
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands after a document's last word; its position is the number of words.
LAST = -1


def words(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters and digits and of anything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN), "")


def vocabulary(items: DataFrame) -> DataFrame:
    """word and term of each word of the items, and LAST for the empty word."""
    found = items.select(F.explode(words(F.col("text"))).alias("word")).distinct()
    numbered = found.withColumn("term", F.monotonically_increasing_id())
    last = items.sparkSession.createDataFrame([("", LAST)], "word string, term long")
    return stash(numbered.unionByName(last))


def index(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Postings term, doc, pos; a document's own row has the term LAST, its number of words as pos, and its doc_id."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.array_append(words(F.col("text")), F.lit("")).alias("words"))
    tokens = rows.select("doc", "doc_id", F.posexplode("words").alias("pos", "word")).join(vocab, "word")
    postings = tokens.select("term", "doc", "pos", F.when(F.col("term") == LAST, F.col("doc_id")).alias("doc_id"))
    return stash(postings.sortWithinPartitions("term", "doc", "pos"))


def windows(items: DataFrame, vocab: DataFrame, postings: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows whose terms all occur (window, length, terms, rare), and which items have each (window, item_id).

    terms: term by offset; rare: (frequency, offset, term), rarest first.
    """
    count = postings.filter(F.col("term") != LAST).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    known = stash(vocab.join(count, "term"))
    split = items.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    each = split.select("row", "item_id", F.size("words").alias("n_words"), F.posexplode("words").alias("at", "word")).join(known, "word", "left")
    ahead = Window.partitionBy("row").orderBy("at").rowsBetween(0, size - 1)
    length = F.least(F.lit(size), F.col("n_words"))
    framed = each.select("row", "item_id", "at", length.alias("length"), F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term")).over(ahead).alias("held"), F.col("n_words"))
    whole = framed.filter((F.col("at") + F.col("length") <= F.col("n_words")) & F.forall("held", lambda x: x["n"] > 0))
    terms = F.transform(F.array_sort(F.transform("held", lambda x: F.struct(x["at"].alias("at"), x["term"].alias("term")))), lambda x: x["term"])
    rare = F.array_sort(F.transform("held", lambda x: F.struct(x["n"].alias("n"), (x["at"] - F.col("at")).alias("offset"), x["term"].alias("term"))))
    whole = stash(whole.select("item_id", "length", terms.alias("terms"), rare.alias("rare")).distinct())
    distinct = whole.groupBy("terms").agg(F.first("length").alias("length"), F.first("rare").alias("rare"))
    distinct = stash(distinct.withColumn("window", F.monotonically_increasing_id()))
    return distinct, whole.join(distinct.select("terms", "window"), "terms").select("window", "item_id").distinct()


def phrases(postings: DataFrame, found: DataFrame) -> DataFrame:
    """doc, start, length, window of every exact occurrence of every window."""
    lists = postings.filter(F.col("term") != LAST).select("term", "doc", "pos")
    second = F.try_element_at("rare", F.lit(2))
    marked = found.select(
        "window", "length", "terms", F.col("rare")[0]["offset"].alias("offset"), F.col("rare")[0]["term"].alias("rarest"), F.coalesce(second["term"], F.lit(LAST)).alias("other"),
        F.coalesce(second["offset"] - F.col("rare")[0]["offset"], F.lit(0)).alias("gap"),
    )
    marked = stash(marked)
    pairs = marked.select("rarest", "other", "gap").distinct()
    seeds = lists.withColumnRenamed("term", "rarest").join(pairs, "rarest").select("rarest", "other", "gap", "doc", F.col("pos").alias("base"))
    others = lists.join(pairs.select(F.col("other").alias("term")).distinct(), "term", "left_semi").select("doc", F.col("pos").alias("at"), F.col("term").alias("other"))
    seeds = seeds.withColumn("at", F.col("base") + F.col("gap"))
    both = seeds.join(others, ["doc", "at", "other"], "left_semi").unionByName(seeds.filter(F.col("other") == LAST))
    started = both.join(marked, ["rarest", "other", "gap"]).withColumn("start", F.col("base") - F.col("offset")).filter("start >= 0")
    started = stash(started.select("doc", "start", "length", "window", "terms"))
    wanted = started.select("doc", "start", "length", "window", F.posexplode("terms").alias("i", "term")).withColumn("pos", F.col("start") + F.col("i")).drop("i")
    left = lists.join(stash(started.select("doc").distinct()), "doc", "left_semi")
    met = wanted.join(left, ["doc", "pos", "term"])
    return met.groupBy("doc", "start", "length", "window").agg(F.count(F.lit(1)).alias("n")).filter("n = length").drop("n")


def near(postings: DataFrame, found: DataFrame, reach: int) -> DataFrame:
    """doc, window, at of every place of a window's rarest term that has all other terms of it at most ``reach`` words away.

    Terms may stand in any order, and one that the window has twice need stand but once. Documents that lack the
    second rarest term near the rarest are left out before the other lists are looked at.
    """
    lists = postings.filter(F.col("term") != LAST).select("term", "doc", "pos", F.floor(F.col("pos") / reach).alias("cell"))
    terms = F.array_distinct(F.transform("rare", lambda x: x["term"]))
    marked = stash(found.select("window", F.col("rare")[0]["term"].alias("rarest"), F.slice(terms, 2, 1 << 20).alias("others")))
    at = lists.join(marked, lists["term"] == marked["rarest"]).select("doc", "window", F.col("pos").alias("at"), "cell", "others")

    def having(rows: DataFrame, others: DataFrame) -> DataFrame:
        """rows (doc, window, at, cell, term) that have the term near."""
        cells = rows.withColumn("cell", F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1)))
        met = cells.join(others, ["doc", "cell", "term"]).filter(F.abs(F.col("pos") - F.col("at")) <= reach)
        return met.select("doc", "window", "at", "term").distinct()

    single = at.filter(F.size("others") == 0).select("doc", "window", "at")
    pairs = marked.filter(F.size("others") > 0).select(F.col("others")[0].alias("term")).distinct()
    two = having(at.filter(F.size("others") > 0).withColumn("term", F.col("others")[0]), lists.join(pairs, "term", "left_semi"))
    open_ = stash(two.select("doc", "window", "at").join(marked.select("window", "others"), "window"))
    rows = open_.select("doc", "window", "at", F.floor(F.col("at") / reach).alias("cell"), F.explode("others").alias("term"), F.size("others").alias("n_others"))
    left = lists.join(stash(open_.select("doc").distinct()), "doc", "left_semi")
    full = having(rows, left).groupBy("doc", "window", "at").agg(F.count(F.lit(1)).alias("n"))
    full = full.join(marked.select("window", F.size("others").alias("n")), ["window", "n"]).select("doc", "window", "at")
    return full.unionByName(single)


def prepared(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The postings, the windows that may occur, and the items that have them."""
    vocab = vocabulary(items)
    postings = index(docs, vocab)
    return postings, *windows(items, vocab, postings, size)


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    postings, found, having = prepared(docs, items, size)
    met = stash(phrases(postings, found))
    before = F.max(F.col("start") + F.col("length")).over(Window.partitionBy("doc").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("length")
    new = met.select("doc", "start", "length").distinct().select("doc", F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(before, F.lit(0)))).alias("new"))
    hit = new.groupBy("doc").agg(F.sum("new").alias("n_hit"))
    listed = met.select("doc", "window").distinct().join(having, "window").select("doc", F.coalesce("item_id", F.lit("")).alias("item"), F.col("item_id").isNull().alias("none")).distinct()
    listed = listed.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item", "none"))), lambda x: x["item"]), ",").alias("ids"), F.count(F.lit(1)).alias("n_items"))
    own = postings.filter(F.col("term") == LAST).select("doc", "doc_id", F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return own.join(hit, "doc", "left").join(listed, "doc", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s + 1, s + n), ' ') AS t
  FROM (SELECT *, least({WINDOW}, len(w)) AS n, unnest(range(len(w) - least({WINDOW}, len(w)) + 1)) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT r, n, s, array_to_string(list_slice(w, s + 1, s + n), ' ') AS t
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT r, s, m.n, item_id FROM dw m JOIN bw ON m.n = bw.n AND m.t = bw.t),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(coalesce(item, ''), ',' ORDER BY item NULLS FIRST) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN i ON d.r = i.r
"""

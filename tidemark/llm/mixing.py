"""Mixing sources to target weights by Sainte-Laguë apportionment (DataFrame functions only).

Sources, in code-point order with null last, weigh 3, 1, 2 and so on; together they are to give 150 % of all words,
and none more than twice what it has: the excess is shared out anew by weight until none is above. The total, in
blocks of BLOCK words, is given to the sources by highest quotients target / (2 j - 1), and each source's blocks to
its shards in the same way, so that every shard has a whole number of blocks as its quota. A shard takes all its words
as often as the quota allows and then, in the order of a seeded hash, block after block up to the quota; the last one
may be cut.

Shards are made by hash and hold about SHARD_BLOCKS blocks (SHARDS a source at most), so that a source of any share
is spread over many tasks; only tables with a row for each source or shard are ranked as a whole.

Defined results: a null text has no words; documents without words take none; repeated rows are mixed one by one;
null doc_ids are a document like others; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, partitions, stash

BLOCK, SHARD_BLOCKS, SHARDS = 128, 2048, 4096
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids that stand for several rows (doc_id), and those rows of docs, numbered by ``dup`` within their id.

    The order is by source, size and a hash of the text, so it does not depend on the partitioning; a random number
    follows, which only deals rows of one text. Rows are numbered over ranges of that order, so that an id, or a text,
    with any share of all rows is dealt over many tasks, and an id's numbers start after the rows before it.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("__td_id"))
    several = stash(ids.groupBy("__td_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("__td_id"))
    if several.isEmpty():
        return several, docs.limit(0).withColumns({"__td_id": F.lit(None).cast("long"), "__td_size": F.lit(0).cast("long"), "dup": F.lit(0)})
    rows = docs.withColumn("__td_own", F.col("doc_id").cast("long")).join(several, F.col("__td_own").eqNullSafe(F.col("__td_id")), "left_semi")
    rows = rows.withColumnRenamed("__td_own", "__td_id").withColumns({"__td_size": n_words(F.col("text")), "__td_hash": F.xxhash64("text"), "__td_any": F.rand(1)})
    order = ["__td_id", "source", "__td_size", "__td_hash", "__td_any"]
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    ranged = stash(ranged.withColumn("__td_at", F.monotonically_increasing_id()))
    part = F.shiftright("__td_at", 33)
    sizes = stash(ranged.groupBy("__td_id", part.alias("__td_part")).agg(F.count(F.lit(1)).alias("c"), F.min("__td_at").alias("first")))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("__td_id").orderBy("__td_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("__td_id").alias("__td_k"), F.col("__td_part").alias("__td_p"), "first", before.alias("before"))  # a row for each id and task
    numbered = ranged.join(starts, F.col("__td_id").eqNullSafe(F.col("__td_k")) & (part == F.col("__td_p")))
    dup = (F.col("__td_at") - F.col("first") + F.col("before") + 1).cast("int").alias("dup")
    return several, numbered.select(*docs.columns, "__td_id", "__td_size", dup)


def singles(docs: DataFrame, several: DataFrame) -> DataFrame:
    """The rows whose id stands for no other, with the same columns as ``repeats`` adds."""
    own = docs.withColumns({"__td_id": F.col("doc_id").cast("long"), "__td_size": n_words(F.col("text")), "dup": F.lit(1)})
    ids = several.withColumnRenamed("__td_id", "__td_k")
    return own.join(ids, F.col("__td_id").eqNullSafe(F.col("__td_k")), "left_anti")


def numbered(docs: DataFrame) -> DataFrame:
    """docs with __td_id, __td_size and dup, which numbers the rows of one doc_id."""
    several, rows = repeats(docs)
    return singles(docs, several).unionByName(rows)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and dup of each row."""
    rows = numbered(docs.select("doc_id", "source", "text"))
    return rows.select(F.col("__td_id").alias("doc_id"), "source", F.col("__td_size").alias("size"), "dup")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target; sizes: source, source_size."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(place - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    rows = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(CAP)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(SHARE)
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = rows.withColumn("level", (total - before) / rest)
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("ratio"), "level"))
    lowest = level.withColumn("found", F.min(fits).over(Window.partitionBy()).getField("level"))
    return lowest.select("source", "source_size", F.least("cap", F.col("w") * F.col("found")).alias("target"))


def apportion(votes: DataFrame, group: list[str], name: list[str], vote: str, seats: str) -> DataFrame:
    """Adds won: the seats of each row by highest quotients vote / (2 j - 1) among the rows of its group.

    A row's seats are near its quota; only the quotients around it are ranked. seats is the group's number of seats.
    """
    own = Window.partitionBy(*group)
    quota = F.when(F.col("_v") > 0, F.col(vote) * F.col(seats) / F.col("_v")).otherwise(F.lit(0.0))
    slack = F.ceil(F.when(F.col("_v") > 0, F.col("_n") * F.col(vote) / F.col("_v")).otherwise(F.lit(0.0))) + 1
    rows = votes.withColumns({"_v": F.sum(vote).over(own).cast("double"), "_n": F.count(F.lit(1)).over(own)})
    rows = rows.withColumn("_lo", F.greatest(F.lit(0), F.floor(quota) - slack).cast("long")).withColumn("_hi", (F.floor(quota) + slack + 1).cast("long"))
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_lo").over(own))
    tried = rows.withColumn("_j", F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))))
    rank = F.row_number().over(own.orderBy((F.col(vote) / (F.lit(2) * F.col("_j") - F.lit(1))).desc(), *[F.col(c).asc_nulls_last() for c in name], "_j"))
    ranked = tried.withColumn("_won", F.when((rank <= F.col("_open")) & (F.col(vote) > 0), 1).otherwise(0))
    keep = [c for c in votes.columns if c not in (*group, *name)]
    return ranked.groupBy(*group, *name).agg(*[F.first(c).alias(c) for c in keep], (F.first("_lo") + F.sum("_won")).cast("long").alias("won"))


def seeded(*columns: str) -> Column:
    """60 bits of a hash that other engines have as well."""
    text = F.concat_ws("/", F.lit(SEED), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def plan(rows: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """What the mix takes of each block (doc_id, dup, b, words, whole, extra), and the sources' targets.

    rows: doc_id, dup, source, size. The block is taken whole times, and then its first extra words once more.
    """
    n_blocks = F.ceil(F.col("size") / F.lit(block))
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(n_blocks).alias("blocks"))
    per_source = stash(per_source)
    wanted = stash(targets(per_source.select("source", "source_size")))
    seats = wanted.withColumn("seats", F.floor(F.sum("target").over(Window.partitionBy()) / F.lit(block) + F.lit(0.5)).cast("long"))
    given = apportion(seats, [], ["source"], "target", "seats").select("source", F.col("won").alias("seats"))
    shards = F.greatest(F.lit(1), F.least(F.lit(SHARDS), F.ceil(F.col("blocks") / F.lit(shard_blocks)))).cast("long")
    given = stash(given.join(per_source, given["source"].eqNullSafe(per_source["source"])).select(given["source"].alias("of"), "seats", shards.alias("shards")))

    cut = rows.filter("size > 0").withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks.cast("long") - 1)))
    cut = cut.withColumn("words", F.least(F.lit(block), F.col("size") - F.col("b") * F.lit(block)).cast("long")).withColumn("at", seeded("doc_id", "dup", "b"))
    in_shards = cut.join(F.broadcast(given) if given.count() * 64 < 8 << 20 else given, F.col("source").eqNullSafe(F.col("of")))
    in_shards = in_shards.withColumn("shard", F.pmod(F.col("at"), F.col("shards")))
    held = in_shards.groupBy("of", "shard").agg(F.sum("words").alias("held"), F.first("seats").alias("seats"))
    quota = apportion(stash(held), ["of"], ["shard"], "held", "seats")
    quota = stash(quota.select(F.col("of").alias("q_of"), F.col("shard").alias("q_shard"), "held", F.least(F.col("won") * F.lit(block), F.col("held") * F.lit(CAP)).alias("quota")))
    own = Window.partitionBy("of", "shard").orderBy("at", "doc_id", "dup", "b").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_shards.select("doc_id", "dup", "b", "words", "of", "shard", F.coalesce(F.sum("words").over(own), F.lit(0)).alias("before"))
    both = placed.join(quota, F.col("of").eqNullSafe(F.col("q_of")) & (F.col("shard") == F.col("q_shard")))
    whole = F.floor(F.col("quota") / F.col("held")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("words"), F.col("quota") - whole * F.col("held") - F.col("before"))).cast("long")
    return both.select("doc_id", "dup", "b", "words", whole.alias("whole"), extra.alias("extra")), wanted


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of docs."""
    rows = stash(sized(docs))
    taken, wanted = plan(rows)
    taken = taken.groupBy("doc_id", "dup").agg(F.sum(F.col("words") * F.col("whole") + F.col("extra")).alias("taken"))
    taken = taken.select(F.col("doc_id").alias("t_id"), F.col("dup").alias("t_dup"), "taken")
    small = F.broadcast(wanted) if wanted.count() * 64 < 8 << 20 else wanted
    known = rows.join(small.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    both = known.join(taken, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("dup") == F.col("t_dup")), "left")
    return both.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them: a row for each of up to CAP copies, whose text holds the taken words in order.

    A copy that is whole keeps its text as it is. All columns stay; n_chars, if there is one, follows the text.
    """
    rows = numbered(docs).withColumnRenamed("__td_id", "__td_doc").withColumnRenamed("dup", "__td_n")
    taken, _ = plan(stash(rows.select(F.col("__td_doc").alias("doc_id"), F.col("__td_n").alias("dup"), "source", F.col("__td_size").alias("size"))))
    parts = F.sort_array(F.collect_list(F.struct("b", "words", "whole", "extra"))).alias("__td_parts")
    taken = taken.groupBy("doc_id", "dup").agg(parts).select(F.col("doc_id").alias("__td_id"), F.col("dup").alias("__td_dup"), "__td_parts")
    both = rows.join(taken, F.col("__td_doc").eqNullSafe(F.col("__td_id")) & (F.col("__td_n") == F.col("__td_dup")))
    both = both.withColumn("__td_copy", F.explode(F.sequence(F.lit(1), F.lit(CAP))))
    own = lambda x: F.when(x["whole"] >= F.col("__td_copy"), x["words"]).when(x["whole"] == F.col("__td_copy") - 1, x["extra"]).otherwise(F.lit(0))
    both = both.withColumn("__td_take", F.transform("__td_parts", lambda x: F.struct(x["b"].alias("b"), own(x).cast("int").alias("n"))))
    total = F.aggregate("__td_take", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    both = both.withColumn("__td_words", total).filter("__td_words > 0")
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    pieces = F.transform("__td_take", lambda x: F.array_join(F.slice(F.col("__td_split"), (x["b"] * F.lit(BLOCK) + 1).cast("int"), x["n"]), ""))
    both = both.withColumn("__td_split", F.when(F.col("__td_words") < F.col("__td_size"), words))
    text = F.when(F.col("__td_split").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    out = both.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)

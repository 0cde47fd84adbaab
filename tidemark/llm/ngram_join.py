"""Jaccard join of word-shingle sets, size-aware with a light and a heavy side.

Two sets with a Jaccard similarity of num/den or more share at least ``need`` = ceil(num * n / den) shingles, n being
the size of either. In any order that all sets agree on, the first n - need + j shingles of both then have j in
common (j <= need). The first order is that of the hashes:

* *light* sets (at most ``boundary`` shingles) enumerate the pairs among their first n - need + 2 shingles;
* *heavy* sets are scanned by inverted lists of their first n - need + l shingles, which light sets near the boundary
  enter as well; l grows with the size (``ell``), and two sets are candidates if lists hold both of them l times;
* the boundary is the size at which the cost is least: one for a key, SHARED_COST for a key that others share too.

A list of up to LIST sets gives pairs, whose counts are summed over all lists. A longer list gives none. Two similar sets
of which one is in no longer list have met already, so only those in longer lists, *affected* sets, need to meet again:
by the same rule for single shingles, in an order that has what many of them hold last. Every shingle of an affected
set gets a level by the true number of affected sets that hold it, in two steps, so that most sets need not be read
again: those with a low hash are counted first, and only sets that have too few of level 0 among these bring all their
shingles, of which those with a high hash are counted. The order is by level, low before high, then by hash. A long
list is then left only to sets which have too few rarer shingles: it is chained through its smallest set, an edge a
set. Nothing here depends on the size of the input: lengths are counted, not estimated, and the counts are tables that
join by key.

The components of this candidate graph, the larger ones by size range as well, are *blocks*. A block that fits a unit
is verified there, every pair by exact intersection counts (a matrix product). A larger one is cut into parts, and all
its documents first meet LEADERS of them, which takes rows in proportion to the block. Most members of a large group
of near copies are then in one component, and only pairs with one of the others are left: these meet part by part.

A node is a set, not an id: its fingerprint (hi, lo), numbered by lo. Two sets have the same number with a chance of
2**-64. A row of docs is found again by its id, null-safely, and a hash of its text.

Defined results: null, empty or word-free texts have the empty set, link with nothing and are their own component;
repeated rows are equal documents; rows that share an id but not a text are separate documents, and so are rows without
an id. component_id is the smallest id of a component, null if no row of it has one; unlinked components can therefore
show the same id. An empty table gives no rows. A set is held whole by a task, a group of sets never.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import clear, partitions, stash, written
from tidemark.llm.shingles import chunks, mix, shingle_sets

#: Most documents and shingles in one part of a unit; a unit has two parts.
UNIT_DOCS, UNIT_SHINGLES = 64, 200_000
#: Documents of a large block that all others of it meet first.
LEADERS = 64
#: Pairs of lists that a task holds before it adds them up.
PAIRS = 250_000
#: Longest list that gives pairs, and how many times longer the lists of a level are than those of the one below.
LIST, LEVEL = 64, 2
#: The low hashes: a share of all a little over that of the shingles that a set posts (n - need + depth).
LOW = 0.3
#: What a shared key costs in keys, and the share of all shingles (by hash) whose lists are counted to know how many are.
SHARED_COST, SAMPLED = 16, 1 / 256
#: Postings in one task of the key stage, about.
BUCKET_POSTINGS = 200_000
#: Largest size that the histogram tells apart; larger sets are heavy.
LARGEST_LIGHT = 4096
PROFILE = "doc_id long, mark long, n long, hi long, lo long, sampled array<long>"
POSTED = "node long, size int, l int, singles int, first array<long>, a array<long>, b array<long>"


def need(n: np.ndarray | int, num: int, den: int):
    """Shingles that a set of n shares at least with any set similar to it."""
    return -(-num * n // den)


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    return tuple(int(mix(own ^ np.uint64(salt)).sum().astype(np.int64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def text_mark() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def row_keys(doc_id: Column, mark: Column) -> list[Column]:
    """Columns, none of them null, that are equal where ids and texts are."""
    doc_id = doc_id.cast("long")
    return [mark.alias("__td_mark"), F.coalesce(doc_id, F.lit(0)).alias("__td_id"), doc_id.isNull().alias("__td_none")]


ROW_KEYS = ["__td_mark", "__td_id", "__td_none"]


def lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))


def profile(docs: DataFrame, k: int) -> DataFrame:
    """A row per document: hash of its text, size and fingerprint of its set, and a set's sampled shingles once a task."""
    names = [x.split()[0] for x in PROFILE.split(", ")]
    below, none = np.uint64(int(SAMPLED * (1 << 64))), np.empty(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for start, data, bounds in chunks(batch.column(2)):
                out, sampled = [], []
                for own in shingle_sets(data, bounds, k):
                    mine = (len(own), *fingerprint(own))
                    out.append(mine)
                    sampled.append(none if mine in seen else own[: np.searchsorted(own, below)])
                    seen.add(mine)
                ids = [batch.column(i).slice(start, len(out)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ids, *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)), lists(sampled)], names=names)

    clean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark().alias("mark"), F.coalesce("text", F.lit("")).alias("text"))
    return clean.mapInArrow(run, PROFILE)


def shared_share(profiled: DataFrame) -> float:
    """Share of the sampled shingles that stand in a list of two or more."""
    counts = profiled.select(F.explode("sampled").alias("x")).groupBy("x").count()
    row = counts.agg(F.sum(F.when(F.col("count") > 1, F.col("count")).otherwise(0)).alias("shared"), F.sum("count").alias("n")).first()
    return float(row["shared"] or 0) / max(1, row["n"] or 0)


def choose_boundary(sizes: dict[int, int], shared: float, num: int, den: int) -> tuple[int, int]:
    """Largest light size, and the postings that it leads to; sizes: sets by size, those over LARGEST_LIGHT together."""
    listed = lambda n: n - need(n, num, den) + 1
    scan = lambda n: listed(n) * (1 + shared * SHARED_COST)
    pairs = lambda n: math.comb(listed(n) + 1, 2) if need(n, num, den) >= 2 else math.inf
    best = (math.inf, 0, 0)
    for x in sorted({0, *(n for n in sizes if n < LARGEST_LIGHT and n * den >= num * (n + 1) and pairs(n) <= 4 * scan(n))}):
        near = need(x + 1, num, den)
        able = [(n, c) for n, c in sizes.items() if n * den >= num * (n + 1)]
        cost = sum(c * ((pairs(n) if n <= x else 0) + (scan(n) if n > x or n >= near else 0)) for n, c in able)
        keys = sum(c * ((pairs(n) if n <= x else 0) + (listed(n) if n > x or n >= near else 0)) for n, c in able)
        best = min(best, (cost, x, keys))
    return best[1], int(best[2])


def ell(n, boundary: int, num: int, den: int):
    """How many lists must hold two sets, for the size of either: a share of the listed shingles, and at least 1."""
    return np.where(n > boundary, 1 + (n - need(n, num, den) + 1) // 8, 1)


def depth(n: int) -> int:
    """How many shingles over n - need are posted with a set, so that most that hold common ones need not be read again."""
    return 1 + n // 8


def postings(docs: DataFrame, k: int, num: int, den: int, boundary: int) -> DataFrame:
    """A row per set and task: node, size, l, its first shingles by hash (``singles`` of them are keys), pairs (a, b)."""
    near, none = need(boundary + 1, num, den), np.empty(0, np.uint64)
    names = [x.split()[0] for x in POSTED.split(", ")]

    def keys(own: np.ndarray) -> tuple:
        n = len(own)
        rest, most = n - need(n, num, den), int(ell(n, boundary, num, den))
        first = own[: rest + depth(n)]
        if n > boundary:
            return n, most, rest + most, first, none, none
        i, j = np.triu_indices(min(n, rest + 2), 1)
        return n, most, rest + 1 if n >= near else 0, first, own[i], own[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, data, bounds in chunks(batch.column(0)):
                out, nodes = [], []
                for own in shingle_sets(data, bounds, k):
                    if len(own) * den < num * (len(own) + 1):  # similar to equal sets alone
                        continue
                    mine = fingerprint(own)
                    if mine not in seen:
                        seen.add(mine)
                        nodes.append(mine[1])
                        out.append(keys(own))
                size, most, singles, *arrays = zip(*out) if out else [()] * 6
                plain = [pa.array(nodes, pa.int64()), *(pa.array(np.array(x, np.int32)) for x in (size, most, singles))]
                yield pa.RecordBatch.from_arrays([*plain, *(lists(list(x)) for x in arrays)], names=names)

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, POSTED)


def first_keys(posted: DataFrame) -> DataFrame:
    """Rows a, b, node, size, l: a pair's key is (a, b), that of a single shingle (a, 0)."""
    plain = posted.select("node", "size", "l", F.explode(F.slice("first", F.lit(1), F.col("singles"))).alias("a")).withColumn("b", F.lit(0).cast("long"))
    paired = posted.filter(F.size("a") > 0).select("node", "size", "l", F.inline(F.arrays_zip("a", "b")))
    return plain.unionByName(paired).select("a", "b", "node", "size", "l")


def long_lists(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys (a, b) that more than LIST sets have, with their number and smallest set; and the rows node, a, b of those.

    Rows are counted first, combined before the shuffle. As a set can have a row from each task that met a copy of it,
    the sets are then counted where the rows are more than LIST.
    """
    many = stash(keys.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > LIST).select("a", "b"))
    rows = stash(keys.join(many, ["a", "b"]).select("node", "a", "b").distinct())
    long = stash(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("least")).filter(F.col("sets") > LIST))
    return long, rows.join(long, ["a", "b"])


def levels(one: DataFrame) -> DataFrame:
    """shingle and level (1 or more) of those that more than LIST of the rows hold; all others have level 0."""
    level = F.floor(F.log(F.col("rows") / F.lit(float(LIST))) / F.lit(math.log(LEVEL))).cast("int") + 1
    return one.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > LIST).select("shingle", level.alias("level"))


def low(shingle: Column) -> Column:
    return (shingle >= 0) & (shingle < int(LOW * (1 << 64)))


def whole_sets(docs: DataFrame, distinct: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Rows node, size, l, first of ``nodes`` (node, size, l), ``first`` being all shingles of the set, in order."""
    wanted = distinct.join(nodes, F.col("lo") == F.col("node")).select(*row_keys(F.col("least"), F.col("mark")), "hi", "node", "size", "l")
    texts = docs.select(*row_keys(F.col("doc_id"), text_mark()), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(wanted, ROW_KEYS).dropDuplicates(["hi", "node"]).select("node", "size", "l", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, bounds in chunks(batch.column(3)):
                sets = shingle_sets(data, bounds, k)
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(sets)).columns[:3], lists(sets)], names=["node", "size", "l", "first"])

    return rows.mapInArrow(run, "node long, size int, l int, first array<long>")


def second_keys(posted: DataFrame, common: DataFrame, num: int, den: int, whole) -> DataFrame:
    """Rows a, b, node, size, l of the sets in long lists: their first n - need + l shingles by level, zone and hash.

    Most sets have enough of level 0 in the low zone, among the shingles that were posted. Of the others, ``whole``
    gives all shingles, among which those of the high zone are counted.
    """
    size = F.col("size").cast("long")
    most = (size - F.ceil(size * F.lit(num) / F.lit(den)) + F.col("l")).cast("int")
    again = posted.join(common.select("node").distinct(), "node", "left_semi").select("node", "size", "l", F.filter("first", low).alias("first"))
    again = stash(again.dropDuplicates(["node"]))
    one = again.select("node", F.explode("first").alias("shingle"))
    lows = stash(levels(one))
    hits = one.join(lows, "shingle").groupBy("node").agg(F.collect_set("shingle").alias("hits"))
    rare = again.join(hits, "node", "left").withColumn("rare", F.array_except("first", F.coalesce("hits", F.array().cast("array<long>")))).withColumn("most", most)
    rare = stash(rare.select("node", "size", "l", "most", F.slice("rare", F.lit(1), F.col("most")).alias("rare")))
    plain = rare.filter(F.size("rare") >= F.col("most")).select(F.explode("rare").alias("a"), "node", "size", "l")
    deep = stash(rare.filter(F.size("rare") < F.col("most")).select("node", "size", "l"))
    if not deep.isEmpty():
        one = stash(whole(deep)).select("node", "size", "l", F.posexplode("first").alias("at", "shingle"))
        known = stash(levels(one.filter(~low(F.col("shingle")))).unionByName(lows))
        key = F.struct(F.coalesce("level", F.lit(0)).alias("level"), (~low(F.col("shingle"))).alias("high"), "at", "shingle")
        sets = one.join(known, "shingle", "left").groupBy("node", "size", "l").agg(F.array_sort(F.collect_list(key)).alias("keys"))
        chosen = sets.select(F.explode(F.slice("keys", F.lit(1), most)).alias("k"), "node", "size", "l")
        plain = plain.unionByName(chosen.select(F.col("k.shingle").alias("a"), "node", "size", "l"))
    return plain.select("a", F.lit(0).cast("long").alias("b"), "node", "size", "l")


def summed(pairs: np.ndarray) -> np.ndarray:
    """Rows a, b, l and n with each pair once and its n added up."""
    pairs = pairs[:, np.lexsort(pairs[1::-1])]
    if not pairs.shape[1]:
        return pairs
    fresh = np.flatnonzero(np.append(True, np.any(pairs[:2, 1:] != pairs[:2, :-1], axis=0)))
    return np.concatenate([pairs[:2, fresh], np.minimum.reduceat(pairs[2], fresh)[None, :], np.add.reduceat(pairs[3], fresh)[None, :]])


def met(keys: DataFrame, num: int, den: int, buckets: int) -> DataFrame:
    """Pairs (a, b) of sets whose sizes allow a link and which the lists, none of them long, hold often enough."""

    def link(table):
        order = np.lexsort([table.column(c).to_numpy() for c in ("node", "b", "a")])
        a, b, node, size, l = (table.column(c).to_numpy()[order] for c in ("a", "b", "node", "size", "l"))
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (node[1:] == node[:-1])
        a, b, node, size, l = (x[~again] for x in (a, b, node, size.astype(np.int64), l.astype(np.int64)))
        order = np.lexsort((size, b, a))
        a, b, node, size, l = (x[order] for x in (a, b, node, size, l))
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (size[:-1] * den < size[1:] * num)
        starts = np.flatnonzero(fresh)
        length = np.diff(np.append(starts, len(a)))
        out, waiting = [], 0
        for many in np.unique(length[length > 1]):
            every = starts[length == many]
            i, j = np.triu_indices(many, 1)
            for own in np.array_split(every, -(-len(every) * len(i) // PAIRS)):
                x, y = (own[:, None] + i[None, :]).ravel(), (own[:, None] + j[None, :]).ravel()
                fit = size[x] * den >= size[y] * num
                x, y = x[fit], y[fit]
                out.append(np.stack([np.maximum(node[x], node[y]), np.minimum(node[x], node[y]), np.minimum(l[x], l[y]), np.ones(len(x), np.int64)]))
                waiting += len(x)
                if waiting > 2 * PAIRS:
                    out = [summed(np.concatenate(out, 1))]
                    waiting = 0
        pair = summed(np.concatenate(out, 1)) if out else np.empty((4, 0), np.int64)
        return pa.table({name: pa.array(c) for name, c in zip("abln", pair)})

    dealt = keys.select(F.pmod(F.xxhash64("a", "b"), F.lit(buckets)).alias("bucket"), "a", "b", "node", "size", "l")
    found = dealt.groupBy("bucket").applyInArrow(link, "a long, b long, l long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.min("l").alias("l")).filter("n >= l").select("a", "b")


def candidate_edges(posted: DataFrame, num: int, den: int, buckets: int, whole) -> DataFrame:
    """Edges (a, b) that connect all nodes which share enough keys and whose sizes allow a link.

    ``whole`` gives the rows node, size, l and first (all shingles) of such nodes.
    """
    keys = first_keys(posted)
    long, common = long_lists(keys)
    edges = met(keys.join(long, ["a", "b"], "left_anti"), num, den, buckets)
    if long.isEmpty():
        return edges
    again = stash(second_keys(posted, common, num, den, whole))
    left, chained = long_lists(again)
    more = met(again.join(left, ["a", "b"], "left_anti"), num, den, buckets)
    return edges.unionByName(more).unionByName(chained.select(F.col("node").alias("a"), F.col("least").alias("b")))


def overlaps(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections, exactly."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[at]
    column, owner = (np.cumsum(shared) - 1)[at[keep]], owner[keep]
    out = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, int(shared.sum()), columns):
        lo, hi = np.searchsorted(column, [start, start + columns])
        block = np.zeros((n, columns), np.float32)
        block[owner[lo:hi], column[lo:hi] - start] = 1
        out += block @ block.T
    return out.astype(np.int64)


def forest(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """For links between positions a and b: each linked name and the smallest name it reaches through them."""
    parent = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(names[a].tolist(), names[b].tolist()):
        parent.setdefault(x, x), parent.setdefault(y, y)
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return list(parent), [root(x) for x in list(parent)]


def verified_links(units: DataFrame, num: int, den: int) -> DataFrame:
    """Edges that connect the similar documents of a unit; units: deal, block, kind, i, j, side, rep, shingles.

    Documents of side 0 meet those of side 1, or each other where the unit has one side.
    """

    def check(table):
        rep, side, names = table.column("rep").to_numpy(), table.column("side").to_numpy(), [table.column(c).to_numpy() for c in ("block", "kind", "i", "j")]
        sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
        order = np.lexsort((rep, side, *names[::-1]))
        change = np.any([x[order][1:] != x[order][:-1] for x in names], axis=0)
        out_a, out_b = [], []
        for part in np.split(order, np.flatnonzero(change) + 1):
            if len(part) < 2:
                continue
            own = [sets[i] for i in part]
            size = np.array([len(x) for x in own])
            both = overlaps(own)
            near = np.triu(den * both >= num * (size[:, None] + size[None, :] - both), 1)
            if side[part].min() != side[part].max():
                near &= side[part][:, None] != side[part][None, :]
            x, y = forest(rep[part], *np.nonzero(near))
            out_a += x
            out_b += y
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return units.groupBy("deal").applyInArrow(check, "a long, b long")


def with_sets(rows: DataFrame, k: int) -> DataFrame:
    """Rows rep, places, hi, lo, text with the set's bytes in place of the last three, where it has that fingerprint."""
    schema = f"rep long, places {rows.schema['places'].dataType.simpleString()}, shingles binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, text = (batch.column(i) for i in (2, 3, 4))
            for start, data, bounds in chunks(text):
                sets = shingle_sets(data, bounds, k)
                keep = [i for i, own in enumerate(sets) if fingerprint(own) == (hi[start + i].as_py(), lo[start + i].as_py())]
                rows = batch.slice(start, len(sets)).take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["rep", "places", "shingles"])

    return rows.mapInArrow(run, schema)


def _place(kind: int, i, j, side):
    """Where a document goes: a struct of unit and side."""
    long = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("long")
    return F.struct(F.col("block"), long(kind).alias("kind"), long(i).alias("i"), long(j).alias("j"), long(side).alias("side"))


def _upto(n):
    return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))


def links_at(places: DataFrame, picked: DataFrame, k: int, num: int, den: int, deals: int) -> DataFrame:
    """Edges between the documents that meet at places; places: rep, p (arrays of ``_place``)."""
    own = places.filter(F.size("p") > 0).groupBy("rep").agg(F.flatten(F.collect_list("p")).alias("places"))
    found = own.hint("merge").join(picked.hint("merge"), F.col("rep") == F.col("id")).select("rep", "places", "hi", "lo", "text")
    spread = with_sets(found, k).select("rep", F.explode("places").alias("u"), "shingles").select("rep", "u.*", "shingles")
    return verified_links(spread.select(F.pmod(F.xxhash64("block", "kind", "i", "j"), F.lit(deals)).alias("deal"), "*"), num, den)


def linked_groups(named: DataFrame, picked: DataFrame, k: int, num: int, den: int, deals: int) -> DataFrame:
    """node and component of documents with a similar one; named: rep, comp, n; picked: id (the node), hi, lo, text."""
    weigh = lambda rows, *by: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles")).filter("docs > 1")
    parts = F.greatest(F.ceil(F.col("docs") / F.lit(UNIT_DOCS)), F.ceil(F.col("shingles") / F.lit(UNIT_SHINGLES)), F.lit(1)).cast("long")
    counts = stash(weigh(named, "comp").select("comp", (parts > 1).alias("large")))
    grade = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(den / num) + 1e-9)).cast("long") if num < den else F.lit(0).cast("long")
    ranges = F.when(F.col("large"), F.array(grade, grade - 1)).otherwise(F.array(F.lit(0).cast("long")))
    ranged = stash(named.join(counts, "comp").withColumn("grade", F.explode(ranges)).select("rep", F.xxhash64("comp", "grade").alias("block"), "n"))
    sizes = stash(weigh(ranged, "block").select("block", F.least(parts, "docs").alias("parts")))
    blocks = stash(ranged.join(sizes, "block").select("rep", "block", "parts", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("part")))

    large = blocks.filter("parts > 1")
    slot, at = F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(LEADERS)), F.xxhash64("rep", F.lit(2))
    leaders = large.groupBy("block", "parts", slot.alias("slot")).agg(F.min_by("rep", at).alias("rep"))
    to_all = leaders.select("rep", F.transform(_upto(F.col("parts")), lambda i: _place(1, i, 0, 1)).alias("p"))
    first = blocks.select("rep", F.when(F.col("parts") > 1, F.array(_place(1, F.col("part"), 0, 0))).otherwise(F.array(_place(0, 0, 0, 0))).alias("p"))
    groups = stash(components(links_at(first.unionByName(to_all), picked, k, num, den, deals)))

    roots = groups.withColumnsRenamed({"node": "of", "component": "root"})
    rooted = stash(large.join(roots, F.col("rep") == F.col("of"), "left").select("rep", "block", "parts", "part", F.coalesce("root", "rep").alias("root")))
    main = rooted.groupBy("block", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("block").agg(F.max_by("root", F.struct("c", "root")).alias("main"), (F.sum("c") - F.max("c")).alias("others"))
    main = stash(main.filter("others > 0").select(F.col("block").alias("b"), "main", F.ceil(F.col("others") / F.lit(UNIT_DOCS)).cast("long").alias("other_parts")))
    if main.isEmpty():
        return groups
    left = rooted.join(main, F.col("block") == F.col("b"))
    mine = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("other_parts"))
    rest = F.concat(
        F.transform(_upto(F.col("parts")), lambda i: _place(2, i, mine, 1)),
        F.transform(_upto(F.col("other_parts")), lambda j: _place(3, F.least(mine, j), F.greatest(mine, j), F.when(mine > j, 1).otherwise(0))),
    )
    settled = F.transform(_upto(F.col("other_parts")), lambda j: _place(2, F.col("part"), j, 0))
    second = left.select("rep", F.when(F.col("root") == F.col("main"), settled).otherwise(rest).alias("p"))
    more = links_at(second, picked, k, num, den, deals)
    return components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def labelled_sets(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Rows doc_id, n, hi, lo of all documents, and all sets but the empty one: hi, lo, size, least (smallest id), mark
    (of a row with that id), root (the component's node) and component_id."""
    if not den < 2 * num <= 2 * den:
        raise ValueError("the similarity must be over 1/2 and at most 1")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mark = written()
    profiled = stash(profile(docs, k))
    each = profiled.select("doc_id", "mark", "n", "hi", "lo")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    distinct = each.filter("n > 0").groupBy("hi", "lo", "n").agg(F.min(first).alias("f"))
    distinct = stash(distinct.select("hi", "lo", "n", F.col("f.doc_id").alias("least"), F.col("f.mark").alias("mark")))
    sizes = {r["n"]: r["c"] for r in distinct.groupBy(F.least("n", F.lit(LARGEST_LIGHT)).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()}
    boundary, total = choose_boundary(sizes, shared_share(profiled), num, den)
    deals = partitions(spark)
    posted = stash(postings(docs, k, num, den, boundary))
    edges = candidate_edges(posted, num, den, max(2 * deals, total // BUCKET_POSTINGS), lambda nodes: whole_sets(docs, distinct, nodes, k))
    near = components(edges, contract=True)

    named = stash(distinct.join(near, F.col("lo") == F.col("node")).select(F.col("lo").alias("rep"), F.col("component").alias("comp"), "n", "hi", "lo", "least", "mark"))
    texts = docs.select(*row_keys(F.col("doc_id"), text_mark()), F.coalesce("text", F.lit("")).alias("text"))
    wanted = named.select(*row_keys(F.col("least"), F.col("mark")), "hi", "lo")
    picked = texts.hint("merge").join(wanted.hint("merge"), ROW_KEYS)
    picked = stash(picked.select(F.col("lo").alias("id"), "hi", "lo", "text").dropDuplicates(["hi", "lo"]))
    deal = max(4 * deals, sum(n * c for n, c in sizes.items()) // (20 * UNIT_SHINGLES))
    links = stash(linked_groups(named.select("rep", "comp", "n"), picked, k, num, den, deal))

    ids = links.join(named, F.col("rep") == F.col("node")).groupBy("component").agg(F.min("least").alias("smallest"))
    roots = links.join(ids, "component").select("node", F.col("component").alias("root"), "smallest")
    labelled = distinct.join(roots, F.col("lo") == F.col("node"), "left")
    labelled = labelled.select("hi", "lo", F.col("n").alias("size"), "least", "mark", F.coalesce("root", "lo").alias("root"), F.coalesce("smallest", "least").alias("component_id"))
    labelled = stash(labelled)
    clear(spark, mark, each, labelled)
    return each, labelled


def similar_documents(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents link at a similarity of num/den or more."""
    each, labelled = labelled_sets(docs, k, num, den)
    same = (each["hi"] == labelled["hi"]) & (each["lo"] == labelled["lo"]) & (each["n"] == labelled["size"])
    full = each.join(labelled, same).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    empty = each.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each component, of the smallest doc_id (null last); all columns stay.

    Rows without words are components of their own and stay, each of them.
    """
    _, labelled = labelled_sets(docs, k, num, den)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "mark")).alias("f")
    found = stash(labelled.groupBy("root").agg(first).select(*row_keys(F.col("f.least"), F.col("f.mark"))))
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.filter(~wordless).select("*", *row_keys(F.col("doc_id"), text_mark()))
    turn = F.row_number().over(Window.partitionBy(*ROW_KEYS).orderBy(*ROW_KEYS))
    kept = keyed.join(found, ROW_KEYS, "left_semi").withColumn("__td_turn", turn).filter("__td_turn = 1")
    return kept.select(docs.columns).unionByName(docs.filter(wordless))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS xs FROM t
), e AS MATERIALIZED (SELECT doc_id, len(xs) AS n, unnest(xs) AS x FROM s),
p AS (
  SELECT a.doc_id AS i, b.doc_id AS j FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links AS MATERIALIZED (SELECT i, j FROM p UNION ALL SELECT j, i FROM p),
r AS (SELECT DISTINCT i AS doc_id, i AS reached FROM links UNION SELECT r.doc_id, links.j FROM r JOIN links ON links.i = r.reached)
SELECT s.doc_id, CAST(len(xs) AS BIGINT) AS n_shingles, coalesce(least(s.doc_id, c.low), s.doc_id) AS component_id
FROM s LEFT JOIN (SELECT doc_id, min(reached) AS low FROM r GROUP BY doc_id) c ON c.doc_id = s.doc_id
"""

"""A Merkle manifest of a dataset: one root, and for each row the proof that ties it to the root.

Method: a sparse-forest monoid. A ``Forest`` holds the unresolved nodes of a part of the data, keyed by tree, level and
index; adding two forests unites their nodes, and whenever a run of siblings, whose length follows from the tree's size,
is complete, it becomes its parent. The sum does not depend on order or grouping, so parts of the leaves are added up
as a tree reduction: each range of leaves first by itself, then FAN neighbouring fragments at a time until one is left,
which is the root. The reduction is written out, a table a step (what ``RDD.treeReduce`` would keep to itself), because
the runs that a step completes are the siblings of proofs, and so that a lost executor costs one step. A fragment has at most
2 * ARITY nodes a level, whatever it stands for. A range's proofs need, besides its own runs, only the runs that were
completed in later steps on the way up from its fragment.

There is a tree for each lang, over its leaves by ascending doc_id (null first), and the tree TOP over their roots.

Defined results: a null field is written ``-``; a null doc_id is a leaf that is never tampered with; equal doc_ids go by
their leaf, and equal leaves in any order, which changes no digest; the only leaf is its lang's root and the only lang's
root is the dataset's; an empty table gives no rows. Columns besides the five fields are not part of a leaf.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.crc_sql import CRC, crc32
from tidemark.llm.shared import ascii_lower, partitions, stash

ARITY, HEX = 8, 64
#: Rows in a range of leaves, about; neighbouring fragments that one step adds up.
RANGE, FAN = 1 << 17, 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def width(size: int, level: int) -> int:
    """Nodes of a tree of so many leaves on a level."""
    return -(-size // ARITY**level)


class Forest:
    """Unresolved nodes by (tree, level, run of siblings); ``trees`` is the number of leaves of TOP, ``done`` gets every run that is completed."""

    def __init__(self, trees: int) -> None:
        self.trees, self.pending, self.sizes, self.done = trees, {}, {}, []

    def add(self, tree: int, size: int, level: int, index: int, node: str) -> None:
        """Adds one node and resolves what it completes."""
        while True:
            if width(size, level) == 1:
                if tree == TOP:
                    self.pending[TOP, level, 0] = {0: node}
                    self.sizes[TOP] = size
                    return
                tree, size, level, index = TOP, self.trees, 0, tree
                continue
            run = index // ARITY
            held = self.pending.setdefault((tree, level, run), {})
            held[index] = node
            self.sizes[tree] = size
            if len(held) < min(ARITY, width(size, level) - run * ARITY):
                return
            del self.pending[tree, level, run]
            together = "".join(held[i] for i in sorted(held))
            self.done.append((tree, size, level, run, together))
            level, index, node = level + 1, run, digest(together)

    def merge(self, nodes: Iterable[tuple[int, int, int, int, str]]) -> Forest:
        for node in nodes:
            self.add(*node)
        return self

    def nodes(self) -> Iterator[tuple[int, int, int, int, str]]:
        for (tree, level, _), held in self.pending.items():
            for index, node in held.items():
                yield tree, self.sizes[tree], level, index, node


STEP = "part long, done boolean, tree long, size long, level int, at long, digests string"
KINDS = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
NAMES = [field.split()[0] for field in STEP.split(", ")]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Runs of rows of one part; each must be used up before the next."""
    rows = (row for batch in batches for row in batch.to_pylist())
    yield from itertools.groupby(rows, key=lambda r: r["part"])


def _sum(nodes: DataFrame, trees: int, runs: bool = True) -> DataFrame:
    """One step: the nodes of each part are added up; gives its unresolved nodes, and ``runs`` completed on the way.

    nodes: part, tree, size, level, at, digests, all of a part in one partition and in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches):
            forest, left = Forest(trees), True
            while left:
                left = False
                for row in rows:
                    forest.add(row["tree"], row["size"], row["level"], row["at"], row["digests"])
                    if len(forest.done) >= 4096:
                        left = True
                        break
                out = [(part, True, *r) for r in forest.done if runs]
                forest.done = []
                if not left:
                    out += [(part, False, *r) for r in forest.nodes()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), KINDS)], names=NAMES)

    return nodes.mapInArrow(run, STEP)


def _by_part(df: DataFrame, parts: int, *order: str) -> DataFrame:
    return df.repartition(max(1, parts), "part").sortWithinPartitions("part", *order)


def reduced(leaves: DataFrame, parts: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """Adds up all leaves; gives the fragments of the single ranges and the runs completed after them, the root as a run of one.

    leaves: part, tree, size, level, at, digests.
    """
    first, later = stash(_sum(_by_part(leaves, parts, "tree", "at"), trees, runs=False)).drop("done"), []
    rest = first
    while True:
        parts = -(-parts // FAN)
        step = stash(_sum(_by_part(rest.withColumn("part", F.floor(F.col("part") / FAN).cast("long")), parts, "tree", "level", "at"), trees))
        later.append(step.filter("done").drop("done"))
        rest = step.filter("NOT done").drop("done")
        if parts == 1:
            break
    runs = rest.withColumn("at", F.lit(0).cast("long"))  # the root
    for one in later:
        runs = runs.unionByName(one)
    return first, runs.drop("part")


def ways(first: DataFrame, trees: int) -> DataFrame:
    """part, tree, level, at of each run above a fragment's nodes, the root included."""
    kind = "array<struct<tree:long,level:int,at:long>>"

    def up(tree: F.Column, size: F.Column, level: F.Column, index: F.Column) -> F.Column:
        """Runs from a level to the tree's root."""
        top = sum(((size > ARITY**k).cast("int") for k in range(21)), F.lit(0))
        return F.transform(F.sequence(level, top), lambda lev: F.struct(tree.alias("tree"), lev.cast("int").alias("level"), F.floor(index / F.pow(F.lit(float(ARITY)), (lev - level + 1).cast("double"))).cast("long").alias("at"))).cast(kind)

    top_tree, total = F.lit(TOP).cast("long"), F.lit(trees).cast("long")
    own = up(F.col("tree"), F.col("size"), F.col("level"), F.col("at"))
    above = F.when(F.col("tree") == TOP, F.array().cast(kind)).otherwise(up(top_tree, total, F.lit(0), F.col("tree")))
    return first.select("part", F.explode(F.concat(own, above)).alias("w")).select("part", "w.*").distinct()


ROWS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
ROW_KINDS = (pa.int64(), *[pa.string()] * 5, pa.bool_())
ROW_NAMES = [field.split()[0] for field in ROWS.split(", ")]


class Paths:
    """Siblings left and right of a node, level by level up to the root, from runs of siblings."""

    def __init__(self, trees: int) -> None:
        self.trees, self.runs, self.known = trees, {}, {}

    def above(self, tree: int, size: int, level: int, index: int) -> tuple[list[tuple[str, str]], str, str]:
        """(left, right) of each level from this node up, all siblings as one text, and the subroot reached."""
        if width(size, level) == 1 and tree == TOP:
            return [], "", ""
        key = tree, level, index
        if key not in self.known:
            if width(size, level) == 1:
                steps, text, _ = self.above(TOP, self.trees, 0, tree)
                self.known[key] = steps, text, self.node(tree, size, level, index)
            else:
                run, place = self.runs[tree, level, index // ARITY], HEX * (index % ARITY)
                steps, text, subroot = self.above(tree, size, level + 1, index // ARITY)
                pair = run[:place], run[place + HEX :]
                self.known[key] = [pair, *steps], pair[0] + pair[1] + text, subroot
        return self.known[key]

    def node(self, tree: int, size: int, level: int, index: int) -> str:
        """The digest of a lang's root: from its children, or, of a lone leaf, from the run of TOP that holds it."""
        if level:
            return digest(self.runs[tree, level - 1, index])
        if self.trees == 1:
            return self.root()
        return self.runs[TOP, 0, tree // ARITY][HEX * (tree % ARITY) :][:HEX]

    def root(self) -> str:
        level = 0
        while width(self.trees, level) > 1:
            level += 1
        return self.runs[TOP, level, 0]


def folded(node: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        node = digest(left + node + right)
    return node


def _proofs(rows: DataFrame, trees: int) -> DataFrame:
    """rows: part, kind (0: runs from outside, 1: leaves), tree, size, level, at, digests, doc_id, other; in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _groups(batches):
            paths, leaves, forest = Paths(trees), [], Forest(trees)
            for row in group:
                if row["kind"]:
                    leaves.append((row["doc_id"], row["tree"], row["size"], row["at"], row["digests"], row["other"]))
                    forest.add(row["tree"], row["size"], 0, row["at"], row["digests"])
                else:
                    paths.runs[row["tree"], row["level"], row["at"]] = row["digests"]
            for tree, _, level, at, together in forest.done:
                paths.runs[tree, level, at] = together
            forest, root = None, paths.root()
            for start in range(0, len(leaves), 4096):
                out = []
                for doc_id, tree, size, at, leaf, other in leaves[start : start + 4096]:
                    steps, text, subroot = paths.above(tree, size, 0, at)
                    got = folded(other or leaf, steps)
                    out.append((doc_id, leaf, subroot, root, digest(text), got, got == root))
                    if len(paths.known) > 1 << 14:
                        paths.known.clear()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), ROW_KINDS)], names=ROW_NAMES)

    return rows.mapInArrow(run, ROWS)


def field(value: F.Column) -> F.Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: F.Column) -> F.Column:
    """The leaf of a row whose text is the one given."""
    return F.sha2(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def tampered_rows() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def ordered_leaves(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Leaves with part, tree, size, at; the number of parts and of trees.

    Rows are dealt into ranges of (lang, doc_id, leaf, row number), so that neither a lang nor an id fills a range, and
    numbered by counts of each lang in each range.
    """
    lower = ascii_lower(F.col("text"))
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_of(F.col("text")).alias("leaf"), F.when(tampered_rows(), leaf_of(lower)).alias("other"))
    made = stash(made.withColumn("turn", F.monotonically_increasing_id()))
    rows = made.count()
    parts = max(1, min(partitions(docs.sparkSession), -(-rows // 64)), -(-rows // RANGE))
    order = ["lang", "doc_id", "leaf", "turn"]
    dealt = made.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("turn")
    dealt = stash(dealt.withColumn("turn", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("part", F.shiftright("turn", 33))
    held = stash(dealt.groupBy("part", "lang").agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("from")))
    lang = Window.partitionBy("lang")
    before = F.coalesce(F.sum("n").over(lang.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = held.select("*", before.alias("start"), F.sum("n").over(lang).alias("size"), F.min("part").over(lang).alias("born"))
    born = held.filter("part = born").select("part", "lang", F.row_number().over(Window.partitionBy("part").orderBy("lang")).alias("place"))
    earlier = born.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    earlier = earlier.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("c"))
    named = stash(born.join(earlier, "part").select(F.col("lang").alias("l"), (F.col("c") + F.col("place") - 1).cast("long").alias("tree")))
    found = named.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    held = held.join(named, F.col("lang").eqNullSafe(F.col("l"))).select(F.col("part").alias("p"), F.col("lang").alias("l"), "from", "start", "size", "tree")
    held = stash(held)
    parts = (held.agg(F.max("p").alias("p")).first()["p"] or 0) + 1
    placed = dealt.join(held, (F.col("part") == F.col("p")) & F.col("lang").eqNullSafe(F.col("l")))
    at = (F.col("start") + F.col("turn") - F.col("from")).cast("long").alias("at")
    return placed.select("part", "tree", "size", F.lit(0).alias("level"), at, F.col("leaf").alias("digests"), "doc_id", "other"), parts, found


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of docs: leaf, subroot, root, proof_sha256, folded_root and whether it verifies."""
    leaves, parts, trees = ordered_leaves(docs)
    first, runs = reduced(leaves.drop("doc_id", "other"), parts, trees)
    wanted = ways(first, trees)
    outside = wanted.join(runs, ["tree", "level", "at"]).select("part", F.lit(0).alias("kind"), "tree", "size", "level", "at", "digests", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"))
    inside = leaves.withColumn("kind", F.lit(1))
    return _proofs(_by_part(outside.unionByName(inside), parts, "kind", "tree", "level", "at"), trees)


def _levels(name: str, depth: int) -> str:
    """CTEs name0 to name<depth>: nodes of trees ``t`` by index ``i``, with what stands before and after each in its run."""
    run = "OVER (PARTITION BY t, i // 8 ORDER BY i ROWS BETWEEN"
    out = []
    for k in range(depth):
        out.append(
            f"{name}s{k} AS (SELECT *, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre, "
            f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post FROM {name}{k})"
        )
        out.append(f"{name}{k + 1} AS (SELECT t, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (n + 7) // 8 AS n FROM {name}{k} GROUP BY t, i // 8, n)")
    return ", ".join(out)


def _climb(source: str, name: str, nodes: str, depth: int) -> str:
    """CTEs name0 to name<depth>: rows of source climb the trees of ``nodes``."""
    out = [f"{name}0 AS ({source})"]
    for k in range(depth):
        out.append(
            f"{name}{k + 1} AS (SELECT r.* REPLACE (r.i // 8 AS i, CASE WHEN n > 1 THEN sha256(pre || cur || post) ELSE cur END AS cur, "
            f"CASE WHEN n > 1 THEN proof || pre || post ELSE proof END AS proof) FROM {name}{k} r JOIN {nodes}s{k} s ON r.t = s.t AND r.i = s.i)"
        )
    return ", ".join(out)


_FIELD = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = " || ".join(_FIELD.format(name) for name in FIELDS)
_DEPTH = 7

#: The same for trees of at most 8**7 leaves.
ORACLE = f"""
WITH {CRC},
d AS (SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_LEAF.replace("text", _LOWER)}) AS lowered, {crc32("doc_id")} % 3 = 0 AS hit FROM documents, crc),
m AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM d)),
p AS (SELECT d.*, m.t, row_number() OVER (PARTITION BY m.t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY m.t) AS n FROM d JOIN m ON d.lang IS NOT DISTINCT FROM m.lang),
x0 AS (SELECT t, i, leaf AS h, n FROM p), {_levels("x", _DEPTH)},
y0 AS (SELECT 0 AS t, t AS i, h, (SELECT count(*) FROM m) AS n FROM x{_DEPTH}), {_levels("y", _DEPTH)},
{_climb("SELECT doc_id, leaf, CASE WHEN hit THEN lowered ELSE leaf END AS cur, '' AS proof, t, t AS tree, i FROM p", "r", "x", _DEPTH)},
{_climb(f"SELECT r.* REPLACE (0 AS t, tree AS i), h AS subroot FROM r{_DEPTH} r JOIN x{_DEPTH} x ON r.t = x.t", "s", "y", _DEPTH)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = h AS verified FROM s{_DEPTH}, y{_DEPTH}
"""

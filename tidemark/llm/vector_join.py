"""Exact cosine join of vectors as a metric range join.

Unit vectors at a cosine of c or more are at a distance of r = sqrt(2 - 2c) or less. Among vectors of one label and
one length, pivots picked by hash cut the space into cells, each vector being at home with its nearest pivot. If x
is at home in p and y in q, and the two are within r, then d(y, p) <= d(y, q) + 2r and d(y, p) <= r + the radius of p:
a vector is replicated to the cells of lower number that pass both tests, so that each pair meets once. A cell's
vectors are dealt into parts of bounded size, and pairs of parts are joined independently by a matrix product in
double precision; the range tests have a margin, so rounding loses no pair.

Equal vectors are joined once, as a class with its size: copies are counted, never paired.

Defined results: a vector that is null, empty, zero or holds a null or a non-finite component, or whose label is null,
links with nothing, as do vectors of different lengths; repeated rows of a vec_id are one vector, its smallest label
and embedding, and each gets that vector's row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import stash

#: Vectors for each pivot, about, and most vectors in one part of a unit.
PER_PIVOT, PART = 1024, 512
#: Size of all pivots together at most: they are shared out over the labels by size and sent to every task.
PIVOT_BYTES = 16 << 20
#: Distances that a task holds at a time.
DISTANCES = 1 << 21
MARGIN = 1e-6
KEY = ["label", "dims"]
CELL = [*KEY, "cell"]


def matrix(column) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def scaled(rows: np.ndarray) -> np.ndarray:
    return rows / np.abs(rows).max(1, keepdims=True)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = scaled(a), scaled(b)
    return (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])


def usable(vectors: DataFrame) -> DataFrame:
    """The vectors that can link, once each: vec_id, label, dims, embedding."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0))
    rows = rows.filter(F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", F.size("v.embedding").alias("dims"), "v.embedding")


def pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots as unit rows by (label, dims), where there are two or more; together at most PIVOT_BYTES."""
    sizes = classes.groupBy(KEY).agg(F.count(F.lit(1)).alias("size"))
    total = classes.agg(F.count(F.lit(1)).alias("n"), F.max("dims").alias("dims")).first()
    most = PIVOT_BYTES // (8 * (total["dims"] or 1))
    share = F.floor(F.col("size") * F.lit(most) / F.lit(max(1, total["n"])))
    counts = sizes.select(*KEY, F.least(F.ceil(F.col("size") / F.lit(PER_PIVOT)), share).cast("long").alias("k")).filter("k > 1")
    slot, at = F.pmod(F.xxhash64("rep"), F.col("k")), F.xxhash64("rep", F.lit(7))
    picked = classes.join(stash(counts), KEY).groupBy(*KEY, slot.alias("slot")).agg(F.min_by("embedding", at).alias("embedding"))
    out: dict[tuple, list] = {}
    for row in sorted(picked.collect(), key=lambda r: r["slot"]):
        out.setdefault((row["label"], row["dims"]), []).append(row["embedding"])
    return {key: unit(np.array(rows, np.float64)) for key, rows in out.items()}


def by_key(batch: pa.RecordBatch):
    """Key and row numbers of each label and length in a batch."""
    rows: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist())):
        rows.setdefault(key, []).append(i)
    return rows.items()


def distances(batch: pa.RecordBatch, at: list[int], marks: np.ndarray):
    """Rows and their distances from all pivots, a bounded number of distances at a time."""
    step = max(1, DISTANCES // len(marks))
    for start in range(0, len(at), step):
        own = np.array(at[start : start + step])
        yield own, np.sqrt(np.maximum(2 - 2 * (unit(matrix(batch.column("embedding").take(pa.array(own)))) @ marks.T), 0))


def at_home(classes: DataFrame, marks) -> DataFrame:
    """Adds cell, the number of the nearest pivot, and far, the distance from it; without pivots cell 0 takes all."""

    def run(batches):
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for key, at in by_key(batch):
                if key in marks.value:
                    for own, d in distances(batch, at, marks.value[key]):
                        cell[own], far[own] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return classes.mapInArrow(run, f"{_ddl(classes)}, cell int, far double")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def placed(homes: DataFrame, marks, radii, reach: float) -> DataFrame:
    """Every vector in its home cell, and as a guest in the lower cells that could hold a partner."""
    kept = ["rep", "label", "dims", "embedding", "copies"]

    def run(batches):
        for batch in batches:
            rows, cells, guest = [np.arange(batch.num_rows)], [batch.column("cell").to_numpy()], [np.zeros(batch.num_rows, bool)]
            for key, at in by_key(batch):
                if key in marks.value:
                    for own, d in distances(batch, at, marks.value[key]):
                        near = (d <= d.min(1, keepdims=True) + 2 * reach + MARGIN) & (d <= radii.value[key][None, :] + reach + MARGIN)
                        i, p = np.nonzero(near & (np.arange(d.shape[1])[None, :] < cells[0][own][:, None]))
                        rows.append(own[i]), cells.append(p.astype(np.int32)), guest.append(np.ones(len(i), bool))
            take = batch.select(kept).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([*take.columns, pa.array(np.concatenate(cells)), pa.array(np.concatenate(guest))], names=[*kept, "cell", "guest"])

    return homes.mapInArrow(run, f"{_ddl(homes.select(kept))}, cell int, guest boolean")


def units(every: DataFrame) -> DataFrame:
    """Rows by unit (kind, i, j) of a cell: side 0 meets side 1, or itself where no row has side 1."""
    parts = lambda kind: F.ceil(F.sum(F.when(kind, 1).otherwise(0)) / F.lit(PART)).cast("long")
    counts = stash(every.groupBy(CELL).agg(parts(~F.col("guest")).alias("home_parts"), parts(F.col("guest")).alias("guest_parts")))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("guest"), F.col("guest_parts")).otherwise(F.col("home_parts")))
    numbered = every.join(counts, CELL).withColumn("part", own)
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<long>"))
    place = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    part = F.col("part")
    among = F.transform(upto("home_parts"), lambda x: place("home", F.least(part, x), F.greatest(part, x), part > x))
    hosts = F.transform(upto("guest_parts"), lambda x: place("guest", part, x, F.lit(0)))
    visits = F.transform(upto("home_parts"), lambda x: place("guest", x, part, F.lit(1)))
    return numbered.withColumn("u", F.explode(F.when(F.col("guest"), visits).otherwise(F.concat(among, hosts)))).select(*CELL, "u.*", "rep", "copies", "embedding")


def joined(rows: DataFrame, least: float) -> DataFrame:
    """rep, links (partners in the unit, copies counted) and root (smallest rep reached in the unit) of linked vectors."""

    def run(table):
        side, rep, copies = (table.column(c).to_numpy() for c in ("side", "rep", "copies"))
        vectors, a, b = matrix(table.column("embedding")), np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(b) and table.column("kind")[0].as_py() == "home" and table.column("i")[0] == table.column("j")[0]
        b = a if alone else b
        near = cosines(vectors[a], vectors[b]) >= least
        near = np.triu(near, 1) if alone else near
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, a, near @ copies[b])
        np.add.at(links, b, copies[a] @ near)
        i, j = np.nonzero(near)
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for x, y in zip(rep[a[i]].tolist(), rep[b[j]].tolist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        hit = np.flatnonzero(links)
        return pa.table({"rep": pa.array(rep[hit]), "links": pa.array(links[hit]), "root": pa.array([root(x) for x in rep[hit].tolist()], pa.int64())})

    return rows.groupBy(*CELL, "kind", "i", "j").applyInArrow(run, "rep long, links long, root long")


def link_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors."""
    spark = vectors.sparkSession
    single = stash(usable(vectors))
    classes = stash(single.groupBy(*KEY, "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).select("rep", *KEY, "embedding", "copies"))
    reach = float(np.sqrt(2 - 2 * least))
    chosen = pivots(classes)
    marks = spark.sparkContext.broadcast(chosen)
    homes = stash(at_home(classes, marks))
    radii = {key: np.zeros(len(rows)) for key, rows in chosen.items()}
    if chosen:
        for r in homes.filter("far > 0").groupBy(CELL).agg(F.max("far").alias("far")).collect():
            radii[r["label"], r["dims"]][r["cell"]] = r["far"]
    found = stash(joined(units(stash(placed(homes, marks, spark.sparkContext.broadcast(radii), reach))), least))
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = classes.select("rep", "copies").join(totals, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    known = stash(known.select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c")))
    member = single.join(stash(classes.select(*KEY, "embedding", "rep")), [*KEY, "embedding"]).select(F.col("vec_id").alias("id"), "rep")
    result = stash(stash(member).join(known, "rep").select("id", "n", "c"))
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(result, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("c", "vec_id")
    return every.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS MATERIALIZED (
  SELECT a.vec_id AS i, b.vec_id AS j FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), links AS MATERIALIZED (SELECT i, j FROM p UNION ALL SELECT j, i FROM p),
r AS (SELECT DISTINCT i AS vec_id, i AS reached FROM links UNION SELECT r.vec_id, links.j FROM r JOIN links ON links.i = r.reached),
c AS (SELECT vec_id, min(reached) AS low FROM r GROUP BY vec_id), n AS (SELECT i AS vec_id, count(*) AS n FROM links GROUP BY i)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.low, e.vec_id) AS component_id, coalesce(c.low, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN c ON c.vec_id = e.vec_id LEFT JOIN n ON n.vec_id = e.vec_id
"""

"""Language identification by a blended-spectrum string kernel.

A text's features are the character n-grams (n = 1 to 3, lower-cased, hashed to a fixed number of buckets) that occur
in it at all; the kernel of two texts is the size of the intersection over the geometric mean of the two sizes. A
Nyström map over landmark texts turns kernel values into features, on which one-versus-rest kernel ridge regression is
solved in closed form. Texts are scored in batches: presence matrix x landmarks x weights, three matrix products.

The fit takes a bounded sample: from each learned language at most PER_LANGUAGE texts, picked by a hash of doc_id in
an aggregation that combines before it shuffles. Their features (a fixed number of bytes each), never their texts,
reach the driver: one row for each language and hash bucket, however often a doc_id repeats. All languages are learned;
they share out MARKS landmarks, and a table with more languages than that is refused with an error.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing
to learn from; labels that are null are not learned; repeated rows give repeated results; an empty table no rows.
``keep_known`` rejects what is ``und`` and what scores under ``least``; with nothing to learn from there is no score,
and it keeps every text that has a letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stash

#: Most training texts of a language; most landmarks of a language and of all languages together.
PER_LANGUAGE, LANDMARKS, MARKS = 384, 48, 4096
#: Most training texts of all languages together, at least one each; characters in a piece.
SAMPLE, PIECE = 1 << 16, 512
BUCKETS = 1 << 13
GRAMS = (1, 2, 3)
RIDGE = 1e-2
#: Scale of the scores before they are made to sum to 1.
SHARPNESS = 8.0
UNKNOWN = "und"
ROWS, BYTES = 64, 1 << 19


def presence(texts: list[str]) -> np.ndarray:
    """Row i, bucket j: 1 if an n-gram of text i falls into bucket j."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(out, texts):
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        rolled = np.zeros(len(code), np.uint32)
        for n in GRAMS:
            if len(code) < n:
                break
            rolled = rolled[: len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1 :]
            mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
            row[(mixed >> np.uint32(19)).astype(np.intp)] = 1
    return out


def pieces(text: str) -> list[str]:
    """The text cut into equal pieces of at most PIECE characters."""
    size = -(-len(text) // max(1, -(-len(text) // PIECE)))
    return [text[i : i + size] for i in range(0, len(text), size)] if text else [""]


@dataclass
class Model:
    """classes: learned languages in order; landmarks: presence x landmark; weights: landmark x class."""

    classes: list[str]
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        size = np.maximum(rows.sum(1, keepdims=True), 1)
        return (rows @ self.landmarks) / np.sqrt(size * self.norms)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        raw = SHARPNESS * (self.kernel(rows).astype(np.float64) @ self.weights)
        raw = np.exp(raw - raw.max(1, keepdims=True))
        return raw / raw.sum(1, keepdims=True)


    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and score of each text, which are read whole."""
        cut = [pieces(t) for t in texts]
        owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        flat = [p for c in cut for p in c]
        every, sure = np.zeros((len(cut), len(self.classes))), np.zeros((len(cut), len(self.classes)))
        for start in range(0, len(flat), ROWS):
            part, own = flat[start : start + ROWS], owner[start : start + ROWS]
            found = self.scores(presence(part)) * np.array([max(1, len(p)) for p in part], float)[:, None]
            np.add.at(every, own, found)
            decided = found.max(1) >= 0.5 * found.sum(1)
            np.add.at(sure, own[decided], found[decided])
        best = np.where(sure.any(1)[:, None], sure, every).argmax(1)
        return best, every[np.arange(len(cut)), best] / every.sum(1)


def unpacked(rows: np.ndarray) -> np.ndarray:
    """Presence rows as numbers; bytes hold eight buckets each."""
    return np.unpackbits(rows, axis=1).astype(np.float32) if rows.dtype == np.uint8 else rows


def solve(features: np.ndarray, langs: list[str]) -> Model | None:
    """Closed-form fit; features: presence rows in a fixed order, as numbers or packed. Rows are unpacked in batches."""
    classes = sorted(set(langs))
    if not classes:
        return None
    if len(classes) > MARKS:
        raise ValueError(f"{len(classes)} languages: at most {MARKS} can be learned")
    y = np.array([classes.index(x) for x in langs])
    each = min(LANDMARKS, max(1, MARKS // len(classes)))
    chosen = np.concatenate([np.flatnonzero(y == c)[:each] for c in range(len(classes))])
    marks = unpacked(features[chosen])
    model = Model(classes, np.ascontiguousarray(marks.T), np.maximum(marks.sum(1), 1)[None, :], np.zeros((len(chosen), len(classes))))
    value, vector = np.linalg.eigh(model.kernel(marks).astype(np.float64))
    keep = value > 1e-6 * value.max()
    to_space = vector[:, keep] / np.sqrt(value[keep])
    share = np.bincount(y, minlength=len(classes))
    gram, right = RIDGE * np.eye(to_space.shape[1]), np.zeros((to_space.shape[1], len(classes)))
    for start in range(0, len(y), 1024):
        own = y[start : start + 1024]
        space = model.kernel(unpacked(features[start : start + 1024])).astype(np.float64) @ to_space
        weight = (1.0 / share[own])[:, None]
        target = np.where(np.arange(len(classes))[None, :] == own[:, None], 1.0, -1.0) if len(classes) > 1 else np.ones((len(own), 1))
        gram += space.T @ (space * weight)
        right += space.T @ (target * weight)
    model.weights = to_space @ np.linalg.solve(gram, right)
    return model


def has_letter(text) -> F.Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """docs: doc_id, text, lang of the rows to learn from."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & has_letter(F.col("text")))
    learned = stash(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(MARKS).select("lang"))
    per_language = max(1, min(per_language, SAMPLE // max(1, learned.count())))
    usable = usable.join(F.broadcast(learned), "lang", "left_semi")
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(per_language)).alias("b")
    at = F.struct(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    picks = usable.groupBy("lang", bucket).agg(F.min_by("doc_id", at).alias("doc_id"))
    picks = stash(picks)  # at most per_language rows a language

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows = np.packbits(presence(part.column(2).to_pylist()).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "b", "seen"])

    count = F.ceil(F.char_length("text") / PIECE)
    size = F.ceil(F.char_length("text") / count).cast("int")
    piece = F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(2)), count) * size + 1).cast("int"), size)
    piece = F.when(has_letter(piece), piece).otherwise(F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{PIECE - 1}}}", 0))
    rows = usable.join(picks.hint("broadcast") if picks.count() * 32 < 8 << 20 else picks, ["lang", "doc_id"]).select("lang", "b", piece.alias("text"))
    made = rows.mapInArrow(features, "lang string, b long, seen binary").groupBy("lang", "b").agg(F.min("seen").alias("seen"))
    found = sorted(made.collect())
    bits = np.frombuffer(b"".join(r["seen"] for r in found), np.uint8).reshape(-1, BUCKETS // 8)
    return solve(bits, [r["lang"] for r in found])


def predict(texts: DataFrame, model: Model | None) -> DataFrame:
    """Adds lang_pred and score to rows doc_id, held_out, text, and leaves the text out."""
    handed = texts.sparkSession.sparkContext.broadcast(astuple(model) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*handed.value) if handed.value else None
        for batch in batches:
            known = batch.column(2).to_numpy(zero_copy_only=False)
            lang, score = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            at = np.flatnonzero(known) if fitted else []
            for start in range(0, len(at), ROWS):
                rows = at[start : start + ROWS]
                best, score[rows] = fitted.judge(batch.column(3).take(pa.array(rows)).to_pylist())
                lang[rows] = np.array(fitted.classes, dtype=object)[best]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return texts.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; fits on the rows that are not held out unless given a model."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = model or train(rows.filter(~F.coalesce(held_out(), F.lit(False))))
    texts = rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), has_letter(F.col("text")).alias("known"), F.coalesce("text", F.lit("")).alias("text"))
    return predict(texts, model)


def keep_known(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """docs without those whose language is unknown or scored under ``least``; all columns stay.

    A score is the share of the predicted language among all: over 1/2 it outweighs the others together.
    """
    model = train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(~F.coalesce(held_out(), F.lit(False))))
    handed, at_text = docs.sparkSession.sparkContext.broadcast(astuple(model) if model else None), docs.columns.index("text") + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*handed.value) if handed.value else None
        for batch in batches:
            known = batch.column(0).to_numpy(zero_copy_only=False)
            at, keep = np.flatnonzero(known), []
            if not fitted:
                at, keep = at[:0], [at]
            for start in range(0, len(at), ROWS):
                rows = at[start : start + ROWS]
                keep.append(rows[fitted.judge(batch.column(at_text).take(pa.array(rows)).to_pylist())[1] >= least])
            chosen = np.concatenate(keep) if keep else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(chosen, pa.int64())) for c in batch.columns[1:]], names=batch.schema.names[1:])

    marked = docs.select(has_letter(F.col("text")).alias("__td_known"), *[F.col(c) for c in docs.columns])
    return marked.mapInArrow(run, docs.schema)

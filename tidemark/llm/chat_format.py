"""Roles of transcript lines by a hidden Markov model, and turns in one canonical rendering.

Hidden states are the roles. What is observed of a line: whether it opens a row or has a speaker marker, the marker's
role, its length, whether it asks, and how many lines follow it up to the next opening; a marker is evidence, not a
verdict. Transitions differ between lines that open (4 x 3, the fourth row being the start of a conversation) and lines
that go on (3 x 3). Both tables are counts over the labelled rows of conversations whose crc32(conv_id as text) mod 4 is
not 2, added to pseudo-counts that prefer the marker's role and let lines go on in their role; transitions are counted
within segments. The role column is never an input of a prediction.

The most likely roles are found by Viterbi's algorithm, exactly, without holding a conversation in one task: rows are
cut into segments of BLOCK turns. Conversations of one segment are decoded at once. Of others, each segment gives the
4 x 3 matrix of its best scores from role to role; these are multiplied (maximum for sum, sum for product) in a tree
with FAN children a node, the best roles at all joints are handed down the tree, and each segment is decoded between
its own two. A single row is read whole.

A turn is a run of lines with one role inside a row; it opens at a marker or where the role changes. It is rendered as
``<|im_start|>role`` and the content, without its marker, up to ``<|im_end|>``, and each turn is a row of the result.

Defined results: null and empty texts are one empty line and give a turn without content; rows with equal conv_id, turn
and text are one row with its number of copies; rows of one turn are ordered by a hash of the text; a null turn comes
at -1, and rows without conv_id are one conversation; an empty table gives no rows. Roles other than those of ALIASES
count as no label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import partitions, stash

ROLES = ("system", "user", "assistant")
ALIASES = {
    "system": 0, "instruction": 0, "user": 1, "human": 1, "prompter": 1, "customer": 1, "question": 1, "q": 1,
    "assistant": 2, "ai": 2, "bot": 2, "model": 2, "agent": 2, "gpt": 2, "answer": 2, "a": 2,
}
NAMES = "|".join(sorted(ALIASES, key=len, reverse=True))
#: ``Name:`` with ornaments around it, or a name alone in brackets or after number signs.
MARKER = re.compile(rf"(?ai)\s*(?:(?:<\|im_start\|>|[#*\[<|(]+)?\s*({NAMES})\s*[\]*|>)]*\s*:[*]*[ \t]*|(?:<\|im_start\|>|<\||\[|\#{{2,}})\s*({NAMES})\s*(?:\|>|\])?[ \t]*(?:\n|$))")
CLOSING = re.compile(r"\s*<\|im_end\|>\s*$")
LENGTHS = (1, 40, 120, 400)
SYMBOLS = 2 * 4 * 5 * 2 * 4
START = 3
BLOCK, CROWDED, FAN = 64, 4096, 64
ROWS_A_DEAL = 20_000
#: Pseudo-counts: of each symbol, of a marker's own role, of each transition, of going on in a role.
FEW, MARKED, STEP, STAY = 0.1, 5.0, 1.0, 100.0


def role_of(text: str) -> tuple[int | None, str]:
    """The role that a line's marker names, and what follows the marker."""
    found = MARKER.match(text)
    return (ALIASES[(found[1] or found[2]).lower()], text[found.end() :]) if found else (None, text)


def line_codes(text: str) -> list[int]:
    """A number for each line: what the model observes of it."""
    lines = text.split("\n")
    marks = [role_of(line) for line in lines]
    opens = [i == 0 or m is not None for i, (m, _) in enumerate(marks)]
    out, after = [0] * len(lines), 0
    for i in range(len(lines) - 1, -1, -1):
        mark, rest = marks[i]
        long = sum(len(rest) >= n for n in LENGTHS)
        out[i] = (((opens[i] * 4 + (0 if mark is None else mark + 1)) * 5 + long) * 2 + rest.rstrip().endswith(("?", "？"))) * 4 + min(3, after.bit_length())
        after = 0 if opens[i] else after + 1
    return out


def opening(codes: np.ndarray) -> np.ndarray:
    return codes >= SYMBOLS // 2


def marker(codes: np.ndarray) -> np.ndarray:
    """0 for no marker, else its role and 1."""
    return codes // 40 % 4


# The model


def tables(counts: dict[tuple[int, int, int], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logarithms: transitions at openings (4 x 3) and within (3 x 3), and emissions (3 x SYMBOLS).

    counts: (0, role before or START, role), (1, role before, role) and (2, role, symbol).
    """
    first, within, seen = np.full((4, 3), STEP), np.full((3, 3), FEW) + STAY * np.eye(3), np.full((3, SYMBOLS), FEW)
    mark = marker(np.arange(SYMBOLS))
    for r in range(3):
        seen[r, mark == r + 1] += MARKED
    for (kind, i, j), n in counts.items():
        (first, within, seen)[kind][i, j] += n
    return tuple(np.log(x / x.sum(1, keepdims=True)) for x in (first, within, seen))


def forward(codes, starts, lengths, model, entry: np.ndarray):
    """Best scores at the end of each segment, by the entries given (segments x entries), and the choices on the way."""
    first, within, seen = model
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    emit, is_open = seen.T[codes], opening(codes)
    best = first[entry[order]] + emit[starts][:, None, :]
    back = np.zeros((len(codes), entry.shape[1], 3), np.int8)
    for t in range(1, int(lengths[0]) if len(lengths) else 0):
        live = np.searchsorted(-lengths, -t, side="left")  # those longer than t
        at = starts[:live] + t
        step = np.where(is_open[at][:, None, None], first[None, :3], within[None])
        tried = best[:live, :, :, None] + step[:, None]
        back[at] = tried.argmax(2)
        best[:live] = tried.max(2) + emit[at][:, None, :]
    out = np.empty_like(best)
    out[order] = best
    return out, back


def decode(codes, starts, lengths, model, entry: np.ndarray, leave: np.ndarray) -> np.ndarray:
    """The most likely role of each line, given the role before each segment and, unless -1, its last one."""
    best, back = forward(codes, starts, lengths, model, entry[:, None])
    now = np.where(leave >= 0, leave, best[:, 0].argmax(1))
    roles = np.zeros(len(codes), np.int8)
    order = np.argsort(-lengths, kind="stable")
    s, n, now = starts[order], lengths[order], now[order]
    for t in range(int(n[0]) - 1 if len(n) else -1, -1, -1):
        live = np.searchsorted(-n, -t, side="left")
        at = s[:live] + t
        goes_on = n[:live] > t + 1
        now[:live] = np.where(goes_on, back[np.minimum(at + 1, len(codes) - 1), 0, now[:live]], now[:live])
        roles[at] = now[:live]
    return roles


def compose(matrices: list[np.ndarray]) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None, :3]).max(1)
    return out


def joints(matrices: list[np.ndarray], entry: int, leave: int) -> list[tuple[int, int]]:
    """The role before and the last role of each of a chain of segments."""
    best, back = matrices[0][entry], []
    for m in matrices[1:]:
        tried = best[:, None] + m[:3]
        back.append(tried.argmax(0))
        best = tried.max(0)
    last = [leave if leave >= 0 else int(best.argmax())]
    for choice in reversed(back):
        last.insert(0, int(choice[last[0]]))
    return list(zip([entry, *last[:-1]], last))


# The tables

SEGMENT = ["conv", "block", "t", "sub"]


def coded(rows: DataFrame) -> DataFrame:
    """Distinct rows with their lines' codes and their places; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.array(line_codes(x), np.uint16).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blobs, pa.binary())], names=[*batch.schema.names, "codes"])

    clean = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.lower("role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    label = F.lit(None).cast("int")
    for name, r in ALIASES.items():
        label = F.when(F.col("role") == name, r).otherwise(label)
    each = clean.withColumn("label", label).groupBy("conv_id", "turn", "text").agg(F.count(F.lit(1)).alias("copies"), F.min("label").alias("label"))
    conv, at, h = F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce("turn", F.lit(-1)), F.xxhash64("text", "turn", "conv_id")
    placed = each.withColumns({"conv": conv, "at": at, "h": h, "place": F.pmod(h, F.lit(1 << 31)), "block": F.floor(at / F.lit(BLOCK)).cast("long")})
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    made = stash(placed.mapInArrow(run, f"{kept}, codes binary"))
    crowded = stash(made.groupBy("conv", "block").count().filter(F.col("count") > CROWDED))
    none = {"t": F.lit(0).cast("long"), "sub": F.lit(0).cast("long")}
    if crowded.isEmpty():
        return made.withColumns(none)
    parts = F.ceil(F.col("count") / F.lit(CROWDED)).cast("long")
    many = made.join(crowded, ["conv", "block"], "left")
    t, sub = F.when(F.col("count").isNotNull(), F.col("at")), F.floor(F.col("place") * parts / F.lit(1 << 31)).cast("long")
    return many.withColumns({"t": F.coalesce(t, none["t"]), "sub": F.coalesce(sub, none["sub"])}).drop("count")


def held_out(conv) -> F.Column:
    return F.pmod(F.crc32(conv.cast("binary")), F.lit(4)) == 2


def segments(table: pa.Table) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order; codes of all lines, lines of each row; first row, first line and number of lines of each segment."""
    frame = table.to_pandas().sort_values([*SEGMENT, "at", "place", "h", "turn"], kind="stable", ignore_index=True)
    codes = np.frombuffer(b"".join(frame["codes"]), np.uint16).astype(np.int64)
    lines = frame["codes"].map(len).to_numpy() // 2
    change = (frame[SEGMENT] != frame[SEGMENT].shift()).any(axis=1).to_numpy()
    rows = np.flatnonzero(change)
    first = (np.cumsum(lines) - lines)[rows]
    return frame, codes, lines, rows, first, np.diff(np.append(first, len(codes)))


def learn(rows: DataFrame) -> dict[tuple[int, int, int], int]:
    """Counts for ``tables``: at most a few thousand, whatever the input."""

    def run(table):
        frame, codes, lines, row, _, _ = segments(table)
        owner = np.repeat(np.arange(len(frame)), lines)
        label = frame["label"].fillna(-1).to_numpy().astype(np.int64)
        inner = np.ones(len(codes), bool)
        inner[np.cumsum(lines) - lines] = False
        mixed = np.bincount(owner, inner & (marker(codes) > 0), len(frame)) > 0  # such a row has several speakers
        label[mixed] = -1
        lab = label[owner]
        fresh = np.zeros(len(frame), bool)
        fresh[row] = True
        new_segment = np.zeros(len(codes), bool)
        new_segment[(np.cumsum(lines) - lines)[fresh]] = True
        out = [np.stack([np.full((lab >= 0).sum(), 2), lab[lab >= 0], codes[lab >= 0]])]
        before = np.append(-1, lab[:-1])
        both = (lab >= 0) & (before >= 0) & ~new_segment
        out.append(np.stack([np.where(opening(codes[both]), 0, 1), before[both], lab[both]]))
        begin = fresh & (label >= 0) & (frame["at"].to_numpy() == 0)
        out.append(np.stack([np.zeros(begin.sum(), np.int64), np.full(begin.sum(), START), label[begin]]))
        found, n = np.unique(np.concatenate(out, 1), axis=1, return_counts=True)
        return pa.table({"kind": found[0], "i": found[1], "j": found[2], "n": n})

    known = rows.filter(~held_out(F.col("conv"))).drop("text")
    counts = known.groupBy("deal").applyInArrow(run, "kind long, i long, j long, n long").groupBy("kind", "i", "j").agg(F.sum("n").alias("n"))
    return {(r["kind"], r["i"], r["j"]): r["n"] for r in counts.collect()}


def _matrix(values) -> np.ndarray:
    return np.array(values, float).reshape(4, 3)


def _products(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        return frame.iloc[:1][by].assign(m=[compose([_matrix(x) for x in frame["m"]]).ravel().tolist()])

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in by)
    return rows.groupBy(*by).applyInPandas(run, f"{kinds}, m array<double>")


def _solved(rows: DataFrame, by: list[str], order: list[str], out: list[str]) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        found = joints([_matrix(x) for x in frame["m"]], int(frame["enter"].iloc[0]), int(frame["leave"].iloc[0]))
        return frame[out].assign(enter=[a for a, _ in found], leave=[b for _, b in found])

    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in out)
    return rows.groupBy(*by).applyInPandas(run, f"{kinds}, enter int, leave int")


def _tree(nodes: DataFrame) -> DataFrame:
    """conv, p, enter and leave of nodes conv, p, m; p is a node's place."""
    most = nodes.groupBy("conv").count().agg(F.max("count")).first()[0]
    up = nodes.withColumn("up", F.floor(F.col("p") / F.lit(FAN)).cast("long") if most > FAN else F.lit(0).cast("long"))
    if most <= FAN:
        ends = {"enter": F.lit(START), "leave": F.lit(-1)}
        return stash(_solved(up.withColumns(ends), ["conv", "up"], ["p"], ["conv", "p"]))
    parents = _tree(stash(_products(up, ["conv", "up"], ["p"]).withColumnRenamed("up", "p"))).withColumnRenamed("p", "up")
    return stash(_solved(up.join(parents, ["conv", "up"]), ["conv", "up"], ["p"], ["conv", "p"]))


def segment_ends(rows: DataFrame, model) -> DataFrame | None:
    """enter and leave of the segments of conversations that have several; None if none has."""
    each = stash(rows.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("n")))
    several = stash(each.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1"))
    if several.isEmpty():
        return None

    def run(table):
        frame, codes, _, row, first, n = segments(table)
        m, _ = forward(codes, first, n, model, np.tile(np.arange(4), (len(row), 1)))
        return pa.table({c: pa.array(frame[c].iloc[row]) for c in SEGMENT} | {"m": pa.array(m.reshape(-1, 12).tolist(), pa.list_(pa.float64()))})

    chosen = rows.drop("text").join(several.select("conv"), "conv", "left_semi")
    parts = stash(chosen.groupBy("deal").applyInArrow(run, "conv string, block long, t long, sub long, m array<double>"))
    blocks = _tree(stash(_products(parts, ["conv", "block"], ["t", "sub"]).withColumnRenamed("block", "p"))).withColumnRenamed("p", "block")
    return stash(_solved(parts.join(blocks, ["conv", "block"]), ["conv", "block"], ["t", "sub"], SEGMENT))


def line_roles(rows: DataFrame, model) -> DataFrame:
    """conv, at, h and the roles of a row's lines."""
    ends = segment_ends(rows, model)
    own = rows.drop("text")
    if ends is None:
        known = own.withColumns({"enter": F.lit(START), "leave": F.lit(-1)})
    else:
        known = own.join(ends, SEGMENT, "left").withColumns({"enter": F.coalesce("enter", F.lit(START)), "leave": F.coalesce("leave", F.lit(-1))})

    def run(table):
        frame, codes, lines, row, first, n = segments(table)
        entry, leave = (frame[c].iloc[row].to_numpy() for c in ("enter", "leave"))
        roles = decode(codes, first, n, model, entry, leave).tobytes()
        ends = np.cumsum(lines)
        return pa.table({"conv": pa.array(frame["conv"]), "at": pa.array(frame["at"]), "key": pa.array(frame["h"]), "roles": pa.array([roles[b - k : b] for b, k in zip(ends, lines)], pa.binary())})

    return known.groupBy("deal").applyInArrow(run, "conv string, at long, key long, roles binary")


def turns(text: str, roles: bytes) -> list[tuple[str, str]]:
    """Role and content of the turns of a row."""
    out: list[tuple[int, list[str]]] = []
    for i, (line, role) in enumerate(zip(text.split("\n"), roles)):
        mark, rest = role_of(line)
        if i == 0 or mark is not None or role != out[-1][0]:
            out.append((role, []))
        out[-1][1].append(rest)
    return [(ROLES[r], CLOSING.sub("", "\n".join(lines)).strip()) for r, lines in out]


def rendered(role: str, content: str) -> str:
    return f"<|im_start|>{role}\n{content}<|im_end|>\n"


def render(found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part, role, text = [], [], [], []
            for i, (x, roles) in enumerate(zip(batch.column("text").to_pylist(), batch.column("roles").to_pylist())):
                for p, (r, content) in enumerate(turns(x, roles)):
                    at.append(i), part.append(p), role.append(r), text.append(rendered(r, content))
            rows = batch.select(["conv_id", "turn", "copies", "held_out"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(part, pa.int32()), pa.array(role, pa.string()), pa.array(text, pa.string())], names=[*rows.schema.names, "part", "role_pred", "rendered"])

    kind = found.schema["conv_id"].dataType.simpleString()
    return found.mapInArrow(run, f"conv_id {kind}, turn long, copies long, held_out boolean, part int, role_pred string, rendered string")


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, copies, held_out, part, role_pred and rendered: a row for each turn that was recovered."""
    rows = coded(conversations)
    deals = max(2 * partitions(conversations.sparkSession), rows.count() // ROWS_A_DEAL)
    rows = rows.withColumn("deal", F.pmod(F.xxhash64(*SEGMENT), F.lit(deals)))
    model = tables(learn(rows))
    roles = stash(line_roles(rows, model)).withColumnsRenamed({"conv": "of", "at": "place_of"})
    both = rows.join(roles, (F.col("conv") == F.col("of")) & (F.col("at") == F.col("place_of")) & (F.col("h") == F.col("key")))
    return render(both.select("conv_id", "turn", "copies", held_out(F.col("conv")).alias("held_out"), "text", "roles"))

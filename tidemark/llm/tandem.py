"""Periodic runs of words by the linear method for tandem repeats.

A document's words are named by doubling: the name of 2^k words is that of the pair of its halves, in order, so the names
give the suffix array, and any common extension of two places in a few look-ups. From that, for each document:

1. blocks: the Lempel-Ziv factorization, each block the longest piece that also starts earlier, or one new word;
2. leftmost-covering squares: for each block, and each period that fits it and the next one, the common extensions
   about the block's borders show whether a square (a piece twice in a row) starts there; these squares cover the
   leftmost place of every kind of square;
3. vocabulary: a walk along suffix links, from the place of a square to the next place, as long as the word that
   leaves on the left enters on the right, names every kind of square, each with primitive root;
4. places: the interval of a square in the suffix array has all its occurrences; those of one period at consecutive
   places merge into a run, and a run keeps its least period.

Documents in which no five words occur twice can hold no run that counts and end after the third doubling.

A batch of documents goes through at once, in arrays; words of different documents never have one name.
Two different words share a name with a chance of 2^-64; nothing else here is approximate. Memory goes with the longest
document of a batch, some hundred bytes a word.

Defined results: a null text has no words; a null doc_id is never rewritten; a document without a run has null for the
longest run and the digest of nothing for all runs; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.crc_sql import CRC, crc32
from tidemark.llm.shingles import PLAIN, chunks, mix, word_hashes

#: A run has at least LEAST words and POWER periods.
LEAST, POWER = 6, 4


class Names:
    """names[k][i]: the rank of the 2^k words from i on among all such pieces; equal pieces, and only they, share it.

    order: places by the ranks of the longest pieces; new: the first place of each word; repeated: places of pieces that occur twice.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.n = n = len(words)
        order = np.argsort(words)
        first = np.empty(n, bool)
        first[:1] = True
        first[1:] = words[order[1:]] != words[order[:-1]]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(starts, sizes)
        self.names, self.order, self.new = [rank], order, np.minimum.reduceat(order, starts) if n else starts
        self.repeated = np.sort(order[np.repeat(sizes > 1, sizes)])

    def double(self) -> bool:
        """Adds the names of pieces twice as long; False if no piece occurs twice."""
        at, rank, step = self.repeated, self.names[-1], 1 << (len(self.names) - 1)
        if not len(at):
            return False
        after = np.where(at + step < self.n, rank[np.minimum(at + step, self.n - 1)] + 1, 0)
        order = np.argsort(rank[at] * np.int64(self.n + 1) + after)
        own, after = rank[at][order], after[order]
        group = np.empty(len(at), bool)
        group[0] = True
        group[1:] = own[1:] != own[:-1]
        new = group.copy()
        new[1:] |= after[1:] != after[:-1]
        place = np.arange(len(at))
        offset = place - np.maximum.accumulate(np.where(group, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        ranks, more = own + offset[start], rank.copy()
        more[at[order]] = ranks
        self.order = self.order.copy()
        self.order[own + offset] = at[order]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        self.repeated = np.sort(at[order][np.repeat(sizes > 1, sizes)])
        self.names.append(more)
        return True

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that i and j, different places, have in common from there on."""
        i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            ok = (i < self.n) & (j < self.n)
            ok[ok] = self.names[k][i[ok]] == self.names[k][j[ok]]
            step = ok.astype(np.int64) << k
            i, j, got = i + step, j + step, got + step
        return got

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that i and j, different places, have in common up to and with there."""
        i, j, got = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            back = (1 << k) - 1
            ok = (i >= back) & (j >= back)
            ok[ok] = self.names[k][i[ok] - back] == self.names[k][j[ok] - back]
            step = ok.astype(np.int64) << k
            i, j, got = i - step, j - step, got + step
        return got

    def same(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words (at least one) from i and from j on are equal: two names each."""
        k = np.frexp(size.astype(np.float64))[1] - 1
        ok = (i + size <= self.n) & (j + size <= self.n) & (k < len(self.names))
        out = np.zeros(len(i), bool)
        for level in np.unique(k[ok]):
            at = np.flatnonzero(ok & (k == level))
            name, shift = self.names[level], size[at] - (1 << int(level))
            out[at] = (name[i[at]] == name[j[at]]) & (name[i[at] + shift] == name[j[at] + shift])
        return out | (i == j)


def earlier(names: Names) -> np.ndarray:
    """For each place, the longest piece from there on that also starts earlier."""
    order, n = names.order, names.n
    common = np.zeros(n + 1, np.int64)
    if n > 1:
        common[1:n] = names.ahead(order[1:], order[:-1])
    common[common < 2] = 0
    out = np.ones(n, np.int64)
    out[names.new] = 0
    rows = np.flatnonzero((common[:-1] > 0) | (common[1:] > 0))  # pieces of two words or more; else the word decides
    found, held = [0] * len(rows), []
    for r, (here, least) in enumerate(zip(order[rows].tolist() + [-1], common[rows].tolist() + [0])):
        while held and held[-1][0] > here:
            _, before, row = held.pop()
            found[row] = before if before > least else least
            if before < least:
                least = before
        held.append((here, least, r))
    out[order[rows]] = np.maximum(found, out[order[rows]])
    return out


def blocks(longest: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all blocks, and the end of each one's next block within its document."""
    steps, starts = np.maximum(longest, 1).tolist(), []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        while lo < hi:
            starts.append(lo)
            lo += steps[lo]
    start = np.array(starts, np.int64)
    limit = bounds[np.searchsorted(bounds, start, side="right")] if len(start) else start
    end = np.minimum(start + np.maximum(longest[start], 1), limit)
    following = np.append(end[1:], 0)
    return start, end, np.where(end < limit, np.minimum(following, limit), end)


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row i count[i] times, and 0, 1, ... within each row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def covering(names: Names, start: np.ndarray, end: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and period of squares that cover the leftmost place of every kind."""
    word, found = names.names[0], []
    row, k = _spread(np.where(end < names.n, end - start, 0))  # the right border lies in the right half
    k += 1
    border = end[row]
    same = word[border] == word[border - k]
    k, border = k[same], border[same]
    q = border - k
    right, left = names.ahead(border, q), np.zeros(len(k), np.int64)
    inner = q > 0
    left[inner] = names.behind(border[inner] - 1, q[inner] - 1)
    ok = right + left >= k
    found.append((np.maximum(q - left, q - k + 1)[ok], k[ok]))
    row, k = _spread(following - start)  # the left border lies in the left half
    k += 1
    border = start[row]
    ok = (border + k < names.n) & (border > 0)
    k, border = k[ok], border[ok]
    same = word[border] == word[border + k]
    k, border = k[same], border[same]
    q = border + k
    right, left = names.ahead(border, q), names.behind(border - 1, q - 1)
    ok = right + left >= k
    found.append((np.maximum(border - left, border - k + 1)[ok], k[ok]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def least_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct stretches with the least of their periods, by start, then period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def vocabulary(names: Names, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every kind of square with primitive root, by walks from the covering squares; a walk ends where its kinds repeat."""
    first = place.copy()
    inner = place > 0
    first[inner] -= names.behind(place[inner] - 1, place[inner] + period[inner] - 1)
    last = place + period + names.ahead(place, place + period)
    first, last, period = least_periods(first, last, period)
    row, step = _spread(np.minimum(period, last - first - 2 * period + 1))
    return first[row] + step, period[row]


def located(names: Names, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of all given squares: their intervals in the suffix array, found by halving steps on both sides."""
    inverse = np.empty(names.n, np.int64)
    inverse[names.order] = np.arange(names.n)
    size, low, high = 2 * period, inverse[place], inverse[place]
    for k in range(max(1, names.n).bit_length() - 1, -1, -1):
        step = 1 << k
        to = np.maximum(low - step, 0)
        ok = (low >= step) & names.same(names.order[to], place, size)
        low = np.where(ok, to, low)
        to = np.minimum(high + step, names.n - 1)
        ok = (high + step < names.n) & names.same(names.order[to], place, size)
        high = np.where(ok, to, high)
    key = np.unique(np.stack([low, size], 1), axis=0, return_index=True)[1]
    row, step = _spread((high - low + 1)[key])
    return names.order[low[key][row] + step], period[key][row]


def merged(place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (start, end, period) from places of squares."""
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] - place[:-1] > 1) | (period[1:] != period[:-1])
    keep = np.flatnonzero(new)
    last = np.append(keep[1:], len(place)) - 1
    return least_periods(place[keep], place[last] + 2 * period[keep] if len(place) else place, period[keep])


def runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and least period, by start and period, of all runs that count; words never cross the bounds.

    Equal words have equal numbers within a document and different ones in different documents.
    """
    none = np.empty(0, np.int64)
    names = Names(words)
    while len(names.names) < 3 and names.double():
        pass
    if len(names.names) < 3 or not len(names.repeated):
        return none, none, none
    four, at = names.names[2], names.repeated[names.repeated + 1 < names.n]
    _, index, count = np.unique(np.stack([four[at], four[at + 1]], 1), axis=0, return_inverse=True, return_counts=True)
    docs = np.unique(np.searchsorted(bounds, at[count[index.ravel()] > 1], side="right") - 1)
    if not len(docs):
        return none, none, none
    sizes = bounds[docs + 1] - bounds[docs]
    row, step = _spread(sizes)
    names = Names(words[bounds[docs][row] + step])
    while names.double():
        pass
    own = np.append(0, np.cumsum(sizes))
    start, end, following = blocks(earlier(names), own)
    place, period = covering(names, start, end, following)
    first, last, period = merged(*located(names, *vocabulary(names, place, period)))
    ok = last - first >= np.maximum(LEAST, POWER * period)
    first, last, period = first[ok], last[ok], period[ok]
    shift = (bounds[docs] - own[:-1])[np.searchsorted(own, first, side="right") - 1]
    return first + shift, last + shift, period


def rewritten(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a document that is rewritten, else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g, at = h // 10, np.arange(n)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(at < a, at, a + (at - a) % p)


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long"
KINDS = (*[pa.int64()] * 6, pa.string(), pa.string(), pa.int64())
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def described(doc_id: int | None, words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple:
    """The row of a document with its words and runs."""
    if not len(start):
        return doc_id, 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(), len(words)
    length, best = (end - start).tolist(), 0
    start, period = start.tolist(), period.tolist()
    for i in range(1, len(start)):
        if length[i] * period[best] > length[best] * period[i]:
            best = i
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start, length, period))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, np.array(start) + np.array(period), 1)
    np.add.at(change, end, -1)
    kept = b" ".join(words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist())
    milli = 1000 * length[best] // period[best]
    return doc_id, len(start), start[best], length[best], period[best], milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), len(words)


def periodic(docs: DataFrame, rewrite=rewritten) -> DataFrame:
    """One row per row of docs; ``rewrite`` gives, for an id and a number of words, the words to stand there instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, data, bounds in chunks(batch.column(1)):
                hashes, doc = word_hashes(data, bounds, PLAIN)
                count = np.bincount(doc, minlength=len(bounds) - 1)
                ends = np.append(0, np.cumsum(count))
                which, raw, texts = np.arange(len(hashes)), data.tobytes(), []
                for i in range(len(count)):
                    words, to = raw[bounds[i] : bounds[i + 1]].split(), rewrite(ids[first + i], int(count[i]))
                    if to is not None:
                        which[ends[i] : ends[i + 1]] = ends[i] + to
                        words = [words[k] for k in to.tolist()]
                    texts.append(words)
                start, end, period = runs(mix(hashes[which] + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), ends)
                cut = np.searchsorted(start, ends)
                out = []
                for i, words in enumerate(texts):
                    lo, hi = cut[i], cut[i + 1]
                    out.append(described(ids[first + i], words, start[lo:hi] - ends[i], end[lo:hi] - ends[i], period[lo:hi]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), KINDS)], names=NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


ORACLE = f"""
WITH {CRC},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w, {crc32("doc_id")} AS h FROM documents, crc),
g AS (SELECT r, doc_id, w, len(w) AS n, coalesce(h % 10 = 0, false) AND len(w) > 0 AS changed, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN changed THEN g % n ELSE 0 END AS a FROM g),
p AS (SELECT *, CASE WHEN changed THEN 1 + (n - a) // (3 + g % 8) ELSE n + 1 END AS p FROM a),
t AS (SELECT r, n, i, w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1] AS word FROM (SELECT *, unnest(range(n)) AS i FROM p)),
e AS (SELECT x.r, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * {POWER} <= x.n),
s AS (SELECT r, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e) GROUP BY r, q, k),
u AS (SELECT r, s, l, min(q) AS q FROM s WHERE l >= greatest({LEAST}, {POWER} * q) GROUP BY r, s, l),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) AS place FROM u),
m AS (SELECT r, count(*) AS n_runs, max(CASE WHEN place = 1 THEN s END) AS start, max(CASE WHEN place = 1 THEN l END) AS length, max(CASE WHEN place = 1 THEN q END) AS period,
  max(CASE WHEN place = 1 THEN 1000 * l // q END) AS exponent_milli, sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM o GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM u),
kept AS (SELECT t.r, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t LEFT JOIN gone ON t.r = gone.r AND t.i = gone.i WHERE gone.i IS NULL GROUP BY t.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256, n AS n_words
FROM p LEFT JOIN m ON p.r = m.r LEFT JOIN kept ON p.r = kept.r
"""

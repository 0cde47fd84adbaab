"""Word shingles of whole Arrow batches, as sorted arrays of 64-bit hashes, without a Python loop over words.

A word's hash is the difference of two running sums over its lower-cased bytes, so a batch takes a handful of numpy
passes. Two different shingles of one pair of documents share a hash with a chance of about 2^-64 for each pair of
shingles; nothing else here is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PLAIN = np.arange(256, dtype=np.uint8)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD6E8FEB86659FD93)
CODES = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[base] = np.cumprod(step)
    return have[:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each word; document i is data[bounds[i]:bounds[i + 1]], in UTF-8; bytes count as ``fold`` has them."""
    size = len(data)
    if not size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~SPACE[data]
    before = np.zeros(size, dtype=bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < size]] = False
    after = np.zeros(size, dtype=bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    sums = np.cumsum(CODES[fold[data]] * _powers(BASE, size))
    ahead = np.where(first > 0, sums[first - 1], np.uint64(0))
    words = mix((sums[last] - ahead) * _powers(INVERSE, size)[first] + (last - first).astype(np.uint64))
    return words, np.searchsorted(bounds, first, side="right") - 1


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its k-word shingles; of fewer words, one for the whole sequence."""
    words, doc = word_hashes(data, bounds)
    count = np.bincount(doc, minlength=len(bounds) - 1)
    n = max(0, len(words) - k + 1)
    joined = words[:n].copy()
    for j in range(1, k):
        joined = joined * STEP + words[j : n + j]
    whole = doc[:n] == doc[k - 1 : n + k - 1]
    joined, of = mix(joined[whole]), doc[:n][whole]
    ends, starts = np.searchsorted(of, np.arange(len(count)), side="right"), np.cumsum(count) - count
    out, at = [], 0
    for i, c in enumerate(count):
        if c >= k:
            own = np.sort(joined[at : ends[i]])
            at = ends[i]
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif c:
            one = words[starts[i] : starts[i] + 1].copy()
            for w in words[starts[i] + 1 : starts[i] + c]:
                one = one * STEP + w
            out.append(mix(one ^ np.uint64(c)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Index of the first text, bytes and bounds of runs of texts (without nulls) of about CHUNK_BYTES."""
    if not len(texts):
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + CHUNK_BYTES, side="right")) - 1)
        yield start, data[bounds[start] : bounds[stop]], bounds[start : stop + 1] - bounds[start]
        start = stop

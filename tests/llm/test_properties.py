"""Properties of the pure parts on generated inputs."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import ngram_join, packing, secret_scan, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.text(st.sampled_from("aAbBé漢 \t\n x"), max_size=40), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingle_sets_are_equal_where_the_words_are(texts, k):
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    got = shingles.shingle_sets(np.frombuffer(b"".join(data), np.uint8), bounds, k)
    want = []
    for t in texts:
        words = WORD.findall(t.translate(LOWER))
        want.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set()))
    assert [len(x) for x in got] == [len(x) for x in want]
    for a, x in zip(got, want):
        assert np.all(a[1:] > a[:-1])
        for b, y in zip(got, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


@given(st.integers(1, 200_000), st.sampled_from([8, 256, 2048]))
def test_pieces_cover_a_document(n, length):
    sizes = packing.pieces(n, length)
    assert sum(sizes) == n and all(s & (s - 1) == 0 and s <= length for s in sizes) and sizes == sorted(sizes, reverse=True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 40), max_size=25), min_size=1, max_size=8), st.integers(1, 9))
def test_overlaps_are_exact(sets, columns):
    if not any(sets):
        return
    got = ngram_join.overlaps([np.array(sorted(s), np.uint64) for s in sets], columns)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(a & b)


@settings(max_examples=200, deadline=None)
@given(st.frozensets(st.integers(0, 10_000), min_size=1, max_size=60), st.frozensets(st.integers(0, 10_000), min_size=1, max_size=3), st.frozensets(st.integers(0, 10_000), max_size=3))
def test_similar_sets_share_their_first_shingles(base, plus, minus):
    """The bound that the join rests on: in any common order, similar sets share l of their first n - need + l."""
    num, den = 85, 100
    a, b = sorted(base), sorted((base | plus) - minus)
    both = len(set(a) & set(b))
    if not b or den * both < num * len(set(a) | set(b)):
        return
    for l in (1, 2, 3):
        if l <= min(ngram_join.need(len(x), num, den) for x in (a, b)):
            first = [set(x[: len(x) - ngram_join.need(len(x), num, den) + l]) for x in (a, b)]
            assert len(first[0] & first[1]) >= l


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abAKI1=:' \"0f")).map(lambda t: "token" + t), st.text(st.sampled_from("0123456789abcdef"), min_size=24, max_size=40))
def test_spans_lie_in_the_text_and_do_not_overlap_by_kind(text, run):
    text = text + " " + run
    spans = secret_scan.base_spans(text)
    assert any(kind == 2 for _, kind, _ in spans)
    for kind in range(3):
        own = [(a, b) for a, k, b in spans if k == kind]
        assert all(0 <= a < b <= len(text) for a, b in own) and all(x[1] <= y[0] for x, y in zip(own, own[1:]))

"""Operators on ids that repeat or are missing, whole vocabularies and long texts, against brute force."""

import math
import pydoc_data.topics
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import backoff, language_id, ngram_join, secret_scan


def test_near_copies_without_ids_and_with_repeated_ones(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(None, text("a")), (None, text("b")), (None, text("b") + " more"), (1, text("c")), (5, text("c") + " more"), (5, text("d")), (None, text("c") + " other"), (None, None), (None, " "), (7, text("e")), (7, text("e"))]
    table = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in ngram_join.similar_documents(table, 5, 80, 100).collect()), key=str)
    assert got == sorted([(None, 36, None), (None, 36, None), (None, 37, None), (1, 36, 1), (5, 37, 1), (5, 36, 5), (None, 37, 1), (None, 0, None), (None, 0, None), (7, 36, 7), (7, 36, 7)], key=str)
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(table).collect()]
    b = {text("b"), text("b") + " more"}
    assert len(kept) == 7 and len([t for _, t in kept if t in b]) == 1
    assert {x for x in kept if x[1] not in b} == {(None, text("a")), (1, text("c")), (5, text("d")), (None, None), (None, " "), (7, text("e"))}


def test_novel_spans_on_either_side_short_and_without_digits():
    rng = random.Random(3)
    draw = lambda letters, k: "".join(rng.choices(letters, k=k))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    find = lambda text: [text[a:b] for a, _, b in secret_scan.Novelty().spans(text, secret_scan.base_spans(text))]
    blob = draw(letters + "0123456789", 40)
    assert find(f"x = '{blob}'  # aws secret") == [blob]
    assert find(f"x = '{blob}'" + " y" * 100 + " secret") == []
    assert find(f"call token_live_{blob} now") == [f"token_live_{blob}"]
    short, plain = draw(letters + "0123456789", 14), draw(letters, 40)
    assert find(f"the bearer is {short} today") == [short]
    assert find(f"the bearer is {plain} today") == [plain]
    assert find("the private key and the access token of each user are kept in the settings of the application") == []


@pytest.mark.parametrize("tight", [False, True])
def test_pairs_seen_once_count(spark, monkeypatch, tight):
    if tight:
        for name, value in {"HOT_BITS": 5, "VERY_HOT": 4, "WORDS_A_PARTITION": 150}.items():
            monkeypatch.setattr(backoff, name, value)
    rng = random.Random(8)
    texts = [[f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.choice([1, 2, 30]))] for _ in range(80)] + [["once", "only", "here"]]
    one, two = Counter(w for t in texts for w in t), Counter(p for t in texts for p in zip(t, t[1:]))
    got = backoff.score(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"), least=1).collect()
    assert len(got) == len(texts) and 1 in two.values()
    for r in got:
        t = texts[r["doc_id"]]
        want = math.log(one[t[0]] / sum(one.values())) + sum(math.log(two[u, w] / one[u]) for u, w in zip(t, t[1:]))
        assert r["n_words"] == len(t) and abs(r["log_score"] - want) < 1e-3


def test_words_keep_all_bits_of_their_hash(monkeypatch):
    import pyarrow as pa

    hashes = np.array([7 << 24, (7 << 24) + 1], np.uint64)
    monkeypatch.setattr(backoff, "word_hashes", lambda data, bounds: (hashes, np.array([0, 0])))
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a b"])], names=["doc_id", "text"])
    [(_, _, words)] = backoff.words_of(batch)
    assert words.tolist() == hashes.tolist()


def known_texts(rng, n=240):
    """Labelled texts: sentences of a manual, and made words of three other languages."""
    manual = " ".join(pydoc_data.topics.topics[k] for k in sorted(pydoc_data.topics.topics))
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ein", "ver"], "zz": ["oux", "é", "tion", "eau"]}
    rows = []
    for i in range(n):
        lang = rng.choice([*parts, "en"])
        at = rng.randrange(250_000, len(manual) - 3000)
        rows.append((i, manual[at : at + rng.randrange(100, 3000)] if lang == "en" else " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(5, 400))), lang))
    return manual, rows


def test_language_does_not_change_with_the_length(spark):
    rng = random.Random(4)
    manual, rows = known_texts(rng)
    noise = "".join(rng.choices("qxjzwvkbfgpyhcumldrsniotae0123456789+/", k=100_000))
    long = {1000 + k: manual[:k] for k in (500, 2000, 10_000, 50_000, 200_000, len(manual))}
    other = {1_000_000 + k: " ".join(t for _, t, x in rows if x == "zz")[:k] for k in (1000, 20_000, 200_000)}
    noisy = {5_000_000 + k: manual[1000:2000] + noise[: 1000 * k] for k in (1, 10, 100)}
    mixed = {6_000_000: " ".join(t for _, t, x in rows if x == "xx")[:9000] + " ".join(t for _, t, x in rows if x == "zz")[:9000]}
    new = [(i, t, None) for part in (long, other, noisy, mixed) for i, t in part.items()]
    table = spark.createDataFrame(rows + new, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in language_id.identify(table).collect()}
    assert all(got[i]["lang_pred"] == "en" and got[i]["score"] >= 0.5 for i in long)
    assert all(got[i]["lang_pred"] == "zz" and got[i]["score"] >= 0.5 for i in other)
    assert {got[i]["lang_pred"] for i in noisy} == {"en"}
    kept = {r["doc_id"] for r in language_id.keep_known(table, 0.6).collect()}
    assert kept >= {*long, *other} and not kept & {*mixed}


def test_pieces_are_the_whole_text():
    for n in (0, 1, 511, 512, 513, 1024, 1025, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        cut = language_id.pieces(text)
        assert "".join(cut) == text and all(len(p) <= language_id.PIECE for p in cut) and max(map(len, cut)) - min(map(len, cut)) <= len(cut)


def test_rare_labels_are_not_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MARKS", 3)
    monkeypatch.setattr(language_id, "SAMPLE", 60)
    rows = known_texts(random.Random(5), 200)[1] + [(500 + i, f"odd label {i}", f"l{i}") for i in range(40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    count = Counter(x for _, _, x in rows)
    assert model.classes == sorted(sorted(count, key=lambda x: (-count[x], x))[:3])

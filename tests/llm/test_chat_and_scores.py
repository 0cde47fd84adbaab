"""Transcript roles against plain Viterbi and held-out labels; stupid backoff against plain counts."""

import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import backoff, chat_format

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CHATS = "conv_id long, turn long, role string, text string, rendered string"
SF = "/root/testdata/sf0.01"

# Roles


def some_model(seed=0):
    rng = np.random.default_rng(seed)
    return tuple(np.log(rng.dirichlet(np.ones(n), m)) for m, n in ((4, 3), (3, 3), (3, chat_format.SYMBOLS)))


def best_path(codes, model):
    first, within, seen = model

    def worth(path):
        total, before = 0.0, chat_format.START
        for c, r in zip(codes, path):
            total += (first if before == 3 or c >= chat_format.SYMBOLS // 2 else within)[before, r] + seen[r, c]
            before = r
        return total

    return max(itertools.product(range(3), repeat=len(codes)), key=worth)


def test_decoding_is_viterbi():
    rng, model = np.random.default_rng(1), some_model()
    lengths = np.array([1, 5, 3, 7, 1, 6])
    codes = rng.integers(0, chat_format.SYMBOLS, lengths.sum())
    starts = np.cumsum(lengths) - lengths
    got = chat_format.decode(codes, starts, lengths, model, np.full(6, chat_format.START), np.full(6, -1))
    for s, n in zip(starts, lengths):
        assert tuple(got[s : s + n]) == best_path(codes[s : s + n], model)


def test_joints_of_segments_lie_on_the_whole_path():
    rng, model = np.random.default_rng(2), some_model(3)
    codes = rng.integers(0, chat_format.SYMBOLS, 40)
    codes[::4] |= 0
    lengths = np.array([1, 7, 12, 3, 17])
    starts = np.cumsum(lengths) - lengths
    codes[starts] = codes[starts] % 160 + 160  # a segment begins with a row, which opens
    whole = chat_format.decode(codes, np.array([0]), np.array([40]), model, np.array([chat_format.START]), np.array([-1]))
    each, _ = chat_format.forward(codes, starts, lengths, model, np.tile(np.arange(4), (5, 1)))
    ends = chat_format.joints(list(each), chat_format.START, -1)
    got = chat_format.decode(codes, starts, lengths, model, np.array([a for a, _ in ends]), np.array([b for _, b in ends]))
    assert got.tolist() == whole.tolist()
    halves = [chat_format.compose(list(each[:2])), chat_format.compose(list(each[2:]))]
    assert [b for _, b in chat_format.joints(halves, chat_format.START, -1)] == [ends[1][1], ends[4][1]]


def test_markers():
    assert chat_format.role_of("User: hi") == (1, "hi") and chat_format.role_of("### Assistant:") == (2, "")
    assert chat_format.role_of("**Human:** x") == (1, "x") and chat_format.role_of("[system]") == (0, "") and chat_format.role_of("<|im_start|>assistant\n")[0] == 2
    assert chat_format.role_of("A plain line: here")[0] is None and chat_format.role_of("answering: x")[0] is None and chat_format.role_of("")[0] is None


def made_chats(n=60, seed=4):
    rng = random.Random(seed)
    say = lambda k: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(k))
    rows = []
    for c in range(n):
        for t in range(rng.randrange(2, 9)):
            role = "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role, say(5) + "?" if role == "user" else "\n".join(say(30) for _ in range(3)), "own"))
    return rows


@pytest.mark.parametrize("tight", [False, True])
def test_roles_and_edges(spark, monkeypatch, tight):
    if tight:
        for name, value in {"BLOCK": 2, "FAN": 2, "CROWDED": 3}.items():
            monkeypatch.setattr(chat_format, name, value)
    rows = made_chats() + [(500, 0, None, f"text {i}", "own") for i in range(9)]
    rows += [(500, None, "user", "x", "own"), (500, -1, "user", "x", "own"), (None, 0, None, None, "own"), (None, 1, None, "", "own")] + [(501, 3, "user", "again?", "own")] * 4
    rows += [(502, 0, "user", "System: be kind\nUser: what?\nand why?\nAssistant: so\nit is\n" + "y" * 50_000, "own")]
    got = [r.asDict() for r in chat_format.format_chats(spark.createDataFrame(rows, CHATS)).collect()]
    by = {}
    for r in got:
        by.setdefault((r["conv_id"], r["turn"]), []).append(r)
    assert set(by) == {(c, t) for c, t, *_ in rows}
    assert sum(r["role_pred"] == role for c, t, role, _, _ in rows[:-17] for r in by[c, t] if c < 500) / sum(len(by[c, t]) for c, t, *_ in rows if c is not None and c < 500) > 0.95
    assert [r["copies"] for r in by[501, 3]] == [4] and len(by[500, 0]) == 9
    assert by[None, 0][0]["rendered"].endswith("\n<|im_end|>\n")
    parts = sorted(by[502, 0], key=lambda r: r["part"])
    assert [r["role_pred"] for r in parts] == ["system", "user", "assistant"]
    assert parts[1]["rendered"] == "<|im_start|>user\nwhat?\nand why?<|im_end|>\n" and "y" * 50_000 in parts[2]["rendered"]
    if tight:
        monkeypatch.undo()
        whole = chat_format.format_chats(spark.createDataFrame(rows[:-17], CHATS).where("conv_id is not null")).collect()
        same = {(r["conv_id"], r["turn"], r["part"]): r["role_pred"] for r in whole}
        assert np.mean([same.get((r["conv_id"], r["turn"], r["part"])) == r["role_pred"] for r in got if r["conv_id"] is not None and r["conv_id"] < 500]) > 0.97


def test_no_chats(spark):
    assert chat_format.format_chats(spark.createDataFrame([], CHATS)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_held_out_roles(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    found = chat_format.format_chats(table)
    both = [r for r in found.join(table, ["conv_id", "turn"]).collect() if r["held_out"]]
    assert len(both) > 50 and np.mean([r["role"] == r["role_pred"] for r in both]) > 0.9


# Scores


def plain_scores(rows, corpus, least):
    read = lambda table: [(i, WORD.findall((t or "").translate(LOWER))) for i, t in table]
    known = read(corpus)
    one = Counter(w for _, ws in known for w in ws)
    two = Counter(p for _, ws in known for p in zip(ws, ws[1:]))
    n, out = sum(one.values()), {}
    for i, ws in read(rows):
        s = math.log(max(1, one[ws[0]]) / n) if ws else 0.0
        for u, w in zip(ws, ws[1:]):
            s += math.log(two[u, w] / one[u]) if two[u, w] >= least else math.log(0.4 * max(1, one[w]) / n)
        k, before = out.get(i, (0, 0.0))
        out[i] = (k + len(ws), before + s)
    return out


@pytest.mark.parametrize("least, other, tight", [(1, False, False), (1, False, True), (1, True, False), (2, False, False), (2, True, False)])
def test_backoff_scores(spark, monkeypatch, least, other, tight):
    if tight:
        for name, value in {"HOT_BITS": 5, "VERY_HOT": 4, "WORDS_A_PARTITION": 300}.items():
            monkeypatch.setattr(backoff, name, value)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.choice([1, 2, 9, 60]))) for _ in range(120)]
    texts += ["THE the The\tthe", None, "", " \n ", "once only words stand here", "z" * 30_000 + " é漢 é漢 é漢", *["same text of many rows"] * 30]
    ids = [*range(len(texts))]
    ids[5], ids[6] = 4, None
    rows = list(zip(ids, texts))
    corpus = [(i, t) for i, t in rows if i is not None and i % 3] if other else rows
    table = lambda own: spark.createDataFrame([(i, t, "own") for i, t in own], "doc_id long, text string, n_words string")
    got = backoff.score(table(rows), table(corpus) if other else None, least).collect()
    want = plain_scores(rows, corpus, least)
    assert Counter(r["doc_id"] for r in got) == Counter(ids)
    for r in got:
        n, s = want[r["doc_id"]]
        assert r["n_words"] == n and abs(r["log_score"] - s) < 1e-3
        assert (r["mean_log_score"] is None) == (n == 0) and (not n or abs(r["mean_log_score"] - s / n) < 1e-3)


def test_no_scores(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert backoff.score(empty).count() == backoff.score(empty, empty).count() == 0

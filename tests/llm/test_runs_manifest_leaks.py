"""Periodic runs, the Merkle manifest and decontamination, against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import decontaminate, merkle, tandem

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term long, part string, start string, size string"


def table(spark, rows):
    """rows: doc_id, text, lang; with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, x, "s", len(t or ""), 5, "own", "own", "own") for i, t, x in rows], SCHEMA)


# Runs


def squares(words):
    n = len(words)
    return {(i, q) for q in range(1, n // 2 + 1) for i in range(n - 2 * q + 1) if words[i : i + q] == words[i + q : i + 2 * q]}


def plain_runs(words, least=6, power=4):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, power * q):
                found[i, j + q] = min(q, found.get((i, j + q), n))
            i = max(i, j) + 1
    return sorted((s, e, q) for (s, e), q in found.items())


def made_words(rng):
    n = rng.randrange(0, 40)
    words = [rng.randrange(rng.choice([2, 3, 6])) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 6))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 8)[: rng.randrange(0, 8 * len(unit))]
    return words


def numbered(docs):
    flat = np.array([x + 100 * i for i, d in enumerate(docs) for x in d], np.uint64)
    return flat, np.append(0, np.cumsum([len(d) for d in docs])).astype(np.int64)


def full_names(flat):
    names = tandem.Names(flat)
    while names.double():
        pass
    return names


def test_runs_of_many_documents_match_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        docs = [made_words(rng) for _ in range(rng.randrange(1, 4))]
        flat, bounds = numbered(docs)
        want = sorted((s + bounds[i], e + bounds[i], q) for i, d in enumerate(docs) for s, e, q in plain_runs(d))
        assert sorted(zip(*[x.tolist() for x in tandem.runs(flat, bounds)])) == want, docs


def test_each_step_of_the_method_matches_its_definition():
    rng = random.Random(2)
    for _ in range(300):
        words = made_words(rng)
        n = len(words)
        flat, bounds = numbered([words])
        names = full_names(flat)
        assert [words[i:] for i in names.order] == sorted(words[i:] for i in range(n))
        same = lambda i, j: next((k for k in range(n - j) if words[i + k] != words[j + k]), n - j)
        longest = [max((same(j, i) for j in range(i)), default=0) for i in range(n)]
        assert tandem.earlier(names).tolist() == longest
        start, end, following = tandem.blocks(np.array(longest, np.int64), bounds)
        at = 0
        for s, e in zip(start, end):
            assert s == at and e == s + max(1, longest[s])
            at = e
        assert at == n
        cover = set(zip(*[x.tolist() for x in tandem.covering(names, start, end, following)]))
        every = squares(words)
        assert cover <= every
        leftmost = {}
        for i, q in sorted(every):
            leftmost.setdefault(tuple(words[i : i + 2 * q]), (i, q))
        for i, q in leftmost.values():  # some covering square is joined to it by squares at all places between
            assert any(p == q and j <= i and all((k, q) in every for k in range(j, i + 1)) for j, p in cover), (words, i, q)
        primitive = lambda x: not any(len(x) % d == 0 and x == x[:d] * (len(x) // d) for d in range(1, len(x)))
        kinds = {tuple(words[i : i + 2 * q]) for i, q in every if primitive(words[i : i + q])}
        place, period = tandem.vocabulary(names, *[np.array(x, np.int64) for x in (list(zip(*cover)) or [(), ()])])
        assert {tuple(words[i : i + 2 * q]) for i, q in zip(place, period)} == kinds
        found = set(zip(*[x.tolist() for x in tandem.located(names, place, period)]))
        assert found == {(i, q) for i, q in every if primitive(words[i : i + q])}
        assert sorted(zip(*[x.tolist() for x in tandem.merged(*tandem.located(names, place, period))])) == plain_runs(words, 2, 2)


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    row = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *row, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_rows_of_runs_with_rewriting_nulls_and_long_texts(spark):
    rng = random.Random(3)
    texts = ["\t".join(f"w{x}" for x in made_words(rng)) for _ in range(60)] + [None, "", " \n", "A a " * 9, "a " * 7, "é è " * 5, "same words twice over"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "b c " * 6, None), (7, texts[7], "x"), (7, texts[7], "x")]
    long = " ".join(f"v{rng.randrange(3000)}" for _ in range(3000)) + " head" + " one two three" * 900 + " tail" + " x" * 500
    rows += [(k, long, "x") for k in range(1000, 1012)]
    got = [tuple(r)[:8] for r in tandem.periodic(table(spark, rows)).collect()]
    want = {}
    for i, t, _ in rows:
        if (i, t) not in want:
            want[i, t] = plain_row(i, t) if len(t or "") < 5000 or zlib.crc32(str(i).encode()) % 10 else None
    short = [want[i, t] for i, t, _ in rows if want[i, t]]
    assert sorted(map(str, short)) == sorted(str(r) for r in got if str(r) in {str(x) for x in short}) and len(got) == len(rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(60))
    assert tandem.periodic(table(spark, [])).count() == 0


# Merkle manifest


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, lower=False):
    i, t, x = row
    values = (i, "s", x, len(t or ""), t.translate(LOWER) if lower and t is not None else t)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root, and for each node the (left, right) siblings on its way."""
    ways, above = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parts = [nodes[k : k + 8] for k in range(0, len(nodes), 8)]
        for n, part in enumerate(parts):
            for k in range(len(part)):
                for i in above[8 * n + k]:
                    ways[i].append(("".join(part[:k]), "".join(part[k + 1 :])))
        above = [[i for below in above[8 * n : 8 * n + 8] for i in below] for n in range(len(parts))]
        nodes = [digest("".join(p)) for p in parts]
    return (nodes[0] if nodes else None), ways


def plain_manifest(rows):
    langs = sorted({x for _, _, x in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs]
    roots, ways = zip(*[climb([leaf(r) for r in t]) for t in trees])
    root, tops = climb(list(roots))
    out = []
    for j, t in enumerate(trees):
        for k, r in enumerate(t):
            way = ways[j][k] + tops[j]
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for a, b in way:
                node = digest(a + node + b)
            out.append((r[0], leaf(r), roots[j], root, digest("".join(a + b for a, b in way)), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["many", "langs", "one", "edges"])
def test_manifest_matches_plain_trees(spark, monkeypatch, case):
    monkeypatch.setattr(merkle, "RANGE", 16)
    monkeypatch.setattr(merkle, "FAN", 3)
    rng = random.Random(4)
    rows = {
        "many": [(i, f"Text {i}", rng.choice(["a", "a", "a", "b", None])) for i in rng.sample(range(10_000), 700)],
        "langs": [(i, f"T{i}", f"lang{i % 75}é") for i in range(150)] + [(999, "X", "lone")],
        "one": [(5, "Only", "a")],
        "edges": [(1, None, None), (1, None, None), (2, "", "a"), (None, "No Id", "a"), (None, "No Id 2", "a"), (3, "ÄA", "a"), (3, "same id", "a"), (4, "L" * 300_000, "z")],
    }[case]
    got = sorted((tuple(r) for r in merkle.manifest(table(spark, rows)).collect()), key=str)
    assert got == plain_manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(table(spark, [])).count() == 0


def test_forests_add_up_in_any_order_and_grouping():
    rng = random.Random(5)
    for size in (1, 7, 8, 9, 65, 513, 600):
        leaves = [(0, size, 0, i, digest(str(i))) for i in range(size)]
        want, _ = climb([x[4] for x in leaves])
        rng.shuffle(leaves)
        cut = sorted(rng.randrange(size + 1) for _ in range(5))
        parts = [merkle.Forest(1).merge(leaves[a:b]) for a, b in zip([0, *cut], [*cut, size])]
        while len(parts) > 1:
            a, b = parts.pop(rng.randrange(len(parts))), parts.pop(rng.randrange(len(parts)))
            parts.append(merkle.Forest(1).merge(a.nodes()).merge(b.nodes()))
        assert [x[4] for x in parts[0].nodes()] == [want]


def test_a_fragment_is_small():
    forest = merkle.Forest(1).merge((0, 1 << 20, 0, i, "x") for i in range(1000, 61_000))
    assert len(list(forest.nodes())) <= 14 * 7


# Decontamination


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_hits(docs, items, size=10):
    spans = []
    for item, text in items:
        w = tokens(text)
        n = min(size, len(w))
        spans += [(item, w[k : k + n]) for k in range(len(w) - n + 1)] if w else []
    out = []
    for doc_id, text, _ in docs:
        w, hit, found = tokens(text), set(), set()
        for item, span in spans:
            for k in range(len(w) - len(span) + 1):
                if w[k : k + len(span)] == span:
                    hit |= set(range(k, k + len(span)))
                    found.add(item)
        ids = ",".join(sorted("" if x is None else str(x) for x in found))
        out.append((doc_id, len(w), len(hit), len(found), digest(ids), bool(hit)))
    return sorted(out, key=str)


def leak_tables(rng):
    draw = lambda n: [rng.choice(["the", "of", "a", f"w{rng.randrange(60)}", "É", "x1"]) for _ in range(n)]
    items = [(i, " ".join(draw(rng.choice([1, 2, 5, 10, 11, 30])))) for i in range(25)] + [(None, "lone word here"), (77, None), (78, " ,; "), (3, "of the w1 x1"), (3, "of the w1 x1"), (79, "the the the the the the the the the the the")]
    docs = []
    for i in range(60):
        w = draw(rng.randrange(0, 60))
        if rng.random() < 0.6:
            own = tokens(rng.choice(items)[1])
            k = rng.randrange(len(own) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = own[k : k + rng.randrange(len(own) + 1)]
        docs.append((i, ", ".join(w).upper() if i % 3 else " ".join(w), "x"))
    docs += [(None, items[4][1], "x"), (5, items[6][1], "x"), (5, items[6][1], "x"), (900, None, None), (901, "", "x"), (902, ("the " * 40_000) + items[8][1], "x"), (903, "lone WORD-here", "x")]
    return docs, items


def test_hits_match_brute_force(spark):
    docs, items = leak_tables(random.Random(6))
    frame = spark.createDataFrame([(i, t, "own", 1) for i, t in items], "item_id long, text string, word string, row long")
    got = sorted((tuple(r) for r in decontaminate.contaminated(table(spark, docs), frame).collect()), key=str)
    assert got == plain_hits(docs, items)
    none = decontaminate.contaminated(table(spark, docs), frame.limit(0)).collect()
    assert len(none) == len(docs) and not any(r["contaminated"] or r["n_items"] for r in none)
    assert decontaminate.contaminated(table(spark, []), frame).count() == 0


@pytest.mark.parametrize("reach", [3, 12])
def test_near_matches_brute_force(spark, reach):
    docs, items = leak_tables(random.Random(7))
    docs = [d for d in docs if len(d[1] or "") < 2000]
    frame = spark.createDataFrame(items, "item_id long, text string")
    postings, found, _ = decontaminate.prepared(table(spark, docs), frame)
    ids = {r["doc"]: r["doc_id"] for r in postings.filter("term = -1").collect()}
    vocab = {}
    for r in postings.filter("term <> -1").collect():
        vocab.setdefault(r["doc"], {}).setdefault(r["term"], []).append(r["pos"])
    got = sorted(tuple(r) for r in decontaminate.near(postings, found, reach).collect())
    want = []
    for w in found.collect():
        rarest, terms = w["rare"][0]["term"], {x["term"] for x in w["rare"]}
        for doc in ids:
            own = vocab.get(doc, {})
            for at in own.get(rarest, []):
                if all(any(abs(p - at) <= reach for p in own.get(t, [])) for t in terms):
                    want.append((doc, w["window"], at))
    assert got == sorted(want) and want

"""Ranked search, repeated bytes and collocations against brute force on small fixtures."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from lexspark.llm import ball_tree, collocations, repeats

WORDS = ["alpha", "Beta", "gamma", "δέλτα", "x1", "of", "the", "THE"]


def made(n, seed, longest=30):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices(WORDS, weights=[1, 2, 3, 1, 1, 6, 9, 2], k=rnd.randint(0, longest))) for _ in range(n)]


def slow_rank(docs, items, k=10):
    terms = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for i in dict.fromkeys(i for i, _ in items):
        q = Counter(t for j, text in items if j == i for t in terms(text))
        found = []
        for d, c, n in held:
            m = 25 + 75 * n * n_docs // n_terms
            s = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, x in q.items() if c[t])
            if s > 0:
                found.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


@pytest.mark.parametrize("shard", [8, 8_192])
def test_rank(spark, monkeypatch, shard):
    monkeypatch.setattr(ball_tree, "SHARD", shard)
    docs = [(k, t) for k, t in enumerate(made(300, 1))] + [(1_000, None), (None, "alpha beta"), (5, "alpha"), (7, "alpha x1 " * 50_000), (8, "")]
    docs += [(2_000 + k, "Beta gamma") for k in range(40)]  # ties
    items = [("a", "alpha beta beta"), ("b", "The x1 nowhere"), ("c", None), ("d", "!?"), ("a", "Δ δέλτα"), (None, "gamma")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item string").repartition(3)
    got = ball_tree.rank(df, spark.createDataFrame(items, "item_id string, text string")).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, got), key=key) == sorted(slow_rank(docs, items), key=key)


def test_rank_in_blocks_of_items_and_of_nothing(spark, monkeypatch):
    docs = list(enumerate(made(60, 2)))
    items = [(k, t) for k, t in enumerate(made(30, 3, 6))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(ball_tree, "TERMS", 20)
    assert sorted(map(tuple, ball_tree.rank(*frames, k=3).collect())) == sorted(slow_rank(docs, items, 3))
    for d, i in ((frames[0].limit(0), frames[1]), (frames[0], frames[1].limit(0))):
        out = ball_tree.rank(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and not out.collect()


def test_bounds_hold():
    import numpy as np

    rnd = np.random.default_rng(4)
    size = rnd.integers(1, 6, 500)
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.concatenate([rnd.choice(40, s, replace=False) for s in size])
    rows = ball_tree.Rows(first, at, rnd.integers(1, 900_000, first[-1]))
    tree = ball_tree.BallTree(rows, 40, leaf=4)
    q, w = np.array([1, 5, 9]), np.array([3, 40, 2_000])
    dense = np.zeros(40, np.int64)
    dense[q] = w
    score, bound = tree.rows.dot(dense), tree.bounds(q, w)
    assert all(bound[k] >= score[i:j].max() for k, (i, j) in enumerate(tree.span))
    best = tree.search(q, w, 7, list(range(500)), [], np.zeros(40, np.int64))
    assert best == sorted((-int(s), False, d) for d, s in enumerate(rows.dot(dense)) if s > 0)[:7]


def slow_repeats(docs, length):
    count = Counter()
    raw = [(d, (t or "").encode()) for d, t in docs]
    for _, b in raw:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def repeated(spark, docs, length=40, gram=8, **more):
    df = spark.createDataFrame([(d, t, "doc") for d, t in docs], "doc_id long, text string, h string").repartition(3)
    out = repeats.remove_repeats(df, length, gram, **more).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["starts"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out), key=str)


def planted():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghéü", k=rnd.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(30), text(9)
    docs = [(k, text(rnd.randint(0, 80))) for k in range(60)]
    docs += [(100 + k, text(8) + passage + text(8)) for k in range(20)]  # a passage in contexts of its own
    docs += [(200 + k, text(20)[: 30 + k] + line) for k in range(5)]
    docs += [(300, docs[3][1]), (301, docs[3][1]), (302, docs[4][1][:50] + "X" + docs[4][1][50:])]  # copies, near copies
    docs += [(400, "a" * 5_000), (401, "ab" * 40), (402, "xyz" * 13), (403, "q" * 40), (404, "r" * 41), (405, "")]  # a text within itself
    docs += [(None, docs[5][1]), (500, None), (7, docs[7][1]), (7, text(30)), (600, "s" * 39), (601, "s" * 39)]
    return docs


@pytest.mark.parametrize("file", [4_096, 2])
def test_repeats(spark, file):
    docs = planted()
    assert repeated(spark, docs, file=file) == slow_repeats(docs, 40)


def test_repeats_in_small_segments_and_batches(spark, monkeypatch):
    docs = planted()
    monkeypatch.setattr(repeats, "SEGMENT", 64)
    monkeypatch.setattr(repeats, "BATCH", 100)
    assert repeated(spark, docs) == slow_repeats(docs, 40)


def test_no_repeats(spark):
    assert repeated(spark, []) == [] and repeated(spark, [(1, "short"), (2, "short")]) == [(1, 5, 0, 0, hashlib.sha256(b"short").hexdigest()), (2, 5, 0, 0, hashlib.sha256(b"short").hexdigest())]


def test_transform_against_brute_force():
    rnd = random.Random(6)
    for t in range(200):
        length = rnd.choice([1, 2, 5, 20])
        pieces = [bytes(rnd.choices(b"ab" if t % 3 else b"abcdefgh", k=rnd.randint(length, 60))) for _ in range(rnd.randint(1, 8))]
        count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        assert [x.tolist() for x in repeats.repeated_starts(pieces, length)] == [[count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)] for p in pieces]


def slow_collocations(docs, least, top=2_000, inside=50):
    out, by = [], {}
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            by.setdefault(lang or "und", []).append(re.findall(r"[^ \t]+", piece))
    for lang, pieces in by.items():
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in (1, 2, 3) for i in range(len(w) - k + 1))
        n, found = sum(c for p, c in f.items() if len(p) == 1), []
        for p, a in f.items():
            if len(p) == 1 or a < least or any(len(q) == 3 and p in (q[:2], q[1:]) and c >= least and 100 * c >= inside * a for q, c in f.items() if len(p) == 2):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:  # containers burst, subtrees spill, words are forgotten, every word has buckets
        for name, value in (("BURST", 2), ("ENTRIES", 20), ("VOCABULARY", 5), ("TOKENS", 50)):
            monkeypatch.setattr(collocations, name, value)
    docs = [("en", t) for t in made(120, 7)] + [(None, t) for t in made(40, 8)] + [("und", "the of. the of; the\tof"), ("de", None), ("de", ""), ("en", "the of gamma " * 2_000), ("fr", "!! ?")]
    df = spark.createDataFrame([(g, t, 1) for g, t in docs], "lang string, text string, n int").repartition(3)
    assert sorted(map(tuple, collocations.collocations(df, least=4).collect())) == slow_collocations(docs, 4)
    assert sorted(map(tuple, collocations.collocations(df, least=2, top=5, inside_percent=90).collect())) == slow_collocations(docs, 2, 5, 90)
    assert not collocations.collocations(df.limit(0)).collect()

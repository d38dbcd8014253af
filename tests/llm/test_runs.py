"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from asofspark.llm import queries, runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(c, least=6, power=4):
    """Every maximal stretch of every period, kept where that is its smallest period."""
    out = []
    for q in range(1, len(c) // 2 + 1):
        s = 0
        while s + q < len(c):
            if c[s] != c[s + q]:
                s += 1
                continue
            e = s
            while e + q < len(c) and c[e] == c[e + q]:
                e += 1
            n = e + q - s
            if n >= max(least, power * q) and not any(
                    all(c[s + k] == c[s + k + p] for k in range(n - p)) for p in range(1, q)):
                out.append((s, n, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12))
def test_lyndon_array(c):
    factors = [max(j for j in range(i + 1, len(c) + 1)
                   if all(c[i:j] < c[k:j] for k in range(i + 1, j))) - i for i in range(len(c))]
    assert runs.lyndon_array(c) == factors


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 8)), max_size=5))
def test_runs_match_brute_force(parts):
    c = [x for unit, times in parts for x in unit * times]
    for least, power in ((6, 4), (2, 2), (1, 3)):
        got = runs.find_runs(np.array(c, np.int64), np.zeros(len(c), np.int64), least, power)
        assert [tuple(r) for r in got.tolist()] == brute_runs(c, least, power)


def test_runs_end_at_their_document():
    codes, owner = np.array([1] * 5 + [1] * 7 + [2] * 6), np.array([0] * 5 + [1] * 13)
    assert runs.find_runs(codes, owner).tolist() == [[5, 7, 1], [12, 6, 1]]


def test_a_run_whose_hash_misled_is_extended_word_by_word():
    codes = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 7])
    assert runs._exact(codes, 0, 10, 2, 3) == (1, 9)


def brute_row(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(w), len(found), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_documents_match_brute_force(spark, docs, doc_rows, tmp_path, monkeypatch):
    rng = random.Random(4)
    more = []
    for k in range(150):
        parts = [[rng.choice("abc") for _ in range(rng.randint(1, 6))] * rng.randint(1, 9) for _ in range(rng.randint(0, 4))]
        more.append((1000 + k, rng.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    more += [(2000, "a " * 20000), (2001, "a b c " * 3000 + "x"), (2002, "   " * 9)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    monkeypatch.setattr(queries, "documents", lambda *_: table)
    got = Counter(map(tuple, queries.op13_periodic_runs(spark, "").collect()))
    small = [r for r in [(i, t) for i, t, _ in doc_rows] + more if len(r[1] or "") < 20000]
    want = Counter(brute_row(i, t) for i, t in small)
    assert not want - got and sum(got.values()) == len(doc_rows) + len(more)
    assert sum(1 for r in want if r[2] > 1) > 30
    rest = {r[0]: r for r in got if r[0] in (2000, 2001)}
    assert 1 in {rest[2000][2], rest[2001][2]}


def test_empty_table(spark, no_docs):
    out = runs.periodic_runs(spark, no_docs)
    assert out.count() == 0 and out.columns == ["id", "n_words", "runs", "collapsed"]

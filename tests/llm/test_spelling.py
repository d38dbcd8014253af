"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from asofspark.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) - len(b) == 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def brute_groups(counts, ratio=10):
    out = {}
    for w, n in counts.items():
        around = [v for v in counts if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        takes = best is not None and counts[best] >= ratio * n
        out[w] = (n, len(around), best if takes else None, counts[best] if takes else None)
    rows = set()
    for w, (n, many, form, form_n) in out.items():
        root = w
        while out[root][2] is not None:
            root = out[root][2]
        rows.add((w, form, root, n, many, form_n))
    return rows


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", max_size=6), max_size=30))
def test_composition_accepts_the_near_pairs(words):
    got = [tuple(sorted(p)) for p in spelling.Acceptor(sorted(words)).one_edit_pairs()]
    assert set(got) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    a = spelling.Acceptor(sorted(x + y for x in ("ab", "cd", "ef") for y in ("ing", "ed", "s")))
    live, todo = {0}, [0]
    while todo:
        for t in a.arcs[todo.pop()].values():
            if t not in live:
                live.add(t), todo.append(t)
    # root, behind a/c/e (as b/d/f differ: three states), one behind the stem, i, n, e, end
    assert len(live) == 1 + 3 + 1 + 3 + 1


@pytest.mark.parametrize("partition", [2, 30, 4000])
def test_groups_match_brute_force(spark, partition):
    rng = random.Random(7)
    counts = {}
    for _ in range(60):  # families around a word, chains of forms, a stem that a third of all words share
        base = "".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 12)))
        n = 10 ** rng.randint(1, 5)
        counts[base] = n
        for _ in range(rng.randint(0, 8)):
            k, c = rng.randrange(len(base)), rng.choice("abcdeéz")
            v = rng.choice([base[:k] + c + base[k:], base[:k] + base[k + 1:], base[:k] + c + base[k + 1:]])
            if len(v) >= 7:
                counts.setdefault(v, max(1, n // rng.choice([5, 10, 11, 100])))
            base, n = rng.choice([(base, n), (v if len(v) >= 7 else base, max(1, n // 10))])
    for _ in range(150):
        counts["constant" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 7))) + "ly"] = rng.randint(2, 40)
    counts |= {"x" * 5000: 3, "x" * 5001: 50, "x" * 2500 + "y" + "x" * 2500: 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.spelling_groups(spark, words, partition=partition)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == brute_groups(counts)


def test_documents_match_brute_force(spark, docs, doc_rows, monkeypatch):
    rng = random.Random(8)
    names = ["".join(rng.choice("abcÉÖéx") for _ in range(rng.randint(8, 10))) for _ in range(12)]
    more = [(3000 + k, " ".join(rng.choice([w, w, w.title()]) + rng.choice(["", ",", "9", "\n"])
                                for w in rng.choices(names, weights=[60, 30] + [1] * 10, k=rng.randint(0, 150)))) for k in range(250)]
    more += [(4000, "É" * 9000), (4001, "é" * 9000), (None, None), (4002, "")]
    table = docs.select("doc_id", "text", "source").union(spark.createDataFrame([(*r, "s") for r in more], "doc_id long, text string, source string"))
    monkeypatch.setattr(queries, "documents", lambda *_: table)
    counts = Counter()
    for i, t in [(i, t) for i, t, _ in doc_rows] + more:
        for w in RUN.findall(t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    rows = queries.op12_spelling_variants(spark, "").collect()
    assert len(rows) == len(counts)
    assert {tuple(r) for r in rows} == brute_groups(counts)
    assert sum(r.form is not None for r in rows) >= 3


def test_counts_flushed_early_are_the_same(spark, docs, monkeypatch):
    want = Counter(map(tuple, spelling.vocabulary(docs).collect()))
    monkeypatch.setattr(spelling, "REMEMBERED", 10)
    assert Counter(map(tuple, spelling.vocabulary(docs).collect())) == want


def test_empty_table(spark, no_docs):
    assert spelling.spelling_groups(spark, spelling.vocabulary(no_docs)).count() == 0

"""SimHash, line dedup and exact dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from asofspark.llm import exactdedup, linededup, simhash
from asofspark.llm.components import components

SPACE = re.compile("[\x20\x09-\x0d]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_fingerprint(text, n=3):
    w = [x for x in SPACE.split(lower(text or "")) if x]
    grams = [" ".join(w)] if 0 < len(w) < n else [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    return [find(k) for k in range(n)]


def brute_components(rows, bits=3):
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    n = len(rows)
    root = roots(n, [(a, b) for a in range(n) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= bits])
    least = defaultdict(list)
    for k in range(n):
        if rows[k][0] is not None:
            least[root[k]].append(rows[k][0])
    return Counter((rows[k][0], fps[k], min(least[root[k]]) if least[root[k]] else None) for k in range(n))


def test_components_match_brute_force(spark, docs, doc_rows):
    got = Counter((r.id, r.fp % (1 << 64), r.component_id) for r in simhash.components_of(spark, docs).collect())
    assert got == brute_components(doc_rows)
    assert any(i != c for i, _, c in got)


def test_near_dedup_keeps_one_of_each_group(spark, docs, doc_rows):
    got = simhash.near_dedup(spark, docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect() if r.doc_id is not None]
    want = {c for i, _, c in brute_components(doc_rows) if c is not None}
    assert sorted(ids) == sorted(want)
    assert sum(r.doc_id is None for r in got.collect()) == sum(r[0] is None for r in doc_rows)


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_links_in_blocks_lose_nothing(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 6, dtype=np.int64)
    fps = {0, 1, 7}
    for b in base:  # chains and stars around a centre
        for _ in range(25):
            x = int(b)
            for bit in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    found = {r.node: r.label for r in components(spark, simhash.edges(spark, df, 3, block)).collect()}
    root = roots(len(fps), [(a, b) for a in range(len(fps)) for b in range(a)
                            if ((fps[a] ^ fps[b]) % (1 << 64)).bit_count() <= 3])
    least = {}
    for x, r in zip(fps, root, strict=True):
        least[r] = min(least.get(r, x), x)
    assert {x: least[r] for x, r in zip(fps, root, strict=True)} == {x: found.get(x, x) for x in fps}


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=3))
def test_linked_fingerprints_share_a_cell(x, bits):
    y = x
    for b in bits:
        y ^= 1 << b
    ex, ey = (int(simhash._embed(np.array([v], np.uint64).view(np.int64))[0]) for v in (x, y))
    assert (ex ^ ey).bit_count() <= len(bits)  # Manhattan never exceeds Hamming
    assert any((ex & m) == (ey & m) for m in simhash.masks(3))


def brute_gone(rows, min_words=1, near_words=5):
    lines = []
    for i, t, _ in rows:
        if t is not None:
            key = xxhash.xxh64_intdigest(t.encode(), seed=42)
            key -= (1 << 64) if key >> 63 else 0
            lines += [((-1 if i is None else i, key, k), [x for x in SPACE.split(lower(line)) if x], (i, t, k))
                      for k, line in enumerate(t.split("\n"))]

    def close(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < near_words or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        a, b = (a, b) if len(a) > len(b) else (b, a)
        return any(a[:k] + a[k + 1:] == b for k in range(len(a)))

    long = [x for x in lines if len(x[1]) >= min_words]
    gone = defaultdict(set)
    for place, w, (i, t, k) in long:
        if any(p < place and close(w, v) for p, v, _ in long):
            gone[i, t].add(k)
    return gone


def test_lines_match_brute_force(spark, docs, doc_rows):
    got = Counter((r.id, tuple(r.gone), r.clean) for r in linededup.report(spark, docs).collect())
    gone = brute_gone(doc_rows)
    want = Counter()
    for i, t, _ in doc_rows:
        out = gone.get((i, t), set())
        want[i, tuple(sorted(out)), t and "\n".join(x for k, x in enumerate(t.split("\n")) if k not in out)] += 1
    assert got == want
    assert any(g for _, g, _ in got)


def test_candidates_beyond_the_broadcast_are_joined_alike(spark, docs, monkeypatch):
    want = Counter((r.id, tuple(r.gone), r.clean) for r in linededup.report(spark, docs).collect())
    monkeypatch.setattr(linededup, "BROADCAST_LINES", 0)
    assert Counter((r.id, tuple(r.gone), r.clean) for r in linededup.report(spark, docs).collect()) == want


def test_line_dedup_keeps_columns_and_drops_emptied_documents(spark, docs, doc_rows):
    got = linededup.line_dedup(spark, docs)
    assert got.columns == docs.columns
    gone = brute_gone(doc_rows)
    want = Counter(i for i, t, _ in doc_rows if t is None or len(gone.get((i, t), ())) < len(t.split("\n")))
    assert Counter(r.doc_id for r in got.collect()) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=7), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=7))
def test_one_edit_and_variants_agree(a, b):
    subs = len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    dels = any(a[:k] + a[k + 1:] == b for k in range(len(a))) or any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    assert linededup.within_one_edit(a, b) == (subs or dels)
    va, vb = (set(linededup.variants(w).tolist()) for w in (a, b))
    if subs or dels:
        assert va & vb
        if len(a) > 1 and len(b) > 1:
            assert set(linededup.halves(a)) & set(linededup.halves(b))


def brute_exact(rows):
    norm = [SPACE.sub(" ", t or "") for _, t, _ in rows]
    size, least = Counter(norm), {}
    for (i, _, _), t in zip(rows, norm, strict=True):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    return Counter((i, least.get(t), size[t], i == least.get(t), hashlib.sha256(t.encode()).hexdigest())
                   for (i, _, _), t in zip(rows, norm, strict=True))


def test_exact_groups_match_brute_force(spark, docs, doc_rows):
    want = brute_exact(doc_rows)
    got = exactdedup.exact_dedup(spark, docs, prefix=8, digests=True)
    assert Counter((r.id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()) == want
    short = Counter()
    for (*row, _), n in want.items():
        short[tuple(row)] += n
    for words in (exactdedup.WORDS, 2):  # few words: every bit is set, every text is hashed
        got = exactdedup.exact_dedup(spark, docs, prefix=8, words=words)
        assert Counter((r.id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == short


def test_only_survivors_are_hashed_in_full(spark, monkeypatch):
    rows = [(k, "x" * (k + 1), "s") for k in range(200)] + [(500, "same text", "s"), (501, "same  text", "s"), (502, "same t3xt", "s")]
    kept = {}
    real = exactdedup.written
    monkeypatch.setattr(exactdedup, "written", lambda s, df, name: kept.setdefault(name, real(s, df, name)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = exactdedup.exact_dedup(spark, docs, prefix=4)
    hashed = {r.id for r in kept["exact"].where("full is not null").collect()}
    assert {500, 501, 502} <= hashed and len(hashed) < 10
    assert {r.id: r.keep_id for r in out.collect() if r.group_size > 1} == {500: 500, 501: 500}


def test_no_text_is_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a  b"), (2, "a b"), (3, None)], "doc_id long, text string")
    plans, real = {}, exactdedup.written
    show = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(exactdedup, "written", lambda s, df, name: (plans.__setitem__(name, show(df)), real(s, df, name))[1])
    for digests in (True, False):
        last = show(exactdedup.exact_dedup(spark, docs, digests=digests))
        # the tasks that read texts shuffle nothing, and where rows are shuffled there is no text
        assert "hashpartitioning" not in plans["exact"].split("BroadcastExchange")[0] and "text" in plans["exact"]
        assert "hashpartitioning" in last and "text" not in last.replace("text_sha256", "")


def test_empty_tables(spark, no_docs):
    assert simhash.components_of(spark, no_docs).count() == 0
    assert simhash.near_dedup(spark, no_docs).count() == 0
    assert linededup.report(spark, no_docs).count() == 0
    assert linededup.line_dedup(spark, no_docs).count() == 0
    assert exactdedup.exact_dedup(spark, no_docs).count() == exactdedup.exact_dedup(spark, no_docs, digests=True).count() == 0

"""License scans, fingerprints, tool calls and wavelet shards."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from asofspark.llm import iblt, licenses, queries, toolcalls, wavelet
from asofspark.llm.tokens import byte_bpe_path

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def wrapped(text, width, mark):
    lines, line = [], mark
    for w in text.split():
        if len(line) + len(w) >= width:
            lines.append(line)
            line = mark
        line += " " + w
    return "\n".join([*lines, line])


#: Every notice broken over lines, as comments too.
WRAPPED = ["some words before\n\n" + wrapped(t, width, mark) + "\nand after it" for width, mark in ((20, ""), (60, "#"), (76, " *"), (80, "//"))
           for _, t, _ in licenses.NOTICES]
#: Sentences that share many words with a short notice of another licence.
STRANGERS = ["Licensed under CC BY 4.0.", "Released under the Apache License", "The museum released its plans under the new press license agreement",
             "released and under way, the license"]


@pytest.fixture(scope="session")
def licensed(spark, docs, doc_rows):
    extra = [(900 + k, t, "en", "s") for k, t in enumerate([
        "x\nLicensed under the Apache License, Version 2.0 and more",
        "licensed under apache version 2 0",  # 6 of 7 words
        "Licensed under the Apache", "GNU General\nPublic License", "MIT-License mit license MIT License x mit",
        "This work is licensed under a Creative Commons Attribution 4.0 International License", "cc by cc by",
        *WRAPPED, *STRANGERS, "Released under " + "w " * 4 + "the MIT License", "released " * 9 + "mit license under the mit license the",
        " ".join(t for _, t, _ in licenses.NOTICES) * 3])]
    return docs.select("doc_id", "text").union(spark.createDataFrame([e[:2] for e in extra], "doc_id long, text string")), \
        [(i, t) for i, t, _ in doc_rows] + [e[:2] for e in extra]


def test_licenses_match_brute_force(spark, licensed):
    docs, rows = licensed
    out = licenses.license_report(spark, docs).collect()
    want = Counter()
    for i, t in rows:
        w, places = words(t), []
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            places += [(k, label) for k in range(len(w)) if w[k:k + len(p)] == p]
        best, found, met = 0.0, set(), set()
        for k, (label, notice, core) in enumerate(licenses.NOTICES):
            own, span = set(words(notice)), math.ceil(1.25 * len(words(notice)))
            for s in range(len(w)):
                if w[s] in own:  # a window that starts elsewhere holds no more
                    held = own & set(w[s:s + span])
                    if len(held) / len(own) >= licenses.THRESHOLD - 1e-9 and held >= set(core.split()):
                        best, found, met = max(best, len(held) / len(own)), found | {label}, met | {k}
        base = {x for _, x in places}
        want[i, len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
             ",".join(sorted(base)), ",".join(sorted(base | found)), round(best, 9), len(met)] += 1
    assert Counter((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9),
                    r.n_notices) for r in out) == want
    text = dict(rows)
    for r in out:
        if text[r.id] in WRAPPED:
            (label,) = {label for label, t, _ in licenses.NOTICES if words(t) == words(text[r.id])[3:-3]}
            assert label in r.labels.split(",") and r.score == 1.0
        if text[r.id] in STRANGERS:
            assert r.labels == r.base_labels and r.score == 0.0
    assert sum(text[r.id] in WRAPPED for r in out) == 4 * len(licenses.NOTICES)


def test_the_positional_filter_can_reject(spark):
    # words of other notices come before the first common word: enough words in all, too few from there on
    other, notice = ("y", "aa bb", "aa"), ("x", "cc dd ee ff", "")
    text = "aa bb cc dd"
    rank = licenses.ranking([b"aa", b"bb", b"cc", b"dd", b"ee", b"ff"], np.arange(6))
    n = licenses.index([other, notice], rank, 0.75)[1]
    own = sorted(rank[w.encode()] for w in text.split())
    first = min(set(own) & set(n["ranks"]))
    assert len(own) >= n["need"] == 3 and first in n["prefix"]
    assert min(len(own) - own.index(first), len(n["ranks"]) - n["ranks"].index(first)) < n["need"]
    docs = spark.createDataFrame([(1, text), (2, "aa cc dd ee")], "doc_id long, text string")
    _, matches = licenses.scan(spark, docs, threshold=0.75, notices=[other, notice])
    assert [(r.id, r.label) for r in matches.orderBy("id", "label").collect()] == [(1, "y"), (2, "x")]


def key_of(i, t):
    h = xxhash.xxh64_intdigest(t.encode(), seed=42)
    return (i is not None, i or 0, h - (1 << 64) if h >> 63 else h)


def parts(t):
    return Counter(p for line in t.split("\n") for p in [line[s:s + 160] for s in range(0, len(line), 160)] if p)


def alike(a, b):
    x, y = parts(a), parts(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


@pytest.mark.parametrize("ranges", [1, 7])
def test_fingerprints_match_brute_force(spark, docs, doc_rows, ranges):
    out = iblt.fingerprints(spark, docs, parts=ranges).collect()
    order = sorted(((i, t or "") for i, t, _ in doc_rows), key=lambda r: key_of(*r))
    want = Counter()
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        e = t[:len(t) - n] + nxt[:n]
        x, y = parts(t), parts(e)
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, nxt), 9),
             sum((x - y).values()), sum((y - x).values())] += 1
    assert Counter((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), len(r.gone), len(r.come))
                   for r in out) == want
    prints = {}
    for r in out:
        prints.setdefault(r.id, set()).add(r.fingerprint)
    assert prints[3] == prints[501]  # equal texts


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=120), min_size=1, max_size=4), st.integers(0, 50))
def test_peeling_recovers_every_difference(lists, shift):
    a = [("\n".join(f"p{x}" for x in xs)) for xs in lists]
    b = [("\n".join(f"p{x + shift}" for x in xs)) for xs in lists]
    da, db = iblt.digests(a), iblt.digests(b)
    pair, keys, sign = iblt.differences(da, db, len(a), 6)
    for k in range(len(a)):
        x, y = (set(d[1][d[0] == k].tolist()) for d in (da, db))
        assert set(keys[(pair == k) & (sign > 0)].tolist()) == x - y
        assert set(keys[(pair == k) & (sign < 0)].tolist()) == y - x


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=300), st.integers(0, 60))
def test_wavelet_rank_and_select(values, token):
    tokens = np.array(values, np.uint32)
    shard = wavelet.Shard(wavelet.to_bytes(3, 1, [None, 5], [0, len(values)], tokens))
    assert shard.tokens().tolist() == values
    assert [shard.access(k) for k in range(len(values))] == values
    places = [k for k, v in enumerate(values) if v == token]
    assert shard.count(token) == len(places)
    assert shard.count(token, 2, max(2, len(values) - 1)) == sum(2 <= k < len(values) - 1 for k in places)
    assert [shard.locate(token, j) for j in range(len(places) + 1)] == places + [-1]
    assert shard.documents()[0] == [None, 5]


def test_wavelet_beyond_one_block():
    tokens = np.random.default_rng(1).integers(0, 70000, 100000).astype(np.uint32)
    shard = wavelet.Shard(wavelet.to_bytes(0, 0, [1], [100000], tokens))
    assert shard.bits == 17 and (shard.tokens() == tokens).all()
    for k in (0, 32767, 32768, 12345, 65536, 99999):
        assert shard.access(k) == tokens[k]
        same = np.flatnonzero(tokens == tokens[k])
        assert [shard.locate(int(tokens[k]), j) for j in range(len(same))] == same.tolist()
        assert shard.count(int(tokens[k]), 100, 70000) == ((same >= 100) & (same < 70000)).sum()


def test_an_access_reads_one_block_of_a_plane():
    tokens = np.random.default_rng(2).integers(0, 50000, 1 << 20).astype(np.uint32)
    data = wavelet.to_bytes(0, 0, [1], [len(tokens)], tokens)
    ranges = []

    def read(at, size):
        ranges.append(size)
        return data[at:at + size]

    shard = wavelet.Shard.over(read)
    opening = sum(ranges)
    tables, block = 8 * len(tokens) // wavelet.BLOCK * shard.bits, wavelet.BLOCK // 8 + 64
    for ask in (lambda s: s.access(777_777) == tokens[777_777],
                lambda s: s.count(int(tokens[5]), 0, 500_000) == (tokens[:500_000] == tokens[5]).sum(),
                lambda s: tokens[s.locate(int(tokens[99]), 0)] == tokens[99]):
        ranges.clear()
        assert ask(wavelet.Shard.over(read))
        # a rank or select at either end of the range, and one on the way back
        assert sum(ranges) <= opening + tables + 4 * shard.bits * block and sum(ranges) < len(data) / 5
    ranges.clear()
    assert shard.access(3) == tokens[3] and sum(ranges) <= tables + shard.bits * block


def test_one_id_and_rows_without_one_are_split(spark):
    from asofspark.llm.ranges import by_range

    rows = [(None, f"n{k}") for k in range(300)] + [(7, f"s{k}") for k in range(300)] + [(k, "x") for k in range(300)]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("text_key", queries.F.xxhash64("text"))
    dealt = by_range(spark, df, "id", "text_key", 9).withColumn("task", queries.F.spark_partition_id()).collect()
    per = Counter(r.bucket for r in dealt)
    assert len(dealt) == 900 and 8 <= len(per) <= 10 and max(per.values()) < 250
    assert all(len({r.task for r in dealt if r.bucket == b}) == 1 for b in per)
    order = sorted(dealt, key=lambda r: (r.id is not None, r.id or 0, r.text_key))
    assert [r.bucket for r in order] == sorted(r.bucket for r in dealt)
    assert len({r.bucket for r in dealt if r.id is None}) >= 3 and len({r.bucket for r in dealt if r.id == 7}) >= 3


def test_shards_hold_every_document(spark, docs, doc_rows):
    folder = wavelet.shard_folder(spark)
    files = wavelet.write_shards(spark, docs, folder, byte_bpe_path(), end_id=0, shard_tokens=3000)
    assert files > 3
    lib = Tokenizer.from_file(byte_bpe_path())
    start, want = 0, Counter()
    for i, t in sorted(((i, t or "") for i, t, _ in doc_rows), key=lambda r: key_of(*r)):
        ids = np.array(lib.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want[i, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert Counter(map(tuple, wavelet.digests(spark, folder).collect())) == want


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, 0, "a", "search", '{"query": "x", "limit": 2}', []),
        (1, 2, "b", "search", '{"limit":"2","query":"y"}', ["a"]),
        (1, 1, "c", "search", '{"query":"z","z":{"q":1,"b":[2, 1]}}', ["b", "a", "gone", None]),
        (1, 3, "b", "search", '{"query":"later"}', []),
        (1, 4, None, "search", '{"query":"nameless"}', None),
        (2, 0, "a", "search", '{"query":"x"}', ["b"]),
        (2, 1, "b", "search", '{"query":"x"}', ["a"]),
        (2, 2, "c", "search", '{"query":"x"}', ["b"]),
        (None, 0, "a", "nope", '{"query":"x"', None),
        (3, 0, "a", "search", None, []), (3, 1, "b", "search", "[1]", []), (3, 2, "d", "other", "{}", []),
    ], "conv_id long, pos long, call_id string, name string, arguments string, needs array<string>")
    results = spark.createDataFrame([(1, 9, "a", "second"), (1, 5, "a", 'first "q"'), (None, 1, "a", "null's"), (7, 0, "a", "x"),
                                     (1, 5, None, "y")], "conv_id long, pos long, call_id string, content string")
    out = {(r.conv_id, r.call_id, r.pos): r for r in toolcalls.link_tool_calls(spark, calls, results, queries.TOOLS).collect()}
    assert len(out) == 13
    r = out[1, "a", 0]
    assert (r.step, r.level, r.status, r.result_copies, r.message) == (
        0, 0, "linked", 2, '{"arguments":{"limit":2,"query":"x"},"id":"a","name":"search","result":"first \\"q\\""}')
    assert (out[1, "b", 2].step, out[1, "b", 2].level) == (1, 0) and out[1, "b", 2].copies == 2 and out[1, "b", 2].problems == ["limit: not of type integer"]
    r = out[1, "c", 1]
    assert (r.step, r.level) == (1, 1) and r.problems == ["z: not in the schema", "unknown need: gone"]
    assert r.message.startswith('{"arguments":{"query":"z","z":{"b":[2,1],"q":1}}')
    assert out[1, None, 4].status == "no id"
    assert [out[2, c, p].status for c, p in (("a", 0), ("b", 1), ("c", 2))] == ["cyclic", "cyclic", "cyclic"]
    assert out[None, "a", 0].problems == ["arguments: not JSON"] and out[None, "a", 0].result == "null's"
    assert out[3, "a", 0].problems == ["arguments: not JSON"] and out[3, "b", 1].problems == ["arguments: not an object"]
    assert out[3, "d", 2].problems == ["unknown tool"]
    assert out[7, "a", 0].status == "orphan result" and out[1, None, 5].status == "orphan result"


def test_order_is_topological_and_cycles_are_found(spark):
    import random

    rng = random.Random(2)
    calls, needs = [], {}
    for conv in range(30):
        n = rng.randint(1, 12)
        for k in range(n):
            own = {rng.randrange(n) for _ in range(rng.randint(0, 2))} - {k} if conv % 3 else set(range(max(0, k - 2), k))
            if conv % 2 and conv % 3:
                own = {x for x in own if (x * 7) % n < (k * 7) % n}  # no cycles, positions out of order
            needs[conv, k] = own
            calls.append((conv, k, str(k), "search", '{"query":"x"}', [str(x) for x in own]))
    df = spark.createDataFrame(calls, "conv_id long, pos long, call_id string, name string, arguments string, needs array<string>")
    none = spark.createDataFrame([], "conv_id long, pos long, call_id string, content string")
    out = {(r.conv_id, r.pos): r for r in toolcalls.link_tool_calls(spark, df, none, queries.TOOLS).collect()}
    for (conv, k), own in needs.items():
        r = out[conv, k]
        seen, todo = set(), list(own)
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += needs[conv, x]
        if k in seen:
            assert r.status == "cyclic"
        if r.status != "cyclic":
            for x in own:
                q = out[conv, x]
                assert q.status == "cyclic" or (q.step, q.level, q.pos) < (r.step, r.level, r.pos)
        else:
            assert any(x in seen and needs[conv, x] for x in seen)
    assert {r.level for r in out.values()} > {0, 1, 2}


def test_peeling_ends_on_a_cell_that_is_pure_by_chance():
    key = np.array([12345], np.uint64)
    at = iblt._cells(key, np.zeros(1, np.int64), iblt.CELLS)[0]
    s = iblt.Sketches(2, iblt.CELLS)
    s.count[at], s.keys[at], s.checks[at] = 1, key, iblt.check_of(key)  # not in its two other cells
    s.add(np.array([1]), key, 1)
    owner, keys, _, whole = s.peel()
    assert whole.tolist() == [False, True] and key[0] in keys[owner == 1]


def test_colliding_digests_are_compared_one_by_one():
    twice = (np.zeros(3, np.int64), np.array([7, 7, 9], np.uint64))  # cancels in every cell
    pair, keys, sign = iblt.differences(twice, (np.zeros(1, np.int64), np.array([9], np.uint64)), 1)
    assert (pair.tolist(), keys.tolist(), sign.tolist()) == ([0], [7], [1])


def test_empty_tables(spark, no_docs):
    assert licenses.license_report(spark, no_docs).count() == 0
    assert iblt.fingerprints(spark, no_docs).count() == 0
    folder = wavelet.shard_folder(spark)
    assert wavelet.write_shards(spark, no_docs, folder, byte_bpe_path(), end_id=0) == 0
    assert wavelet.digests(spark, folder).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert toolcalls.link_tool_calls(spark, queries.derived_calls(talk), queries.derived_results(talk), queries.TOOLS).count() == 0


def test_threshold_is_a_share_of_the_notice():
    rank = licenses.ranking([b"a", b"b", b"c", b"d", b"e"], np.array([5, 1, 3, 3, 2]))
    (n,) = licenses.index([("x", "a b c d e", "b")], rank, 0.8)
    assert n["need"] == math.ceil(0.8 * 5) and n["prefix"] == [0, 1] and rank[b"b"] == 0


def test_planes_are_split_and_merged_in_parts():
    tokens = np.random.default_rng(7).integers(0, 50_000, 1_500_000).astype("<u4")
    data = wavelet.to_bytes(0, 0, [1], [len(tokens)], tokens)
    for work in (lambda: wavelet.build(tokens), lambda: wavelet.Shard(data).tokens()):
        tracemalloc.start()
        out = work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 10.5 * len(tokens), peak / len(tokens)  # planes and two copies; no places of all tokens
    assert np.array_equal(out, tokens)
    for part in (np.zeros(0, "<u4"), tokens[:1], tokens[:wavelet.PART], tokens[:wavelet.PART + 1], np.zeros(9, "<u4")):
        assert np.array_equal(wavelet.Shard(wavelet.to_bytes(0, 0, [1], [len(part)], part)).tokens(), part)

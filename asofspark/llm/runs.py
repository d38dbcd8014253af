"""Periodic runs of words: Lyndon arrays from a suffix sorter's first phase, extended into runs.

A run is a stretch of words with smallest period q, at least ``max(MIN_LENGTH, MIN_POWER * q)`` long,
that no neighbouring word extends. Every run holds a Lyndon root: a word sequence of length q that is
the longest Lyndon factor where it starts, under the words' order or under the reversed one. So:

* Baier's grouping: the first phase of his suffix sorter handles groups of suffixes from the
  greatest to the least. Each suffix of the group points to the nearest one before it that
  is in a lower group; those pointed to l times leave their group for a new one right above it,
  whose context is longer by l times the group's. When a group's turn comes, its context is the
  longest Lyndon factor at each of its places. No suffix array is needed. It is done for both orders.
* Extension: the common extensions of (i, i + q) to both sides, by binary search over sums that hash
  every stretch; the runs so found are compared word by word, and a run whose hash misled is
  extended word by word instead.

Before that, places are left out that no run can hold: all words of a run stand in it ``MIN_POWER`` times
or more, so only stretches remain whose every word occurs as often inside the stretch,
taken anew until nothing changes. No run is lost or cut by it.

A text is one row and is handled in one task; there is no shuffle, and memory follows a batch.

Cases: a null or blank text has no words and no run; its digests are those of the empty string.
Equal rows have equal results; a null id is kept. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from asofspark.llm.common import bounded_batches, text_of

MIN_LENGTH = 6
MIN_POWER = 4
_BASE = 0x9E3779B97F4A7C15 | 1


def lyndon_array(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon factor at every place, by Baier's grouping."""
    n = len(codes)
    context, members, below, above = [], [], [], []
    group = [0] * n
    at: dict[int, int] = {}
    for c in sorted(set(codes)):
        g = at[c] = len(context)
        context.append(1), members.append([]), below.append(g - 1), above.append(g + 1)
    for i, c in enumerate(codes):
        group[i] = at[c]
        members[at[c]].append(i)
    current = len(context) - 1
    if current >= 0:
        above[current] = -1
    out = [0] * n
    left = list(range(-1, n - 1))  # of a place that has been handled: where to look on
    handled = bytearray(n)
    while current >= 0:
        size = context[current]
        own = [i for i in members[current] if group[i] == current]
        for i in own:
            handled[i] = 1
            out[i] = size
        pointed: dict[int, int] = {}
        for i in own:
            j = left[i]
            while j >= 0 and handled[j]:
                j = left[j]
            k = i
            while k != j and k >= 0 and handled[k]:  # later searches go straight there
                left[k], k = j, left[k]
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in pointed.items():
            moved.setdefault((-times, group[j]), []).append(j)
        for times, old in sorted(moved):  # more pointers first: later ones come in between
            new = len(context)
            context.append(context[old] - times * size)
            members.append(moved[times, old])
            below.append(old), above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
            for j in members[new]:
                group[j] = new
        current = below[current]
    return out


def _stretches(codes: np.ndarray, owner: np.ndarray, least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, stretch)`` of the places in stretches whose words all occur ``power`` times inside."""
    place, seg = np.arange(len(codes)), owner
    while len(place):
        key = seg.astype(np.int64) * (int(codes.max()) + 1) + codes[place]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        often = counts[inverse] >= power
        kept, seg_kept = place[often], seg[often]
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (seg_kept[1:] != seg_kept[:-1])
        number = np.cumsum(new) - 1
        long = np.bincount(number, minlength=1)[number] >= least if len(kept) else often[:0]
        if often.all() and long.all() and (number[-1] == len(np.unique(seg)) - 1):
            return place, number
        place = kept[long]
        _, seg = np.unique(number[long], return_inverse=True)
    return place, seg


def _reach(sums: np.ndarray, power: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """Longest common extension of places a < b, to the right or (``back``) to the left of both."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        x, y = (a - mid, b - mid) if back else (a, b)
        same = (sums[x + mid] - sums[x]) * power[b - a] == sums[y + mid] - sums[y]
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def _exact(codes: np.ndarray, start: int, end: int, q: int, at: int) -> tuple[int, int]:
    """The run of period q around place ``at``, word by word where the hash had misled."""
    if (codes[start:end - q] == codes[start + q:end]).all():
        return start, end
    start, end = at, at + q
    while start > 0 and codes[start - 1] == codes[start - 1 + q]:
        start -= 1
    while end < len(codes) and codes[end] == codes[end - q]:
        end += 1
    return start, end


def find_runs(codes: np.ndarray, owner: np.ndarray, least: int = MIN_LENGTH, power: int = MIN_POWER) -> np.ndarray:
    """``(place, length, period)`` rows, ascending, of all runs in ``codes``; none crosses owners."""
    place, seg = _stretches(codes, owner, least, power)
    if not len(place):
        return np.zeros((0, 3), np.int64)
    edges = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1], True])
    shift = np.arange(len(edges) - 1)
    # stretches side by side, a separator of its own behind each
    line = np.empty(len(place) + len(shift), np.int64)
    to = np.arange(len(place)) + seg
    line[to] = codes[place]
    line[edges[1:] + shift] = int(codes.max()) + 1 + shift
    origin = np.full(len(line), -1)
    origin[to] = place
    size = np.zeros(len(line), np.int64)
    size[to] = np.diff(edges)[seg]
    roots = np.zeros((2, len(line)), np.int64)
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        own = codes[place[s:e]]
        at = to[s]
        roots[0, at:at + e - s] = lyndon_array(own.tolist())
        roots[1, at:at + e - s] = lyndon_array((-own).tolist())
    values = np.random.default_rng(20240229).integers(1, 1 << 63, int(line.max()) + 1, dtype=np.uint64)[line]
    powers = np.ones(len(line) + 1, np.uint64)
    powers[1:] = np.cumprod(np.full(len(line), _BASE, np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum(values * powers[:-1])]
    found = set()
    for root in roots:
        i = np.flatnonzero((root > 0) & (np.maximum(power * root, least) <= size))
        q = root[i]
        right = _reach(sums, powers, i, i + q, len(line) - i - q, False)
        back = _reach(sums, powers, i, i + q, i, True)
        ok = right + back + q >= np.maximum(power * q, least)
        spans = zip(q[ok].tolist(), (i - back)[ok].tolist(), (i + q + right)[ok].tolist(), strict=True)
        for (period, s, e), at in dict(zip(spans, i[ok].tolist(), strict=True)).items():
            start, end = _exact(line, s, e, period, at)
            if end - start >= max(power * period, least):
                found.add((int(origin[start]), end - start, period))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def collapsed_places(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def periodic_runs(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
                  least: int = MIN_LENGTH, power: int = MIN_POWER) -> DataFrame:
    """One row per document: id, n_words, runs (start, length, period; by start, then period) and
    collapsed, the words that stay joined by one space. ``edit`` may change a document's words first.
    """
    bounded_batches(spark)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_py().encode().split() for t in b.column(1)]
            if edit is not None:
                texts = [edit(i.as_py(), words) for i, words in zip(b.column(0), texts, strict=True)]
            sizes = np.array([len(words) for words in texts], np.int64)
            names: dict[bytes, int] = {}
            codes = np.array([names.setdefault(w, len(names)) for words in texts for w in words], np.int64)
            found = find_runs(codes, np.repeat(np.arange(len(texts)), sizes), least, power)
            first = np.r_[0, np.cumsum(sizes)]
            cut = np.searchsorted(found[:, 0], first)
            collapsed = []
            for k, words in enumerate(texts):
                own = found[cut[k]:cut[k + 1]]
                own[:, 0] -= first[k]
                if len(own):
                    stay = collapsed_places(len(words), own)
                    words = [w for w, keep in zip(words, stay.tolist(), strict=True) if keep]
                collapsed.append(b" ".join(words))
            rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, c])) for c in range(3)], fields=list(run_type))
            yield pa.record_batch([b.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows),
                                   pa.array(collapsed, pa.binary()).cast(pa.string())],
                                  names=["id", "n_words", "runs", "collapsed"])

    return slim.mapInArrow(run, "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                                "collapsed string")

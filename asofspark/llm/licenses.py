"""License scans: an exact set-similarity join of text blocks with license notices.

A block is every window of a text's words, over line ends, as wide as a notice and a quarter more; its
set are its distinct words. A notice is found where a window contains at least ``threshold`` of the
notice's distinct words and all words of its core, those that tell it from its likes. So a wrapped, indented or
commented notice is met like one on a line of its own, and words strewn over a long line are not.

Windows are not enumerated. Words are ordered by how many texts of the corpus hold them, rarest first.
Of a notice with ``m`` words of which ``o = ceil(threshold * m)`` must be met, a window that meets them
holds one of the notice's first ``m - o + 1`` words (prefix filter). Around the places of such words a text is
cut into stretches that hold every such window; a stretch is joined with the notices of its prefix
words when it has ``o`` words of the vocabulary (length filter) and when, of the first common word, at place i of the
stretch's ordered words and j of the notice's, ``1 + min(words after i, words after j) >= o``
(positional filter). What passes is compared in full: a window slides over the stretch.

The notices are few and fixed, so the index over their prefixes is a table of bounded size and is
broadcast; a stretch without enough words is dropped where it is read. Stretches are
joined with the index as rows, so a notice in a third of all documents is spread like any rows.

Besides, the base phrases are counted wherever their words stand consecutively in a text.

Cases: a null or blank text has no words: counts 0, null places, empty labels, score 0. Rows that
share an id are told apart by the hash of their text; equal rows have equal results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, text_of, written

THRESHOLD = 0.8
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Phrases that are counted wherever they stand, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Customary notices, their labels and the words of their core.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                   "except in compliance with the License.", "apache"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", "redistribution"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons attribution"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", "cc nc"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", "cc sa"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License as published by the Free Software Foundation", "gnu"),
    ("mit", "Released under the MIT License.", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", "granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla"),
]


def span_of(n: int) -> int:
    """Words of a window for a notice of ``n`` words."""
    return n + -(-n // 4)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return _WORD.findall(text.encode().lower())


def vocabulary(notices: list[tuple[str, str, str]]) -> list[bytes]:
    return sorted({w for _, text, _ in notices for w in words_of(text)})


def frequencies(docs: DataFrame, words: list[bytes]) -> np.ndarray:
    """In how many texts of the corpus each word stands; one row per word reaches the driver."""
    at = {w: k for k, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(at), np.int64)
        for b in batches:
            for text in b.column(0):
                for w in at.keys() & words_of(text.as_py()):
                    n[at[w]] += 1
        yield pa.record_batch([pa.array(np.arange(len(n))), pa.array(n)], names=["word", "n"])

    sums = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(words), np.int64)
    for r in sums.collect():
        out[r.word] = r.n
    return out


def ranking(words: list[bytes], counts: np.ndarray) -> dict[bytes, int]:
    """The global order: rarest first, ties by the word."""
    order = sorted(range(len(words)), key=lambda k: (counts[k], words[k]))
    return {words[k]: r for r, k in enumerate(order)}


def index(notices: list[tuple[str, str, str]], rank: dict[bytes, int], threshold: float) -> list[dict]:
    """Per notice: label, its words' ranks (ascending), how many must be met, prefix, core and span."""
    out = []
    for label, text, core in notices:
        words = words_of(text)
        ranks = sorted({rank[w] for w in words})
        need = max(1, math.ceil(threshold * len(ranks) - 1e-9))
        out.append({"label": label, "ranks": ranks, "need": need, "prefix": ranks[:len(ranks) - need + 1],
                    "core": sorted({rank[w] for w in words_of(core)}), "span": span_of(len(words))})
    return out


def stretches(words: list[bytes], rank: dict[bytes, int], heads: frozenset, span: int) -> Iterator[tuple[list[int], list[int]]]:
    """``(places, ranks)`` of the vocabulary's words in the stretches of a text that lie less than ``span``
    words from a head's place; every window that holds a head is inside one stretch."""
    found = [(k, rank[w]) for k, w in enumerate(words) if w in rank]
    marks = [k for k, r in found if r in heads]
    if not marks:
        return
    at = np.array(marks)
    cut = np.flatnonzero(np.diff(at) >= 2 * span - 1) + 1
    places = np.array([k for k, _ in found])
    for part in np.split(at, cut):
        lo, hi = np.searchsorted(places, [part[0] - span + 1, part[-1] + span])
        yield [k for k, _ in found[lo:hi]], [r for _, r in found[lo:hi]]


def best_window(places: list[int], ranks: list[int], notice: dict) -> int:
    """Most distinct words of the notice in a window of its span that holds its whole core; 0 where no
    window holds as many as are needed."""
    wanted, core, span = set(notice["ranks"]), notice["core"], notice["span"]
    held: dict[int, int] = {}
    best, lo = 0, 0
    hits = [(k, r) for k, r in zip(places, ranks, strict=True) if r in wanted]
    for k, r in hits:
        held[r] = held.get(r, 0) + 1
        while hits[lo][0] <= k - span:
            old = hits[lo][1]
            held[old] -= 1
            if not held[old]:
                del held[old]
            lo += 1
        if len(held) > best and len(held) >= notice["need"] and all(c in held for c in core):
            best = len(held)
    return best


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """``(start, label)`` of every place where a phrase's words stand consecutively."""
    found = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split()
        at = -1
        try:
            while True:
                at = words.index(parts[0], at + 1)
                if words[at:at + len(parts)] == parts:
                    found.append((at, label))
        except ValueError:
            pass
    return found


def scan(spark: SparkSession, docs: DataFrame, *, threshold: float = THRESHOLD, notices=NOTICES, phrases=PHRASES,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(documents, matches)``: per row id, text_key, n_words, n_base, first_word, last_word,
    base; and per met notice in a stretch id, text_key, notice, label, containment.
    """
    bounded_batches(spark)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    words = vocabulary(notices)
    order = ranking(words, frequencies(slim, words))
    idx = index(notices, order, threshold)
    heads = frozenset(r for n in idx for r in n["prefix"])
    head_words = {w for w, r in order.items() if r in heads}
    shortest, widest = min(n["need"] for n in idx), max(n["span"] for n in idx)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_base, first, last, base, blocks = [], [], [], [], [], []
            for text in b.column(1):
                total, met = words_of(text.as_py()), []
                if not head_words.isdisjoint(total):
                    for places, ranks in stretches(total, order, heads, widest):
                        own = sorted(set(ranks))
                        if len(own) >= shortest:
                            met.append({"places": places, "ranks": ranks, "own": own})
                found = phrase_places(total, phrases)
                n_words.append(len(total)), n_base.append(len(found))
                first.append(min(found)[0] if found else None), last.append(max(found)[0] if found else None)
                base.append(sorted({label for _, label in found})), blocks.append(met)
            ints = pa.list_(pa.int32())
            yield pa.record_batch(
                [b.column(0), b.column(2), pa.array(n_words, pa.int64()), pa.array(n_base, pa.int64()),
                 pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base, pa.list_(pa.string())),
                 pa.array(blocks, pa.list_(pa.struct([("places", ints), ("ranks", ints), ("own", ints)])))],
                names=["id", "text_key", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    schema = ("id long, text_key long, n_words long, n_base long, first_word long, last_word long, base array<string>, "
              "blocks array<struct<places: array<int>, ranks: array<int>, own: array<int>>>")
    keyed = slim.withColumn("text_key", F.xxhash64("text")).select("id", "text", "text_key")
    rows = written(spark, keyed.mapInArrow(run, schema), "licenses")

    prefixes = spark.createDataFrame(  # one row per word of a notice's prefix
        [(k, n["ranks"], n["need"], r, p) for k, n in enumerate(idx) for p, r in enumerate(n["prefix"])],
        "notice int, words array<int>, need int, head int, place int")
    blocks = rows.select("id", "text_key", F.explode("blocks").alias("b")).select("id", "text_key", "b.*").distinct()
    probes = blocks.select("*", F.posexplode("own").alias("at", "rank"))
    left = F.least(F.size("own") - F.col("at"), F.size("words") - F.col("place"))  # the common word itself and those after it
    # a stretch meets a notice's prefix at several words: the first common one stands for it
    first_met = F.array_min(F.array_intersect("own", "words")) == F.col("rank")
    near = (probes.join(F.broadcast(prefixes), F.col("rank") == F.col("head"))
            .where(first_met & (F.size("own") >= F.col("need")) & (left >= F.col("need"))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [best_window(places, ranks, idx[k]) for k, places, ranks in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)), strict=True)]
            share = [n / len(idx[k]["ranks"]) for n, k in zip(got, b.column(2).to_pylist(), strict=True)]
            label = [idx[k]["label"] for k in b.column(2).to_pylist()]
            out = pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(label, pa.string()), pa.array(share, pa.float64())],
                                  names=["id", "text_key", "notice", "label", "containment"])
            yield out.filter(pa.array([n > 0 for n in got], pa.bool_()))

    matches = near.select("id", "text_key", "notice", "places", "ranks").mapInArrow(
        compare, "id long, text_key long, notice int, label string, containment double")
    return rows.drop("blocks"), matches


def license_report(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score (the best containment met, else 0), n_notices (notices that are met).
    """
    rows, matches = scan(spark, docs, **options)
    best = matches.groupBy("id", "text_key").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best"), F.countDistinct("notice").alias("n_notices"))
    best = best.withColumnRenamed("id", "m_id").withColumnRenamed("text_key", "m_key")
    out = rows.join(best, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select("id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base", ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.array_distinct(F.concat("base", found))), ",").alias("labels"),
                      F.coalesce("best", F.lit(0.0)).alias("score"), F.coalesce("n_notices", F.lit(0)).alias("n_notices"))

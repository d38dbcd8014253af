"""Archives read by member: many tasks an archive, damage confined to its member."""

import io
import os
import random
import zipfile
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from asofspark.session import scratch_path
from asofspark.sources import archive as AR
from asofspark.sources import members as MB


def csv_text(k, lines=200):
    rng = random.Random(k)
    return ("﻿A, B ,C\r\n" + "".join(f"{k},{n},\"{rng.random()} é\n\"\r\n" for n in range(lines)) + " , ,\r\n").encode()


def zipped(*members, method=zipfile.ZIP_DEFLATED):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", method) as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def bundle(n=30):
    return zipped(*[(f"{k}.posting.zip", zipped((f"cdr.{k}.csv", csv_text(k)))) for k in range(n)], ("README.txt", b"noise"),
                  ("plain.csv", csv_text(99)), ("deep.zip", zipped(("in.zip", zipped(("x.csv", csv_text(7)), ("y.csv", csv_text(8)))))))


def folder(spark, **files):
    root = scratch_path(spark, "members")
    here = urlparse(root).path
    os.makedirs(here)
    for name, data in files.items():
        with open(f"{here}/{name}.zip", "wb") as f:
            f.write(data)
    return root


def rows(df):
    parts = df.withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1)).collect()
    return sorted((tuple(r) for r in parts), key=repr)


@pytest.mark.parametrize("size", [1, 5000, 1 << 20])
def test_same_records_as_whole_archives(spark, size):
    root = folder(spark, a=bundle(), b=zipped(("only.csv", csv_text(1))), c=bundle(3))
    whole = rows(AR.unpack(AR.read_archives(spark, root)))
    assert rows(MB.read_members(spark, root, size=size, tasks=5)) == whole and len(whole) > 7000


def test_one_bundle_is_read_by_all_tasks(spark):
    root = folder(spark, big=bundle(60))
    got = MB.read_members(spark, root, size=3000, tasks=6)
    per = got.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count_distinct("doc").alias("docs")).collect()
    assert len(per) == 6 and all(r.docs < 25 for r in per)


def damaged(data, member):
    """``data`` with bytes inside one member's compressed data overwritten."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        info = z.getinfo(member)
    at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
    return data[:at] + b"\xff" * 20 + data[at + 20:]


def test_damage_stays_with_its_member(spark):
    good = bundle(6)
    torn = zipped(("0.zip", zipped(("a.csv", csv_text(1)))), ("1.zip", b"no zip at all"), ("2.zip", zipped(("b.txt", b""))),
                  ("3.zip", zipped(("c.csv", b""))), ("bad.csv", b"A,B\r\n\xff\xfe\r\n"), ("4.zip", zipped(("d.csv", csv_text(4)))))
    root = folder(spark, good=good, hurt=damaged(good, "2.posting.zip"), torn=torn, junk=b"not a zip", cut=zipped(("a.csv", csv_text(1)))[:-40], none=zipped(("x.txt", b"")))
    got = MB.read_members(spark, root, size=1000, tasks=4)
    problems = {(os.path.basename(r.path), r.doc, r.member): r.problem for r in got.filter("problem is not null").collect()}
    assert problems == {
        ("hurt.zip", "2.posting.zip", None): "unreadable member: " + problems["hurt.zip", "2.posting.zip", None].split(": ")[1],
        ("torn.zip", "1.zip", None): "unreadable archive: BadZipFile", ("torn.zip", "2.zip", None): "archive without a CSV member",
        ("torn.zip", "3.zip", "c.csv"): "CSV member without a header", ("torn.zip", None, "bad.csv"): "unreadable member: UnicodeDecodeError",
        ("junk.zip", None, None): "unreadable archive: BadZipFile", ("cut.zip", None, None): "unreadable archive: BadZipFile",
        ("none.zip", None, None): "archive without a CSV member"}
    lines = {(os.path.basename(r.path), r.n) for r in got.filter("cells is not null").groupBy("path").agg(F.count("*").alias("n")).collect()}
    per = 200
    assert lines == {("good.zip", 9 * per), ("hurt.zip", 8 * per), ("torn.zip", 2 * per)}


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.read_bytes += len(out)
        return out


def test_a_slice_reads_its_members_and_the_directory_only(monkeypatch):
    data = zipped(*[(f"{k}.csv", csv_text(k, 3000)) for k in range(20)])
    monkeypatch.setattr(MB, "_open", lambda path: opened.append(Counting(data)) or opened[-1])
    opened = []
    with MB._open("x") as f, zipfile.ZipFile(f) as z:
        slices = MB.slices_of("x", z.infolist(), len(data) // 5)
    assert opened[0].read_bytes < 0.05 * len(data) and 4 <= len(slices) <= 6
    assert sum(len(s["members"]) for s in slices) == 20
    read = 0
    for s in slices:
        assert sum(r[7] is not None for r in MB.slice_records("x", s["members"])) == 3000 * len(s["members"])
        assert opened[-1].read_bytes < s["bytes"] + 0.05 * len(data)
        read += opened[-1].read_bytes
    assert read < 1.3 * len(data)


def test_no_archives(spark):
    root = folder(spark)
    assert MB.read_members(spark, root, tasks=3).count() == 0

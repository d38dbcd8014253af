"""Current values: only changed keys are emitted and written; replays and late rows change nothing."""

import datetime as dt
import random

import pytest

from asofspark.session import scratch_path
from asofspark.sources import lake as LK
from asofspark.streaming import current as CU

SCHEMA = "k string, posted timestamp_ntz, seq int, v double"
HOW = {"key": ["k"], "posted": "posted", "tie": "seq"}
START = dt.datetime(2024, 1, 1)


def drop(spark, landing, rows):
    rows = [(k, START + dt.timedelta(minutes=m) if m is not None else None, s, v) for k, m, s, v in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def step(spark, at):
    CU.run_current(spark.readStream.schema(SCHEMA).parquet(at["landing"]), at["out"], at["ckpt"], **HOW)


def written(spark, at):
    """Rows of every micro-batch's changes."""
    fs, p = LK._fs(spark, f"{at['out']}/changes")
    names = sorted((s.getPath().getName() for s in fs.listStatus(p)), key=lambda n: int(n[9:]))
    return [spark.read.parquet(f"{at['out']}/changes/{n}").count() for n in names]


def table(spark, at):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {r.k: (r.posted, r.seq, r.v) for r in CU.read_current(spark, at["out"], schema, **HOW).collect()}


@pytest.fixture
def at(spark):
    return {n: scratch_path(spark, n) for n in ("landing", "out", "ckpt")}


def test_writes_follow_the_changed_keys(spark, at):
    rng = random.Random(1)
    keys = [f"k{n}" for n in range(60)] + [None]
    known = {}
    drops = [[(k, rng.randrange(100), 0, rng.random()) for k in keys for _ in range(3)],
             [(k, 200, 1, 1.0) for k in keys[:4]] + [(k, 0, -1, 9.0) for k in keys],  # four newer, all others late
             [(k, 0, -2, 9.0) for k in keys],  # only late rows
             [(None, 300, 2, 2.0), ("new", 5, 0, 3.0), ("k1", 200, 5, 4.0)]]  # a tie is broken by seq
    for rows in drops:
        drop(spark, at["landing"], rows)
        step(spark, at)
        for k, m, s, v in rows:
            here = (START + dt.timedelta(minutes=m), s, v)
            if k not in known or here[:2] > known[k][:2]:
                known[k] = here
        assert {k: x[:2] for k, x in table(spark, at).items()} == {k: x[:2] for k, x in known.items()}
    assert written(spark, at) == [61, 4, 0, 3]
    step(spark, at)  # nothing new
    assert len(table(spark, at)) == 62


def test_changes_are_folded_when_they_outgrow_the_base(spark, at):
    drop(spark, at["landing"], [(f"k{n}", 0, 0, 0.0) for n in range(20)])
    step(spark, at)
    assert CU._base(spark, at["out"])[0] == 0
    for m in (1, 2, 3):
        drop(spark, at["landing"], [(f"k{n}", m, 0, float(m)) for n in range(8)])
        step(spark, at)
    assert CU._base(spark, at["out"])[0] == 3  # 24 changes over 20 rows
    found = table(spark, at)
    assert len(found) == 20 and found["k0"][2] == 3.0 and found["k19"][2] == 0.0


def test_rows_without_a_time_come_first(spark, at):
    drop(spark, at["landing"], [("a", None, 1, 1.0), ("b", 3, 1, 2.0)])
    step(spark, at)
    drop(spark, at["landing"], [("a", 0, 0, 5.0), ("b", None, 9, 7.0)])
    step(spark, at)
    assert {k: v[2] for k, v in table(spark, at).items()} == {"a": 5.0, "b": 2.0}


def test_a_lost_checkpoint_gives_the_same_table(spark, at):
    drop(spark, at["landing"], [("a", 1, 0, 1.0), ("a", 2, 0, 2.0), ("b", 1, 0, 3.0)])
    step(spark, at)
    want = table(spark, at)
    other = {**at, "ckpt": scratch_path(spark, "ckpt"), "out": scratch_path(spark, "out")}
    step(spark, other)
    assert table(spark, other) == want == {"a": (START + dt.timedelta(minutes=2), 0, 2.0), "b": (START + dt.timedelta(minutes=1), 0, 3.0)}


def test_state_is_kept_without_a_python_worker(spark, at):
    drop(spark, at["landing"], [("a", 1, 0, 1.0)])
    stream = spark.readStream.schema(SCHEMA).parquet(at["landing"])
    plan = CU.changes(stream, **HOW)._jdf.queryExecution().analyzed().toString()
    assert "max_by" in plan and "Python" not in plan and "TransformWithState" not in plan
    assert "TransformWithState" in CU.changes(stream, idle_ms=1000, **HOW)._jdf.queryExecution().analyzed().toString()


def test_a_replayed_batch_writes_the_same_changes(spark, at):
    drop(spark, at["landing"], [(f"k{n}", 5, 0, 0.0) for n in range(20)])
    step(spark, at)
    drop(spark, at["landing"], [(f"k{n}", 9 * (n % 2), 0, 1.0) for n in range(20)] + [("k1", 9, 0, 1.0), ("k0", 5, 0, 7.0)])
    step(spark, at)
    want = table(spark, at)
    assert written(spark, at) == [20, 10] and want["k0"][2] == 0.0  # an equal row changes nothing
    fs, p = LK._fs(spark, f"{at['ckpt']}/commits")
    assert fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, "1"), False)  # as if the run had ended before its commit
    step(spark, at)
    assert written(spark, at) == [20, 10] and table(spark, at) == want

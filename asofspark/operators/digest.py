"""Order-free multiset digests of rows, and trees of them (JN05, JOB08, JOB16, JOB09).

A digest of a set of rows is their number and the exact sums of two independent 64-bit hashes: it does not
depend on order or partitioning, counts repeated rows, and the digest of several batches is the sum of
theirs. One aggregate with partial combining gives the digests of all batches; any two sets of batches are
then compared without their rows.

* :func:`held_by_digest`: whether a merged batch holds its group's source batches. Where their digests sum to its own
  they are held; only groups in which any part of the digest disagrees are compared row by row.
* :func:`differing`: where two lakes differ. Their batch digests are summed to days and products, and only
  differing products are descended into, then only their differing days.

NULLs are told apart from absent values: each row also hashes which of its columns are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEEDS = (17, 20240229)
PARTS = ["n", "s1", "s2"]


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of a row's values and of which are NULL, as a decimal that sums exactly."""
    nulls = F.concat_ws("", *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *[F.col(c) for c in columns]).cast("decimal(38,0)")


def digests(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``(*by, n, s1, s2)``: the digest of every group's rows over ``columns`` (default: all others)."""
    data = sorted(columns if columns is not None else [c for c in df.columns if c not in by])
    one, two = (F.sum(row_hash(data, s)) for s in SEEDS)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), one.alias("s1"), two.alias("s2"))


def added(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Digests summed to coarser groups."""
    return table.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))


def _same() -> Column:
    out = F.lit(True)
    for p in PARTS:
        out = out & F.col(p).eqNullSafe(F.col(f"o_{p}"))
    return out


def _null_safe(names: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for c in names:
        out = out & F.col(c).eqNullSafe(F.col(prefix + c))
    return out


def held_by_digest(df: DataFrame, *, batch: str, merged: str, by: Sequence[str], exact) -> DataFrame:
    """``(*by, batch, n_rows, held)`` of the source batches of every group of ``by``. ``exact(df)`` gives the same
    columns from the rows, and is asked only for groups whose digests disagree."""
    by = list(by)
    per = digests(df, [*by, batch, merged])
    source = F.col(merged).isNull() | (F.col(batch) != F.col(merged))
    whole = added(per.filter(~source), by).select(*[F.col(c).alias(f"o_{c}") for c in (*by, *PARTS)])
    sums = added(per.filter(source), by)
    agree = sums.join(whole, _null_safe(by, "o_"), "inner").filter(_same()).select(*[F.col(c).alias(f"a_{c}") for c in by], F.lit(True).alias("__agree"))
    told = per.filter(source).join(agree, _null_safe(by, "a_"), "left_semi").select(
        *by, batch, F.col("n").alias("n_rows"), F.lit(True).alias("held"))
    return told.unionByName(exact(df.join(agree, _null_safe(by, "a_"), "left_anti")).select(*by, batch, "n_rows", "held"))


def _unlike(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups that only one side has or whose digests differ: ``(*by, n, o_n)``, the rows of both sides."""
    other = b.select(*[F.col(c).alias(f"o_{c}") for c in (*by, *PARTS)])
    j = a.join(other, _null_safe(by, "o_"), "full").filter(~_same())
    missing = F.col("n").isNull()
    return j.select(*[F.when(missing, F.col(f"o_{c}")).otherwise(F.col(c)).alias(c) for c in by], "n", "o_n")


def differing(a: DataFrame, b: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """The finest groups in which two tables of digests differ: ``(*levels[-1], n, o_n)`` with the rows of both sides
    (NULL where a side lacks the group). ``levels`` are ever finer lists of columns, such as
    ``[["product"], ["product", "date"], ["product", "date", "batch"]]``."""
    found = None
    for depth, by in enumerate(levels):
        x, y = a, b
        if found is not None:  # only below what differs
            up = levels[depth - 1]
            node = found.select(*[F.col(c).alias(f"d_{c}") for c in up])
            x, y = (t.join(node, _null_safe(up, "d_"), "left_semi") for t in (a, b))
        found = _unlike(added(x, by), added(y, by), by)
    return found

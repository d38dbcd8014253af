"""A pre-shuffled layout of versioned rows: bucketed and sorted by key (WIN01, JOB02, JN06).

Rows are shuffled once, when they are written; afterwards the latest row per key, and the as-of join of two layouts
of one key and bucket count, are planned without an exchange: each task reads its bucket. Under ``path``:

* ``even``: a bucketed table, sorted in each bucket by key and time, so that Parquet statistics
  skip row groups on the leading key columns;
* ``hot``: the rows of keys that hold too many rows for one bucket, not bucketed. Such a key holds more than a
  sixteenth of an even bucket's share and more than ``hot_rows`` rows, so there are fewer than 16 of them per bucket: a
  size that may be broadcast. They are read the ordinary way (partial top-1 before the shuffle, a join cut into segments);
* ``keys``: these hot keys, and ``about``, written last: a layout without it is not complete and is not opened.

A key lies wholly in one of the two parts, so answers are those of the rows as they came. Rows that
arrive later are given as ``extra``: they alone are shuffled, into the same buckets. NULL keys match one another. An
empty table has empty buckets.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from asofspark.operators import pit
from asofspark.sources import lake as LK

HOT_ROWS = 2_000_000
BUCKET_ROWS = 4_000_000


def _same(by: Sequence[str]):
    out = F.lit(True)
    for c in by:
        out = out & F.col(c).eqNullSafe(F.col(f"__hot_{c}"))
    return out


def _hot_keys(keys: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fewer than 16 a bucket: small enough to broadcast."""
    return F.broadcast(keys.select(*[F.col(c).alias(f"__hot_{c}") for c in by]))


def write(spark: SparkSession, rows: DataFrame, path: str, by: Sequence[str], *, sort: Sequence[str] = ("posted_at",),
          buckets: int | None = None, hot_rows: int = HOT_ROWS) -> Layout:
    """Lay ``rows`` out under a new ``path``, bucketed by ``by`` and sorted by ``by`` and ``sort``."""
    by = list(by)
    if LK.existing(spark, [path]):
        raise ValueError(f"{path} is there already: a layout is written once")
    n = rows.count()
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
    least = max(hot_rows, n // (16 * buckets))
    rows.groupBy(*by).count().filter(F.col("count") > least).select(*by).write.parquet(f"{path}/keys")
    keys = spark.read.parquet(f"{path}/keys")
    n_hot = keys.count()
    even = rows.join(_hot_keys(keys, by), _same(by), "left_anti") if n_hot else rows
    if n_hot:
        rows.join(_hot_keys(keys, by), _same(by), "left_semi").write.parquet(f"{path}/hot")
    about = {"by": by, "sort": [*by, *sort], "buckets": buckets, "n_hot": n_hot, "schema": rows.schema.jsonValue()}
    name = _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (even.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*about["sort"])
     .option("path", f"{path}/even").saveAsTable(name))
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.parquet(f"{path}/about")
    return open_layout(spark, path)


def _name(path: str) -> str:
    return f"asof_layout_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def open_layout(spark: SparkSession, path: str) -> Layout:
    """A layout that was written, in this session or another one."""
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    name, cols = _name(path), ST.StructType.fromJson(about["schema"])
    if not spark.catalog.tableExists(name):
        quoted = lambda names: ", ".join(f"`{c}`" for c in names)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols)
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({quoted(about['by'])}) "
                  f"SORTED BY ({quoted(about['sort'])}) INTO {about['buckets']} BUCKETS LOCATION '{path}/even'")
    return Layout(spark, path, about, name, cols)


class Layout:
    def __init__(self, spark: SparkSession, path: str, about: dict, name: str, cols: ST.StructType):
        self.spark, self.path, self.name, self.cols = spark, path, name, cols
        self.by, self.buckets, self.n_hot = about["by"], about["buckets"], about["n_hot"]

    def _keys(self) -> DataFrame | None:
        return self.spark.read.schema(ST.StructType([self.cols[c] for c in self.by])).parquet(f"{self.path}/keys") if self.n_hot else None

    def parts(self, extra: DataFrame | None = None, hot: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
        """``(even, hot)``: rows of keys that lie in the buckets, and of hot ones or those of ``hot`` (None
        where there are none). ``extra`` rows go to the part of their key."""
        even = self.spark.table(self.name)
        rest = self.spark.read.schema(self.cols).parquet(f"{self.path}/hot") if self.n_hot else None
        keys = hot if hot is not None else self._keys()
        if hot is not None:  # keys that are hot elsewhere leave the buckets too
            out = even.join(_hot_keys(hot, self.by), _same(self.by), "left_semi")
            rest = out if rest is None else rest.unionByName(out)
            even = even.join(_hot_keys(hot, self.by), _same(self.by), "left_anti")
        if extra is not None:
            extra = extra.select(*self.cols.names)
            if keys is not None:
                rest = rest.unionByName(extra.join(_hot_keys(keys, self.by), _same(self.by), "left_semi"))
                extra = extra.join(_hot_keys(keys, self.by), _same(self.by), "left_anti")
            even = even.unionByName(extra.repartition(self.buckets, *self.by))
        return even, rest

    def rows(self, extra: DataFrame | None = None) -> DataFrame:
        """All rows."""
        even, hot = self.parts(extra)
        return even if hot is None else even.unionByName(hot)

    def latest(self, key: Sequence[str], *, as_of, where=None, extra: DataFrame | None = None, posted: str = "posted_at",
               tie: str | None = "ingested_at") -> DataFrame:
        """The latest row per ``key`` known at ``as_of``; ``where`` narrows on key columns. ``key`` holds ``by``."""
        if not set(self.by) <= set(key):
            raise ValueError(f"a read by {list(key)} needs a layout by some of these columns, not by {self.by}")
        found = [pit.latest_as_of(df if where is None else df.filter(where), key=key, as_of=as_of, posted=posted, tie=tie)
                 for df in self.parts(extra) if df is not None]
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def as_of_join(decisions: Layout, facts: Layout, *, decision_time: str, posted: str, value_cols: Sequence[str]) -> DataFrame:
    """The as-of join (:func:`~asofspark.operators.pit.point_in_time_join`) on the key of two layouts of equal
    keys and bucket counts, bucket by bucket; keys that are hot in either one are joined in segments."""
    if decisions.by != facts.by or decisions.buckets != facts.buckets:
        raise ValueError("both layouts need the same key and number of buckets")
    keys = [k for k in (decisions._keys(), facts._keys()) if k is not None]
    hot = (keys[0] if len(keys) == 1 else keys[0].unionByName(keys[1]).distinct()) if keys else None
    # a union keeps its sides' partitioning only where the key's attributes are alike: a table's own are
    # qualified by its name, renamed ones are not
    named = {c: f"__by_{c}" for c in decisions.by}
    sides = [[None if df is None else df.withColumnsRenamed(named) for df in side.parts(hot=hot)] for side in (decisions, facts)]
    pairs = list(zip(*sides, strict=True))
    how = {"on": list(named.values()), "decision_time": decision_time, "posted": posted, "value_cols": value_cols}
    # no key of the buckets is hot: nothing to cut there
    out = pit.point_in_time_join(*pairs[0], **how, rows=None)
    out = out if hot is None else out.unionByName(pit.point_in_time_join(*pairs[1], **how))
    return out.withColumnsRenamed({v: c for c, v in named.items()})

"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source asks for a share of the whole in proportion to its weight and may be repeated at
most ``cap`` times. What a capped source cannot take is dealt to the others by weight until none
is above its cap. The outcome is ``target = least(cap * size, level * weight)`` for the one level
at which the targets add up to the whole, so instead of rounds the sources are sorted by the level
at which each reaches its cap and the level is read off running sums.

Sampling: ``target / source_size`` has a whole part, every document is taken that many times, and
a fractional part, met by one more copy of the first documents in a seeded order. The document at
which the running size passes the goal gives only the words that are missing, so a source takes
its target to the word. No document exceeds ``ceil(target / source_size)`` copies.

The running sum never sorts a whole source in one task: sizes are summed by (source, bin of the
seeded order), the sums of the bins are accumulated, and only the bin that the goal falls in is
ordered document by document.

Cases: a null text has size 0; a null source is a source of its own and comes last. Empty
documents are taken as often as others but weigh nothing. Sources of size 0 have target 0.
Rows of one source that agree in id and size share a place and share alike what is left there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofspark.llm.common import SPACE, WORD, packed, unpacked, written

SEED = 20240229
#: Hexadecimal digits of the seeded order that name a bin: 4096 bins a source.
BIN_DIGITS = 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)


def words_in(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def cycling_weights(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``weight`` by rank of the source: binary code point order, null last. One row a source."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    rank = (F.row_number().over(order) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), rank + 1))


def water_fill(sources: DataFrame, cap: float = 3.0, total: Column | None = None) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target``. One row a source, so the
    unpartitioned windows sort the list of sources, never documents.
    """
    everything = Window.partitionBy()
    order = Window.orderBy("fill", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("source_size").over(everything).cast("double") if total is None else total
    s = (sources.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
         .withColumn("fill", F.col("most") / F.col("weight"))
         .withColumn("whole", whole)
         .withColumn("weights", F.sum("weight").over(everything))
         .withColumn("capped", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         .withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         # the level if exactly the sources before this one are capped
         .withColumn("level", (F.col("whole") - F.col("capped")) / (F.col("weights") - F.col("spent"))))
    # the first source whose cap lies at or above that level sets it for all
    s = s.withColumn("n", F.row_number().over(order))
    s = s.withColumn("level", F.min(F.when(F.col("fill") >= F.col("level"),
                                           F.struct("n", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(
        F.least(F.col("most"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    """``row`` with id, source, size and the document's place in the seeded order."""
    get = F.col("row").getField
    slim = packed(docs).select(
        "row", get(id_col).cast("long").alias("id"), get(source_col).cast("string").alias("source"),
        words_in(F.coalesce(get(text_col).cast("string"), F.lit(""))).alias("size"))
    turn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    return (slim.withColumn("turn", F.substring(turn, 1, 16))
            .withColumn("bin", F.substring("turn", 1, BIN_DIGITS)))


def _same(left: list[str], right: list[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def _decided(rows: DataFrame, small: DataFrame, cap: float, weights: tuple[float, ...]) -> DataFrame:
    """``rows`` with source_size, target, whole and part; ``small`` holds (id, source, size, turn, bin)."""
    by_bin = small.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    sizes = by_bin.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    targets = water_fill(cycling_weights(sizes, weights), cap)
    ratio = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    targets = targets.withColumn("whole", F.coalesce(F.floor(ratio + 1e-12), F.lit(0)).cast("long"))
    goal = F.round(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")
    targets = targets.withColumn("goal", F.greatest(F.lit(0), goal)).withColumnRenamed("source", "its")

    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (by_bin.withColumn("bin_start", F.coalesce(F.sum("bin_size").over(ahead), F.lit(0)))
            .join(targets, F.col("source").eqNullSafe(F.col("its")))
            .select(F.col("its").alias("b_source"), F.col("bin").alias("b_bin"), "bin_size", "bin_start",
                    "source_size", "target", "whole", "goal"))
    # only the one bin of a source that its goal falls in is ordered document by document
    inside = (F.col("bin_start") < F.col("goal")) & (F.col("bin_start") + F.col("bin_size") > F.col("goal"))
    places = (small.join(bins.where(inside), _same(["source", "bin"], ["b_source", "b_bin"]))
              .groupBy("source", "bin", "turn", "id", "size", "bin_start", "goal").agg(F.count("*").alias("n")))
    within = (Window.partitionBy("source", "bin").orderBy("turn", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("bin_start") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(within), F.lit(0))
    each = F.floor((F.col("goal") - start) / F.col("n")).cast("long")
    cut = places.select(F.col("source").alias("c_source"), F.col("id").alias("c_id"), F.col("size").alias("c_size"),
                        F.greatest(F.lit(0), F.least(F.col("size"), each)).alias("c_part"))
    placed = (rows.join(bins, _same(["source", "bin"], ["b_source", "b_bin"]))
              .join(cut, _same(["source", "id", "size"], ["c_source", "c_id", "c_size"]), "left"))
    before = F.when(F.col("bin_start") + F.col("bin_size") <= F.col("goal"), F.col("size")).otherwise(F.lit(0))
    return placed.withColumn("part", F.coalesce("c_part", before).cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text", cap: float = 3.0, weights: tuple[float, ...] = WEIGHTS,
          seed: int = SEED) -> DataFrame:
    """One row per document: id, source, size, source_size, target, whole (full copies), part
    (words of one more copy) and taken (words in all).
    """
    small = written(spark, _sized(docs, id_col, source_col, text_col, seed).drop("row"), "sizes")
    return _decided(small, small, cap, weights).select(
        "id", "source", "size", "source_size", "target", "whole", "part",
        (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def mix(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", cap: float = 3.0, weights: tuple[float, ...] = WEIGHTS,
        seed: int = SEED) -> DataFrame:
    """The mixture itself: every document as often as it is taken, columns as in ``docs``.

    The one partial copy of a source holds the first ``part`` words, single-spaced. Documents
    that are not taken are absent.
    """
    sized = _sized(docs, id_col, source_col, text_col, seed)
    small = written(spark, sized.drop("row"), "sizes")
    out = _decided(sized, small, cap, weights)
    some = (F.col("part") > 0) & (F.col("part") < F.col("size"))
    full = F.col("whole") + F.when((F.col("part") > 0) & ~some, 1).otherwise(0)
    text = F.col("row").getField(text_col).cast("string")
    cut = F.call_function("substring_index", F.trim(F.regexp_replace(text, SPACE, " ")), F.lit(" "),
                          F.col("part").cast("int"))
    # copy 0 is the partial one
    copies = F.sequence(F.when(some, 0).otherwise(1), full.cast("int"))
    out = out.where(some | (full > 0)).withColumn("copy", F.explode(copies))
    row = F.when(F.col("copy") == 0, F.col("row").withField(text_col, cut)).otherwise(F.col("row"))
    return unpacked(out.select(row.alias("row")), docs.columns)

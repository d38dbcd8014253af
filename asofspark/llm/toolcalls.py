"""Tool-call linking, in DataFrame functions only.

Calls and results are hash-joined by (conversation, call id). A call is ordered after the calls it
needs: (step, level, position) is a topological order of its conversation. Arguments are parsed
as JSON variants, validated against the tool's schema, and the linked message is serialised as
canonical JSON: no blanks, keys sorted at every depth.

Order: most calls stand behind those they need already, and then their position is their step. One
join finds the needs that run against the positions; a conversation's span reaches from the first
call with such a need to the last call so needed. Only calls inside a span are ordered anew, by
Kahn's rounds over the needs inside it: they share the span's first position as step, and their
level is the longest chain before them in the span. Needs that cross a span's edge run with
the positions, so the order holds for the conversation. There are as many rounds as the longest
chain in a span is long, each written to the shared folder, and none for conversations in order;
conversations of any size are rows in joins, never a group in a task. Calls on or behind a cycle are
reported as cyclic, without a level: in a span they are never released, and from there the calls
after the span are reached over the needs by doubling paths, so a chain of 400 takes some 9 rounds.

Cases: of calls that share a conversation and id the first (by position, then content) counts, the
others are counted in ``copies``; so with results. A result without a call is a row of its own
(``orphan result``). A call without an id is linked to nothing (``no id``). Needs of unknown calls
are reported and do not hold a call back. Null arguments are malformed. A null conversation is a
conversation of its own. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import written

#: What a schema may ask for, and the variant types that satisfy it.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"),
         "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}

#: Paths kept for each edge while they double.
MANY_PATHS = 32


def _key(conv: str, call: Column) -> Column:
    """One string for (conversation, call id); null without an id."""
    return F.when(call.isNotNull(), F.to_json(F.struct(F.col(conv).alias("v"), call.alias("c"))))


def levels(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(key, level)`` of ``nodes(key)`` under ``edges(child, parent)``; cyclic nodes are absent."""
    waiting = written(spark, edges.select("child", "parent").distinct(), "waiting")
    front = written(spark, nodes.select("key").join(waiting, F.col("key") == F.col("child"), "left_anti")
                    .withColumn("level", F.lit(0)), "level")
    done, level = front, 0
    while not front.isEmpty():
        level += 1
        freed = waiting.join(front, F.col("parent") == F.col("key"), "left_semi").select("child").distinct()
        waiting = written(spark, waiting.join(front, F.col("parent") == F.col("key"), "left_anti"), "waiting")
        front = written(spark, freed.join(waiting.select("child"), "child", "left_anti")
                        .select(F.col("child").alias("key"), F.lit(level).alias("level")), "level")
        done = done.union(front)
    return done


def behind(spark: SparkSession, start: DataFrame, edges: DataFrame) -> DataFrame:
    """``start(key)`` and all that it reaches over ``edges(child, parent)``.

    Paths double in every round while they are few, so that a chain takes the logarithm of its length
    in rounds. Where needs branch, paths multiply: from ``MANY_PATHS`` times the edges on, their
    length stays, and the front moves on by that length in every round.
    """
    paths = written(spark, edges.select("child", "parent").distinct(), "paths")
    most, doubling = MANY_PATHS * paths.count(), True
    found = front = start.select("key")
    while True:
        # all that is nearer than the paths are long is found: what is new lies up to twice as far
        met = paths.join(front, F.col("parent") == F.col("key"), "left_semi").select(F.col("child").alias("key")).distinct()
        new = written(spark, met.join(found, "key", "left_anti"), "behind")
        if new.isEmpty():
            return found
        found = found.union(new)
        if doubling:
            first, then = paths.toDF("child", "via"), paths.toDF("via", "parent")
            twice = written(spark, first.join(then, "via").select("child", "parent").distinct(), "paths")
            doubling = twice.count() <= most
            paths = twice if doubling else paths
        front = found if doubling else new


def problems(name: Column, args: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Sorted list of what is wrong with the arguments ``args`` (a JSON string) of tool ``name``."""
    variant = F.try_parse_json(args)
    kind = F.schema_of_variant(variant)
    known = F.lit(None).cast("array<string>")
    for tool, fields in schemas.items():
        found = []
        for field, (wanted, required) in sorted(fields.items()):
            value = F.try_variant_get(variant, f"$.{field}", "variant")
            there = F.array_contains(F.json_object_keys(args), field)
            fits = F.lit(False)
            for prefix in TYPES[wanted]:
                fits = fits | F.schema_of_variant(value).startswith(prefix)
            wrong = F.when(there & ~F.coalesce(fits, F.lit(False)), F.lit(f"{field}: not of type {wanted}"))
            if required:
                wrong = F.when(~there, F.lit(f"{field}: missing")).otherwise(wrong)
            found.append(wrong)
        extra = F.array_except(F.json_object_keys(args), F.array(*map(F.lit, sorted(fields))))
        listed = F.concat(F.array(*found), F.transform(extra, lambda k: F.concat(k, F.lit(": not in the schema"))))
        known = F.when(name == tool, F.array_sort(F.array_compact(listed))).otherwise(known)
    known = F.coalesce(known, F.array(F.lit("unknown tool")))
    return (F.when(variant.isNull(), F.array(F.lit("arguments: not JSON")))
            .when(~kind.startswith("OBJECT"), F.array(F.lit("arguments: not an object"))).otherwise(known))


def link_tool_calls(spark: SparkSession, calls: DataFrame, results: DataFrame,
                    schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """One row per distinct call, and per result without one.

    ``calls(conv_id, pos, call_id, name, arguments, needs)``, ``results(conv_id, pos, call_id,
    content)``; ``schemas``: tool -> field -> (type, required). Returns conv_id, call_id, pos, name,
    step, level, status, problems, copies, result, result_copies, message (canonical JSON).
    """
    calls = calls.select("conv_id", "call_id", "pos", "name", "arguments", "needs").withColumn("key", _key("conv_id", F.col("call_id")))
    content = F.struct("pos", "name", "arguments", "needs")
    one = (calls.where("key is not null").groupBy("key", "conv_id", "call_id")
           .agg(F.min(content).alias("call"), F.count("*").alias("copies")))
    one = written(spark, one.select("key", "conv_id", "call_id", "call.*", "copies"), "calls")
    nameless = calls.where("key is null").withColumn("copies", F.lit(1).cast("long"))

    needs = one.select(F.col("key").alias("child"), F.explode("needs").alias("need"), "conv_id").where("need is not null")
    needs = needs.withColumn("parent", _key("conv_id", F.col("need"))).select("child", "parent", "need").distinct()
    there = one.select(F.col("key").alias("parent"))
    at = F.coalesce("pos", F.lit(-(1 << 63)))
    places = one.select("key", "conv_id", at.alias("at"))
    edges = (needs.join(places.select(F.col("key").alias("parent"), F.col("at").alias("parent_at")), "parent")
             .join(places.select(F.col("key").alias("child"), F.col("at").alias("child_at"), "conv_id"), "child"))
    against = edges.where("parent_at >= child_at")
    spans = written(spark, against.groupBy(F.struct("conv_id").alias("conv")).agg(
        F.min("child_at").alias("lo"), F.max("parent_at").alias("hi")), "spans")
    inside = (places.withColumn("conv", F.struct("conv_id")).join(spans, "conv")
              .where("at >= lo and at <= hi").select("key", "lo", "conv", "hi"))
    order, stuck = one.select("key").limit(0).withColumn("level", F.lit(0)), None
    if not spans.isEmpty():
        inside = written(spark, inside, "inside")
        held = inside.select("key")
        order = levels(spark, held, edges.join(held.toDF("child"), "child", "left_semi").join(held.toDF("parent"), "parent", "left_semi"))
        stuck = written(spark, inside.join(order, "key", "left_anti"), "stuck")
    order = inside.join(order, "key", "left").select(F.col("key").alias("o_key"), F.col("lo").alias("o_step"), F.col("level").alias("o_level"))
    if stuck is not None and not stuck.isEmpty():
        after = (edges.withColumn("conv", F.struct("conv_id")).join(stuck.select("conv", "hi").distinct(), "conv")
                 .where("child_at > hi"))
        later = behind(spark, stuck.select("key"), after).join(inside, "key", "left_anti")
        order = order.union(later.select("key", F.lit(None).cast("long"), F.lit(None).cast("int")))
    unknown = (needs.join(there, "parent", "left_anti").groupBy("child")
               .agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown need: "), "need"))).alias("lost")))

    first = (results.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), "pos", "content")
             .withColumn("r_key", _key("r_conv", F.col("r_call"))))
    first = first.groupBy("r_key", "r_conv", "r_call").agg(
        F.min(F.struct("pos", "content")).alias("r"), F.count("*").alias("result_copies"))
    linked = (one.withColumn("is_call", F.lit(True)).unionByName(nameless.withColumn("is_call", F.lit(True)))
              .join(first.hint("shuffle_hash"), F.col("key") == F.col("r_key"), "full_outer"))
    linked = (linked.join(order, F.col("key") == F.col("o_key"), "left")
              .join(unknown, F.col("key") == F.col("child"), "left"))
    found = F.concat(F.coalesce(problems(F.col("name"), F.col("arguments"), schemas), F.array().cast("array<string>")),
                     F.coalesce("lost", F.array().cast("array<string>")))
    status = (F.when(F.col("is_call").isNull(), "orphan result").when(F.col("call_id").isNull(), "no id")
              .when(F.col("cyclic"), "cyclic").when(F.size("problems") > 0, "invalid")
              .when(F.col("r_key").isNull(), "no result").otherwise("linked"))
    out = linked.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("call_id", "r_call").alias("call_id"),
        F.coalesce("pos", "r.pos").alias("pos"), "name", "arguments",
        F.when(F.col("is_call") & F.col("key").isNotNull(), F.coalesce("o_step", "pos")).alias("step"),
        F.when(F.col("is_call") & F.col("key").isNotNull() & F.col("o_key").isNull(), F.lit(0)).otherwise(F.col("o_level")).alias("level"),
        (F.col("o_key").isNotNull() & F.col("o_level").isNull()).alias("cyclic"), "is_call", "r_key", "copies",
        F.when(F.col("is_call"), found).otherwise(F.array().cast("array<string>")).alias("problems"),
        F.col("r.content").alias("result"), "result_copies")
    # fields are named in sorted order here; a variant keeps its keys sorted at every depth
    args = F.coalesce(F.try_parse_json("arguments"), F.parse_json(F.to_json(F.struct(F.col("arguments").alias("malformed")))))
    message = F.to_json(F.struct(args.alias("arguments"), F.col("call_id").alias("id"), "name", "result"))
    out = out.withColumn("status", status).withColumn("message", F.when(F.col("is_call"), message))
    return out.select("conv_id", "call_id", "pos", "name", "step", "level", "status", "problems", "copies", "result",
                      "result_copies", "message")

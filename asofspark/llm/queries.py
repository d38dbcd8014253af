"""Driver queries of the training-data operators: whole tables, production parameters.

Each query derives its digest columns from what its operator returns. ``ORACLES`` holds DuckDB
SQL where SQL expresses the operator; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm import annforest, exactdedup, iblt, importance, licenses, linededup, mixing, packing, runs, simhash, spelling, toolcalls, wavelet
from asofspark.llm.tokens import byte_bpe_path, word_bpe_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_quality_classifier(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = F.col("quality") == 1
    out = importance.resample(spark, documents(spark, sf_dir), importance.target_ids(labels, good),
                              share=importance.good_share(labels, good))
    return out.withColumnRenamed("id", "doc_id")


@query
def op2_license_scan(spark, sf_dir):
    return licenses.license_report(spark, documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def _quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _license_oracle() -> str:
    """Brute force: every window of every notice's width that starts at one of its words, every place of every phrase."""
    phrases = " UNION ALL ".join(
        f"SELECT {_quoted(p.split())} AS parts, '{label}' AS label" for p, label in licenses.PHRASES.items())
    notices = " UNION ALL ".join(
        f"SELECT {k} AS notice, {_quoted(sorted({w.decode() for w in licenses.words_of(t)}))} AS parts, {_quoted(core.split())} AS core, "
        f"{licenses.span_of(len(licenses.words_of(t)))} AS span, '{label}' AS label" for k, (label, t, core) in enumerate(licenses.NOTICES))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
    WITH phrase AS ({phrases}), notice AS ({notices}),
    d AS (SELECT doc_id, {lower} AS t, regexp_extract_all(t, {word}) AS w FROM documents),
    places AS (SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i+1] = parts[1]
                      AND w[i+1:i+len(parts)] = parts)) AS pos
               FROM d, phrase),
    base AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels
             FROM places GROUP BY doc_id),
    windows AS (SELECT doc_id, notice, label, parts, core, unnest(list_transform(
                  list_filter(range(len(w)), lambda i: list_contains(parts, w[i+1])),
                  lambda i: list_intersect(list_distinct(w[i+1:i+span]), parts))) AS held FROM d, notice),
    met AS (SELECT doc_id, notice, label, len(held) / len(parts) AS c FROM windows WHERE list_has_all(held, core)),
    best AS (SELECT doc_id, max(c) AS c, list(DISTINCT label) AS labels, count(DISTINCT notice) AS n
             FROM met WHERE c >= {licenses.THRESHOLD} - 1e-9 GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word,
           hi::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(best.labels, []))), ','), '')
             AS labels,
           coalesce(best.c, 0.0) AS score, coalesce(best.n, 0)::BIGINT AS n_notices
    FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


ORACLES["op2_license_scan"] = _license_oracle()


@query
def op3_fingerprints(spark, sf_dir):
    out = iblt.fingerprints(spark, documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next", F.size("gone").cast("long").alias("n_gone"),
                      F.size("come").cast("long").alias("n_come"))


#: Tools of the derived calls: field -> (type, required).
TOOLS = {
    "calculate": {"expression": ("string", True), "precision": ("integer", False)},
    "search": {"limit": ("integer", False), "query": ("string", True)},
    "translate": {"text": ("string", True), "to": ("string", True)},
}


def derived_calls(conversations: DataFrame) -> DataFrame:
    """Calls from user turns: the turn's whole text as an argument, needs of earlier turns, and faults
    (a wrong type, a missing field, an unknown field or tool, cut JSON, a lost need, a cycle).
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    said = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("v")))
    quoted = said.substr(F.lit(6), F.length(said) - 6)  # of {"v":"..."}
    tool = F.when(conv % 23 == 2, "unknown").otherwise(F.element_at(
        F.array(*map(F.lit, sorted(TOOLS))), ((conv + turn) % 3 + 1).cast("int")))
    number = F.when(conv % 11 == 5, F.concat(F.lit('"'), turn.cast("string"), F.lit('"'))).otherwise(turn.cast("string"))
    main = F.when(tool == "calculate", "expression").when(tool == "translate", "text").otherwise("query")
    other = F.when(tool == "calculate", F.concat(F.lit('"precision": '), number)).when(
        tool == "translate", F.lit('"to": "en"')).otherwise(F.concat(F.lit('"limit": '), number))
    args = F.concat(F.lit("{"), F.when(conv % 13 == 7, F.lit('"z": 1')).otherwise(F.concat(F.lit('"'), main, F.lit('": '), quoted)),
                    F.lit(", "), other, F.when(conv % 17 == 3, "").otherwise("}"))
    call = lambda t: F.concat_ws("_", F.lit("call"), conv.cast("string"), t.cast("string"))
    needs = F.array_compact(F.array(
        F.when(turn >= 2, call(turn - 2)), F.when((turn >= 4) & (conv % 2 == 0), call(turn - 4)),
        F.when(conv % 29 == 4, call(F.lit(999))), F.when((conv % 31 == 6) & (turn < 2), call(turn + 2))))
    return conversations.where("role = 'user'").select(
        "conv_id", turn.alias("pos"), call(turn).alias("call_id"), tool.alias("name"), args.alias("arguments"),
        needs.alias("needs"))


def derived_results(conversations: DataFrame) -> DataFrame:
    """Results from assistant turns: each answers the turn before it."""
    return conversations.where("role = 'assistant'").select(
        "conv_id", F.col("turn").alias("pos"),
        F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"))


@query
def op4_tool_calls(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = toolcalls.link_tool_calls(spark, derived_calls(conversations), derived_results(conversations), TOOLS)
    return out.select("conv_id", "call_id", F.col("pos").cast("long").alias("pos"), "name",
                      F.col("step").cast("long").alias("step"), F.col("level").cast("long").alias("level"), "status", F.array_join("problems", "; ").alias("problems"),
                      F.length("result").cast("long").alias("result_chars"), F.sha2(F.col("message").cast("binary"), 256).alias("message_sha256"))


ORACLES["op4_tool_calls"] = r"""
WITH RECURSIVE u AS (
  SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id,
         CASE WHEN conv_id % 23 = 2 THEN 'unknown'
              ELSE ['calculate', 'search', 'translate'][(conv_id + turn) % 3 + 1] END AS name,
         to_json(coalesce(text, ''))::VARCHAR AS said,
         CASE WHEN conv_id % 11 = 5 THEN '"' || turn || '"' ELSE turn::VARCHAR END AS num
  FROM conversations WHERE role = 'user'),
f AS (SELECT *, CASE name WHEN 'calculate' THEN 'expression' WHEN 'translate' THEN 'text' ELSE 'query' END AS main,
             CASE name WHEN 'calculate' THEN 'precision' WHEN 'translate' THEN 'to' ELSE 'limit' END AS other,
             CASE WHEN name = 'translate' THEN '"en"' ELSE num END AS val,
             conv_id % 13 = 7 AS odd, conv_id % 17 = 3 AS cut FROM u),
a AS (SELECT *, CASE WHEN odd THEN 'z' ELSE main END AS key1, CASE WHEN odd THEN '1' ELSE said END AS val1 FROM f),
n AS (SELECT conv_id, call_id AS child, unnest(list_filter([
        CASE WHEN turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END,
        CASE WHEN turn >= 4 AND conv_id % 2 = 0 THEN 'call_' || conv_id || '_' || (turn - 4) END,
        CASE WHEN conv_id % 29 = 4 THEN 'call_' || conv_id || '_999' END,
        CASE WHEN conv_id % 31 = 6 AND turn < 2 THEN 'call_' || conv_id || '_' || (turn + 2) END], lambda x: x IS NOT NULL)) AS need
      FROM u),
e AS (SELECT n.child, n.need AS parent FROM n JOIN u ON u.call_id = n.need),
lost AS (SELECT child, list_sort(list('unknown need: ' || need)) AS l
         FROM n WHERE NOT EXISTS (FROM u WHERE u.call_id = n.need) GROUP BY child),
span AS (SELECT c.conv_id, min(c.turn) AS lo, max(q.turn) AS hi FROM e JOIN u c ON c.call_id = e.child
         JOIN u q ON q.call_id = e.parent WHERE q.turn >= c.turn GROUP BY c.conv_id),
ins AS (SELECT u.call_id AS k, lo FROM u JOIN span USING (conv_id) WHERE turn BETWEEN lo AND hi),
ei AS (SELECT * FROM e WHERE child IN (SELECT k FROM ins) AND parent IN (SELECT k FROM ins)),
ring AS (SELECT x.child AS k FROM e x JOIN e b ON b.child = x.parent AND b.parent = x.child
         UNION SELECT e.child FROM ring JOIN e ON e.parent = ring.k),
path AS (SELECT k, 0 AS level FROM ins WHERE k NOT IN (SELECT k FROM ring)
         UNION SELECT ei.child, path.level + 1 FROM path JOIN ei ON ei.parent = path.k WHERE ei.child NOT IN (SELECT k FROM ring)),
lv AS (SELECT ins.k, any_value(lo) AS lo, max(level) AS level FROM ins LEFT JOIN path USING (k) GROUP BY ins.k),
r AS (SELECT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text FROM conversations WHERE role = 'assistant'),
p AS (SELECT a.*, coalesce(lv.lo, turn_) AS step, CASE WHEN a.call_id IN (SELECT k FROM ring) THEN NULL
        WHEN lv.k IS NULL THEN 0 ELSE lv.level END AS level, r.call_id AS answered, r.text AS result,
        CASE WHEN cut THEN ['arguments: not JSON'] WHEN name = 'unknown' THEN ['unknown tool'] ELSE list_sort(list_filter([
          CASE WHEN odd THEN main || ': missing' END, CASE WHEN odd THEN 'z: not in the schema' END,
          CASE WHEN a.conv_id % 11 = 5 AND name <> 'translate' THEN other || ': not of type integer' END], lambda x: x IS NOT NULL)) END
        || coalesce(lost.l, []) AS problems,
        CASE WHEN cut THEN '{"malformed":' || to_json('{"' || key1 || '": ' || val1 || ', "' || other || '": ' || val) || '}'
             WHEN key1 < other THEN '{"' || key1 || '":' || val1 || ',"' || other || '":' || val || '}'
             ELSE '{"' || other || '":' || val || ',"' || key1 || '":' || val1 || '}' END AS args
      FROM (SELECT *, turn AS turn_ FROM a) a LEFT JOIN lv ON lv.k = a.call_id LEFT JOIN r ON r.call_id = a.call_id LEFT JOIN lost ON lost.child = a.call_id)
SELECT conv_id, call_id, turn AS pos, name, step::BIGINT AS step, level::BIGINT AS level,
       CASE WHEN level IS NULL THEN 'cyclic' WHEN len(problems) > 0 THEN 'invalid' WHEN answered IS NULL THEN 'no result'
            ELSE 'linked' END AS status,
       coalesce(array_to_string(problems, '; '), '') AS problems, length(result)::BIGINT AS result_chars,
       sha256('{"arguments":' || args || ',"id":"' || call_id || '"'
              || ',"name":"' || name || '"' || CASE WHEN result IS NULL THEN '' ELSE ',"result":' || to_json(result) END || '}')
         AS message_sha256
FROM p
UNION ALL
SELECT r.conv_id, r.call_id, r.turn, NULL, NULL, NULL, 'orphan result', '', length(r.text), NULL
FROM r WHERE NOT EXISTS (FROM u WHERE u.call_id = r.call_id)
"""


@query
def op5_wavelet_shards(spark, sf_dir):
    folder = wavelet.shard_folder(spark)
    wavelet.write_shards(spark, documents(spark, sf_dir), folder, byte_bpe_path(), end_id=0)
    return wavelet.digests(spark, folder).withColumnRenamed("id", "doc_id")


@query
def op6_line_dedup(spark, sf_dir):
    out = linededup.report(spark, documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.col("n_lines").cast("long").alias("n_lines"),
                      F.concat_ws(",", F.transform("gone", lambda x: x.cast("string"))).alias("gone_lines"),
                      F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256"))


ORACLES["op6_line_dedup"] = r"""
WITH d AS (SELECT doc_id, text, coalesce(string_split(text, chr(10)), []) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no FROM d),
w AS (SELECT doc_id, no, list_filter(regexp_split_to_array(
        translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM l),
u AS (SELECT ws, len(ws) AS n, min({'doc_id': doc_id, 'no': no}) AS first FROM w WHERE len(ws) >= 1 GROUP BY ws),
-- every deletion variant of every distinct line, in the clear
v AS (SELECT ws, first, i, list_filter(ws, lambda x, k: k <> i) AS rest
      FROM (SELECT ws, first, unnest(range(1, n + 1)) AS i FROM u WHERE n >= 5)),
sub AS (SELECT rest, i, min(first) AS least FROM v GROUP BY rest, i),
del AS (SELECT rest, min(first) AS least FROM v GROUP BY rest),
near AS (
  SELECT v.ws FROM v JOIN sub USING (rest, i) WHERE sub.least < v.first
  UNION SELECT v.ws FROM v JOIN u ON u.ws = v.rest AND u.n >= 5 WHERE u.first < v.first
  UNION SELECT u.ws FROM u JOIN del ON del.rest = u.ws WHERE u.n >= 5 AND del.least < u.first),
g AS (SELECT w.doc_id, w.no FROM w JOIN u USING (ws)
      WHERE {'doc_id': w.doc_id, 'no': w.no} > u.first OR w.ws IN (SELECT ws FROM near)),
gone AS (SELECT doc_id, list_sort(list(no)) AS nos FROM g GROUP BY doc_id)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(array_to_string(nos, ','), '') AS gone_lines,
       sha256(CASE WHEN nos IS NULL THEN text ELSE coalesce(array_to_string(
         list_filter(ls, lambda x, k: NOT list_contains(nos, k - 1)), chr(10)), '') END) AS clean_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


@query
def op7_packing(spark, sf_dir):
    pieces = packing.pack(spark, documents(spark, sf_dir), word_bpe_path(), end_id=1)
    return pieces.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         F.col("offset").cast("long").alias("offset"))


@query
def op8_exact_dedup(spark, sf_dir):
    out = exactdedup.exact_dedup(spark, documents(spark, sf_dir), digests=True)
    return out.withColumnRenamed("id", "doc_id")


ORACLES["op8_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query
def op9_mixing(spark, sf_dir):
    out = mixing.mixed(spark, documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


ORACLES["op9_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('20240229:' || coalesce(doc_id::VARCHAR, 'null')), 1, 16) AS turn
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
                WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM s),
-- the level is the least one of which the capped demands reach the whole: try each source's own
f AS (SELECT *, 3.0::DOUBLE * source_size AS most, 3.0::DOUBLE * source_size / weight AS fill FROM w),
lv AS (SELECT a.fill AS edge,
              (SELECT sum(b.source_size)::DOUBLE - coalesce(sum(CASE WHEN b.fill < a.fill THEN b.most END), 0) FROM f b)
              / (SELECT sum(CASE WHEN b.fill >= a.fill THEN b.weight END) FROM f b) AS level FROM f a),
pick AS (SELECT level FROM lv WHERE edge >= level ORDER BY edge LIMIT 1),
t AS (SELECT source, source_size, least(most, (SELECT level FROM pick) * weight) AS target FROM f),
g AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size + 1e-12)::BIGINT END AS whole FROM t),
p AS (SELECT d.source, d.turn, d.doc_id, d.size, count(*) AS n FROM d GROUP BY ALL),
r AS (SELECT *, coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY turn, doc_id NULLS FIRST, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM p)
SELECT d.doc_id, d.size, g.source_size, g.target,
       (g.whole * d.size + greatest(0, least(d.size, floor(
         (greatest(0, round(g.target)::BIGINT - g.whole * g.source_size) - r.start) / r.n)::BIGINT)))::BIGINT AS taken
FROM d JOIN g ON g.source IS NOT DISTINCT FROM d.source
JOIN r ON r.source IS NOT DISTINCT FROM d.source AND r.doc_id IS NOT DISTINCT FROM d.doc_id AND r.size = d.size
"""


@query
def op10_simhash(spark, sf_dir):
    out = simhash.components_of(spark, documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id")


@query
def op11_ann_forest(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return annforest.nearest(spark, rows, rows.where("vec_id % 100 = 0"))


def with_slips(doc_id: int | None, run: str) -> str:
    """A run after the contract's edit: one code point goes where 31 divides the hash; without an id none."""
    h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
    k = h % len(run)
    return run if h % 31 else run[:k] + run[k + 1:]


@query
def op12_spelling_variants(spark, sf_dir):
    words = spelling.vocabulary(documents(spark, sf_dir), edit=with_slips)
    return spelling.spelling_groups(spark, words).select("word", "form", "root", "n", "n_near", "form_n")


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a document after the contract's edit: in every tenth document a stretch repeats to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((len(words) - a) // len(period) + 1))[:len(words) - a]


@query
def op13_periodic_runs(spark, sf_dir):
    out = runs.periodic_runs(spark, documents(spark, sf_dir), edit=with_repeats)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (out.withColumn("best", best).select(
        F.col("id").alias("doc_id"), "n_words", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))

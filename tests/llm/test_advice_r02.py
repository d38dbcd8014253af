"""Whole jobs where an earlier round did less: brute force over small tables."""

import json
import random

from asofspark.llm import linededup, queries, toolcalls

CALLS = "conv_id long, pos long, call_id string, name string, arguments string, needs array<string>"


def _reached(needs, conv, k):
    seen, todo = set(), list(needs[conv, k])
    while todo:
        x = todo.pop()
        if x not in seen:
            seen.add(x)
            todo += needs[conv, x]
    return seen


def test_calls_behind_a_cycle_are_cyclic_wherever_they_stand(spark, monkeypatch):
    rng = random.Random(5)
    needs = {}
    for conv in range(40):
        n = rng.randint(3, 14)
        for k in range(n):
            needs[conv, k] = {rng.randrange(k) for _ in range(rng.randint(0, 2)) if k}
        a, b = sorted(rng.sample(range(n), 2))
        if conv % 2:
            needs[conv, a] |= {b}  # a need against the positions, a cycle in some
        if conv % 4 == 1:
            needs[conv, b] |= {a}
    for k in range(70):  # a chain behind a cycle, and one with branches
        for conv, back in ((90, (1,)), (91, (1, 2))):
            needs[conv, k] = {k - x for x in back if k >= x} | ({1} if k == 0 else set())
    rows = [(conv or None, k, str(k), "search", '{"query":"x"}', [str(x) for x in own]) for (conv, k), own in needs.items()]
    none = spark.createDataFrame([], "conv_id long, pos long, call_id string, content string")
    want = {key for key in needs for up in [_reached(needs, *key)]
            if key[1] in up or any(x in _reached(needs, key[0], x) for x in up)}
    assert any(k > 60 for _, k in want) and len(want) < len(needs)
    for many in (toolcalls.MANY_PATHS, 4):
        monkeypatch.setattr(toolcalls, "MANY_PATHS", many)
        out = toolcalls.link_tool_calls(spark, spark.createDataFrame(rows, CALLS), none, queries.TOOLS).collect()
        assert len(out) == len(rows)
        assert {(r.conv_id or 0, r.pos) for r in out if r.status == "cyclic"} == want
        assert all((r.level is None) == (r.status == "cyclic") for r in out)


def test_derived_calls_carry_the_whole_turn(spark):
    texts = ["a \"quoted\" word,\na \\ and\ttabs, é \U0001f600 and \x01 " + "long " * 200, "", None, "{\"v\":\"1\"}", "short"]
    rows = [(conv, 0, "user", t) for conv, t in zip((1, 2, 4, 5, 8), texts, strict=True)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    calls = queries.derived_calls(turns)
    for r in calls.collect():
        said = [v for k, v in json.loads(r.arguments).items() if k in ("expression", "query", "text")]
        assert said == [dict((c, t or "") for c, _, _, t in rows)[r.conv_id]]
    none = spark.createDataFrame([], "conv_id long, pos long, call_id string, content string")
    for r in toolcalls.link_tool_calls(spark, calls, none, queries.TOOLS).collect():
        said = [v for k, v in json.loads(r.message)["arguments"].items() if k in ("expression", "query", "text")]
        assert said == [dict((c, t or "") for c, _, _, t in rows)[r.conv_id]]


def test_short_lines_are_deduplicated(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 7))) for _ in range(300)] + ["les.", "Les. ", "and ornd."] * 4
    rng.shuffle(lines)
    rows = [(k, "\n".join(lines[s:s + 6]), "s") for k, s in enumerate(range(0, len(lines), 6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.id: r.gone for r in linededup.report(spark, docs).collect()}
    seen, gone = [], {}
    for k, text, _ in rows:
        gone[k] = []
        for no, line in enumerate(text.split("\n")):
            w = linededup.words_of(line)
            if w and any(w == x or (min(len(w), len(x)) >= 5 and linededup.within_one_edit(w, x)) for x in seen):
                gone[k].append(no)
            seen.append(w)
    assert got == gone
    assert sum(map(len, gone.values())) > 200

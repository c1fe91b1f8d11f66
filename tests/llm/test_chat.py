from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import chat

CALLS = "conv long, turn long, call string, tool string, arguments string, refs array<string>"
RESULTS = "conv long, turn long, call string, content string"


@pytest.mark.parametrize("text", ['{"b": 1, "a": {"d": [1, {"z": null, "y": "é\\n\\""}], "c": true}}', "[3, 1, 2]", '"x"', "12", "{}"])
def test_canonical_json(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(chat.canonical_json(F.col("t"))).first()[0]
    assert got == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


@pytest.mark.parametrize(
    ("tool", "arguments", "want"),
    [
        ("search", '{"limit": 3, "q": "x"}', []),
        ("search", '{"limit": "3"}', ["missing:q", "type:limit"]),
        ("sum", '{"ref": "a", "parts": [1], "note": "n"}', []),
        ("sum", '{"ref": "a", "parts": [1], "note": 4, "odd": 1}', ["extra:odd", "type:note"]),
        ("sum", '{"ref": null, "parts": ["x"]}', ["type:parts", "type:ref"]),
        ("none", "{}", ["tool"]),
        (None, "{}", ["tool"]),
        ("search", "no", ["json"]),
        ("search", "[1]", ["json"]),
        ("search", '{"limit": 3, "q": "x"} more', ["json"]),
        ("search", None, ["json"]),
    ],
)
def test_arguments(spark, tool, arguments, want):
    got = spark.createDataFrame([(tool, arguments)], "t string, a string").select(chat.argument_errors(F.col("t"), F.col("a"), chat.TOOLS)).first()[0]
    assert got == want


def test_links_and_order_as_brute_force(spark):
    rng = random.Random(2)
    calls, results = [], []
    for conv in range(4):
        n = 60 if conv == 0 else 8
        for k in range(n):
            refs = [f"c{rng.randrange(n + 2)}" for _ in range(rng.choice((0, 0, 1, 2)))] if conv % 2 else [f"c{rng.randrange(k)}"] if k and rng.random() < 0.5 else []
            calls.append((conv, rng.randrange(100), f"c{k}", "search", '{"q": "x", "limit": 1}', refs))
            for _ in range(rng.choice((0, 1, 1, 2))):
                results.append((conv, rng.randrange(100), f"c{k}", f"r{rng.random()}"))
    results.append((1, 3, "nobody", "r"))
    got = chat.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), chat.TOOLS, block=16).collect()
    assert [(r.call, r.result) for r in got if r.kind == "orphan"] == [("nobody", "orphan")]
    for conv in range(4):
        own = {c[2]: c for c in calls if c[0] == conv}
        level: dict = {}
        while True:
            now = {k: 1 + max([level[x] for x in c[5] if x in own], default=-1) for k, c in own.items() if k not in level and all(x in level for x in c[5] if x in own)}
            if not now:
                break
            level |= now
        rows = sorted((r for r in got if r.kind == "call" and r.conv == conv), key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(len(own)))
        assert [r.call for r in rows] == sorted(own, key=lambda k: (level.get(k, 2**31), own[k][1], k))
        for r in rows:
            assert r.level == level.get(r.call)
            answers = sorted((x[1], x[3]) for x in results if x[:1] + x[2:3] == (conv, r.call))
            assert r.result == ("missing" if not answers else "ok" if len(answers) == 1 else "repeated")
            assert json.loads(r.line)["result"] == (answers[0][1] if answers else None)
            assert [e for e in r.errors if e.startswith("ref:")] == sorted({f"ref:{x}" for x in own[r.call][5] if x not in own})
            assert ("cycle" in r.errors) == (r.call not in level)


def test_defined_cases(spark):
    none = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert chat.link(*none, chat.TOOLS).collect() == []
    calls = spark.createDataFrame([(1, 1, "a", "search", '{"q": "x", "limit": 1}', None), (1, 1, "a", "search", '{"q": "x", "limit": 1}', None), (None, 2, "a", "search", None, ["a"]), (1, None, None, None, "x", [])], CALLS)
    results = spark.createDataFrame([(1, 2, "a", 'say "é"'), (None, 2, "a", "x"), (1, 2, None, None)], RESULTS)
    got = chat.link(calls, results, chat.TOOLS).collect()
    assert sorted((r.kind, r.result) for r in got) == [("call", "missing"), ("call", "missing"), ("call", "ok"), ("call", "ok"), ("orphan", "orphan"), ("orphan", "orphan")]
    assert json.loads(next(r.line for r in got if r.result == "ok")) == {"arguments": {"limit": 1, "q": "x"}, "id": "a", "name": "search", "result": 'say "é"'}

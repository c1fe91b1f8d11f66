from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import translate as tr
from lexiflow.schema import ENTRY

P = '{"lemma": "l", "gloss": "g"}'
CASES = [
    (f'{{"headword": "h", "definitions": {{"0": {P}}}}}', "ok"),
    (f'```json\n{{"h": {{"definitions": {{"0": {P}}}}}}}\n```', "ok"),
    (f'```JSON\n{{"0": {P}}}```', "ok"),
    (f'{{"headword": "h", "definitions": [{P}]}}', "ok"),
    (f'{{"headword": "h", "definitions": [{P}, {P}]}}', "wrong length"),
    (f'{{"headword": "x", "definitions": {{"0": {P}}}}}', "wrong schema"),
    ('{"headword": "h"}', "wrong schema"),
    (f'{{"h": {{"definitions": [{P}]}}}}', "wrong schema"),
    ('{"headword": "h", "definitions": {}}', "wrong keys"),
    ('{"headword": "h", "definitions": 5}', "wrong keys"),
    (f'{{"0": {P}, "1": {P}}}', "wrong keys"),
    ("{}", "invalid JSON"),
    ("[]", "invalid JSON"),
    ("[1]", "invalid JSON"),
    ("0", "invalid JSON"),
    ('""', "invalid JSON"),
    ('{"0": ', "invalid JSON"),
    (f'{{"0": {P}}} thanks', "invalid JSON"),
    (None, "invalid JSON"),
]


def test_contract_of_definition_replies(spark):
    for reply, want in CASES:
        assert (tr.check_reply("h", ["d"], reply)[1] or "ok") == want, reply
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(CASES)], "i int, reply string")
    got = df.select("i", tr.checked(F.col("reply"), F.lit("h"), F.lit(1)).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [w for _, w in CASES]


def test_contract_of_expression_replies(spark):
    cases = [(f'{{"headword": "h", "fixed_expressions": {{"0": {P}}}}}', "ok"), (f'{{"h": {{"fixed_expressions": {{"0": {P}}}}}}}', "ok"), (f'{{"0": {P}}}', "wrong schema"), (f'{{"headword": "h", "fixed_expressions": [{P}]}}', "wrong keys")]
    for reply, want in cases:
        assert (tr.check_reply("h", ["d"], reply, tr.EXPRESSIONS)[1] or "ok") == want
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "i int, reply string")
    assert [r.v for r in df.select("i", tr.checked(F.col("reply"), F.lit("h"), F.lit(1), tr.EXPRESSIONS).alias("v")).orderBy("i").collect()] == [w for _, w in cases]


def test_values():
    found, _ = tr.check_reply("h", ["a", "b", "c", "d"], json.dumps({"0": {"lemma": "l", "gloss": "g"}, "1": "s", "2": 5, "3": {"lemma": "l"}}))
    assert found == {"a": {"lemma": "l", "gloss": "g"}, "b": {"lemma": "s", "gloss": "s"}, "c": {"lemma": "", "gloss": ""}, "d": {"lemma": "", "gloss": ""}}
    found, _ = tr.check_reply("h", ["a"], json.dumps({"headword": "h", "fixed_expressions": {"0": "s"}}), tr.EXPRESSIONS)
    assert found == {"a": {"lemma": "", "gloss": ""}}


def test_pos_replies():
    tags = [f"t{i}" for i in range(5)]
    assert tr.check_pos_reply(tags, json.dumps(dict.fromkeys(tags, "x")))[1].startswith("suspicious")
    assert tr.check_pos_reply(tags[:4], json.dumps(dict.fromkeys(tags[:4], "x")))[0] == dict.fromkeys(tags[:4], "x")
    assert "missing ['t1']" in tr.check_pos_reply(["t0", "t1"], '{"t0": "a", "t9": "b"}')[1]
    assert tr.check_pos_reply(["t0"], "[1]")[1] == "invalid JSON"


def test_asks_again_with_the_error_and_longer_pauses():
    requests, pauses = [], []

    def service(request):
        requests.append(request)
        if len(requests) == 2:
            raise RuntimeError("down")
        return f'{{"0": {P}}}' if len(requests) == 3 else "no"

    found, error = tr.ask(service, "R", lambda r: tr.check_reply("h", ["d"], r), sleep=pauses.append)
    assert found == {"d": {"lemma": "l", "gloss": "g"}} and error is None
    assert pauses == [2.0, 4.0] and "invalid JSON" in requests[1] and "down" in requests[2]
    assert tr.ask(lambda _: "no", "R", lambda r: tr.check_reply("h", ["d"], r), tries=3, sleep=pauses.append) == (None, "invalid JSON")


@pytest.mark.parametrize(("n", "size", "sizes"), [(0, 30, [0]), (1, 30, [1]), (30, 30, [30]), (31, 30, [30, 1]), (61, 30, [30, 30, 1]), (61, None, [61])])
def test_batches(spark, n, size, sizes):
    entry = {"headword": "h", "definitions": [{"definition": f"d{i}"} for i in range(n)] + [{"definition": None}, {"definition": ""}]}
    df = spark.read.schema(ENTRY).json(spark.createDataFrame([(json.dumps(entry),)], "value string").rdd.map(lambda r: r.value))
    rows = tr.requests(df, tr.DEFINITIONS, size).orderBy("chunk").collect()
    assert [len(r["items"]) for r in rows] == sizes
    assert [x for r in rows for x in r["items"]] == [f"d{i}" for i in range(n)]


def test_one_failed_batch_empties_the_headword(spark):
    def service(request):
        body = json.loads(request.split("\n\nThe reply")[0])
        items = body["definitions"]
        return "no" if "bad" in items.values() else json.dumps({k: {"lemma": v, "gloss": "g"} for k, v in items.items()})

    batches = spark.createDataFrame([("a", 0, ["x", "y"]), ("a", 1, ["bad"]), ("b", 0, ["x"]), ("c", 0, [])], "headword string, chunk int, items array<string>")
    rows = tr.translate(batches, service, tries=2, sleep=lambda _: None).cache()
    good, progress = tr.settled(rows)
    assert [tuple(r) for r in good.collect()] == [("b", "x", "x", "g")]
    assert {r.headword: (r.status, r.n_items) for r in progress.collect()} == {"a": ("failed", 0), "b": ("done", 1), "c": ("empty", 0)}


def test_pos_labels_in_one_request(spark):
    def service(request):
        assert "German" in request
        return "no" if "refused" not in request else json.dumps({"a": "A", "b": "B"})

    tags = spark.createDataFrame([("a",), ("b",), ("a",), ("",), (None,)], "pos string")
    asking = {"sleep": lambda _: None}
    assert sorted(map(tuple, tr.translate_pos(tags, service, "German", **asking).collect())) == [("a", "A", None), ("b", "B", None)]
    assert sorted(map(tuple, tr.translate_pos(tags, lambda _: "no", "German", **asking).collect())) == [("a", None, "invalid JSON"), ("b", None, "invalid JSON")]


def test_jitter_adds_to_pauses():
    pauses = []
    tr.ask(lambda _: "no", "R", lambda r: (None, "bad"), tries=3, sleep=pauses.append, jitter=lambda: 0.5)
    assert pauses == [2.5, 4.5]


def test_wording_goes_before_the_payload():
    intro = tr.instruction(tr.DEFINITIONS, "Chinese")
    assert tr.CHINESE in intro and tr.payload("h", ["x"], intro=intro).startswith(intro)

"""Machine translation of entries: batches, payloads, the strict contract of replies, retries and status.

`check_reply` has the rules for replies, once: the loop that asks again calls it for each, and `checked` for columns of replies that are
stored already, in Arrow batches. The service itself is injected, and the wording of the requests is an argument.

A headword's batches count together: if one of them fails for good, the headword has no translations and its status says so.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import ship

DEFINITIONS, EXPRESSIONS = "definitions", "fixed_expressions"
# fixed value: a code fence around a reply
FENCE = re.compile(r"^```(?:json)?|```$", re.IGNORECASE)


INSTRUCTIONS = {
    DEFINITIONS: 'Below is a headword with numbered definitions. Answer in {language} with JSON alone, of the same shape: the same headword, and under "definitions" for each number an object with "lemma" (the word that a dictionary of {language} would list) and "gloss" (a short translation of the definition). Leave no number out and add none.',
    EXPRESSIONS: 'Below is a headword with numbered fixed expressions. Answer in {language} with JSON alone, of the same shape: the same headword, and under "fixed_expressions" for each number an object with "lemma" (the matching expression in {language}) and "gloss" (what it means). Leave no number out and add none.',
    "pos": "Below is a list of part-of-speech labels. Answer with one JSON object alone that has each label, unchanged, as a key and its usual name in {language} as the value.",
}
CHINESE = "Write simplified characters."


def instruction(kind: str, language: str) -> str:
    """The wording that goes before a payload."""
    return INSTRUCTIONS[kind].replace("{language}", language) + (f" {CHINESE}" if language.lower() == "chinese" else "")


def payload(headword: str, items: list[str], kind: str = DEFINITIONS, intro: str | None = None) -> str:
    """The request: the headword and its texts under "0".."n-1", after the wording, if any."""
    body = json.dumps({"headword": headword, kind: {str(i): x for i, x in enumerate(items)}}, ensure_ascii=False, indent=2)
    return f"{intro}\n\n{body}" if intro else body


def parsed(reply: str | None):
    """The JSON in a reply, without a code fence; None if there is none."""
    if reply is None:
        return None
    try:
        return json.loads(FENCE.sub("", reply.strip()).strip())
    except ValueError:
        return None


def check_reply(headword: str, items: list[str], reply: str | None, kind: str = DEFINITIONS) -> tuple[dict[str, dict[str, str]] | None, str | None]:
    """({text: {lemma, gloss}}, None), or (None, why the reply can't be used).

    Three shapes do: {"headword", kind: {...}}, {headword: {kind: {...}}}, and for definitions {"0": ..., ...} alone; there the first may have a list.
    """
    data = parsed(reply)
    if not data or not isinstance(data, dict):
        return None, "invalid JSON"
    own = data.get(headword)
    if data.get("headword") == headword and kind in data:
        values = data[kind]
    elif isinstance(own, dict) and isinstance(own.get(kind), dict):
        values = own[kind]
    elif kind == DEFINITIONS and all(k.isdigit() for k in data):
        values = data
    else:
        return None, "wrong schema"
    if isinstance(values, list) and kind == DEFINITIONS:
        if len(values) != len(items):
            return None, "wrong length"
        values = {str(i): v for i, v in enumerate(values)}
    if not isinstance(values, dict) or set(values) != {str(i) for i in range(len(items))}:
        return None, "wrong keys"
    out = {}
    for i, text in enumerate(items):
        v = values[str(i)]
        if isinstance(v, dict) and "lemma" in v and "gloss" in v:
            out[text] = {"lemma": v["lemma"], "gloss": v["gloss"]}
        elif isinstance(v, str) and kind == DEFINITIONS:
            out[text] = {"lemma": v, "gloss": v}
        else:
            out[text] = {"lemma": "", "gloss": ""}
    return out, None


def check_pos_reply(tags: list[str], reply: str | None, most_shared: int = 4) -> tuple[dict[str, str] | None, str | None]:
    """A translation for each tag; none may stand for more than most_shared tags."""
    data = parsed(reply)
    if not data or not isinstance(data, dict):
        return None, "invalid JSON"
    if set(data) != set(tags):
        return None, f"missing {sorted(set(tags) - set(data))}, extra {sorted(set(data) - set(tags))}"
    counts: dict[str, int] = {}
    for v in data.values():
        counts[str(v)] = counts.get(str(v), 0) + 1
    if shared := sorted(v for v, n in counts.items() if n > most_shared):
        return None, f"suspicious {shared}"
    return {k: str(v) for k, v in data.items()}, None


def ask(service: Callable[[str], str], request: str, check: Callable[[str], tuple], tries: int = 10, pause: float = 2.0, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = lambda: 0.0):
    """Asks until a reply passes. Each request after the first tells what was wrong; the pause grows with the number of the try,
    and jitter adds to it."""
    error = None
    for n in range(1, tries + 1):
        try:
            reply = service(request if error is None else f"{request}\n\nThe reply before was refused: {error}")
        except Exception as e:  # whatever the injected service raises counts as a failed try
            found, error = None, f"{type(e).__name__}: {e}"
        else:
            found, error = check(reply)
        if found is not None:
            return found, None
        if n < tries:
            sleep(pause * n + jitter())
    return None, error


def requests(entries: DataFrame, kind: str, size: int | None) -> DataFrame:
    """(headword, chunk, items): non-empty texts of each headword in batches. Nothing is shuffled: batches are slices of the entry's own list."""
    field = "definition" if kind == DEFINITIONS else "expression"
    texts = F.filter(F.transform(F.col(kind), lambda x: x[field]), tx.truthy)
    rows = entries.select("headword", texts.alias("texts")).where(tx.truthy(F.col("headword")))
    if not size:
        return rows.select("headword", F.lit(0).alias("chunk"), F.col("texts").alias("items"))
    last = F.greatest(F.ceil(F.size("texts") / size) - 1, F.lit(0)).cast("int")
    numbers = rows.select("headword", "texts", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    return numbers.select("headword", "chunk", F.slice("texts", F.col("chunk") * size + 1, size).alias("items"))


def translate(batches: DataFrame, service: Callable[[str], str], kind: str = DEFINITIONS, intro: str | None = None, **asking) -> DataFrame:
    """(headword, chunk, n_items, error, text, lemma, gloss): a row for each text, or one with the error. Write the result before it is
    used twice, or the service is asked again. Pauses have up to a second more by chance, so that tasks don't ask again in step."""
    ship(batches.sparkSession)
    asking = {"jitter": random.random} | asking

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for headword, chunk, items in zip(frame["headword"], frame["chunk"], frame["items"], strict=True):
                items = list(items)
                if not items:
                    rows.append((headword, chunk, 0, None, None, None, None))
                    continue
                found, error = ask(service, payload(headword, items, kind, intro), lambda reply, h=headword, i=items: check_reply(h, i, reply, kind), **asking)
                if found is None:
                    rows.append((headword, chunk, len(items), error, None, None, None))
                else:
                    rows += [(headword, chunk, len(items), None, text, str(v["lemma"]), str(v["gloss"])) for text, v in found.items()]
            yield pd.DataFrame(rows, columns=["headword", "chunk", "n_items", "error", "text", "lemma", "gloss"])

    return batches.mapInPandas(run, "headword string, chunk int, n_items int, error string, text string, lemma string, gloss string")


def settled(rows: DataFrame, kind: str = DEFINITIONS) -> tuple[DataFrame, DataFrame]:
    """Translations of the headwords of which no batch failed, and a status for each headword ('done', 'failed' or 'empty')."""
    whole = rows.groupBy("headword").agg(F.bool_and(F.col("error").isNull()).alias("ok"), F.count_if(F.col("text").isNotNull()).alias("n"))
    status = F.when(~F.col("ok"), "failed").when(F.col("n") == 0, "empty").otherwise("done")
    progress = whole.select("headword", F.lit(kind).alias("kind"), status.alias("status"), F.when(F.col("ok"), F.col("n")).otherwise(0).cast("int").alias("n_items"))
    good = rows.join(whole.where("ok").select("headword"), "headword", "left_semi").where("text is not null")
    name = "definition" if kind == DEFINITIONS else "expression"
    return good.select("headword", F.col("text").alias(name), "lemma", "gloss"), progress


def translate_pos(tags: DataFrame, service: Callable[[str], str], language: str, most_shared: int = 4, tries: int = 5, **asking) -> DataFrame:
    """(pos, pos_tr, error) of the labels in the column `pos`, from one request for all of them, so that each translation can be held against the
    others; a dictionary has some dozens of labels. If no reply passes, no label has a translation and all have the error."""
    ship(tags.sparkSession)
    asking = {"jitter": random.random} | asking
    labels = tags.where(tx.truthy(F.col("pos"))).agg(F.array_sort(F.collect_set("pos")).alias("tags"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own in map(list, frame["tags"]):
                if not own:
                    continue
                request = f"{instruction('pos', language)}\n\n{json.dumps(own, ensure_ascii=False)}"
                found, error = ask(service, request, lambda reply, own=own: check_pos_reply(own, reply, most_shared), tries=tries, **asking)
                yield pd.DataFrame([(x, found and found[x], error) for x in own], columns=["pos", "pos_tr", "error"])

    return labels.mapInPandas(run, "pos string, pos_tr string, error string")


def checked(reply: Column, headword: Column, n_items: Column, kind: str = DEFINITIONS) -> Column:
    """The verdict on a stored reply: 'ok', 'invalid JSON', 'wrong schema', 'wrong length' or 'wrong keys'."""

    def verdicts(replies: pd.Series, headwords: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([check_reply(h, [str(i) for i in range(int(n))], r, kind)[1] or "ok" for r, h, n in zip(replies, headwords, sizes, strict=True)], dtype=object)

    return F.pandas_udf(verdicts, "string")(reply, F.coalesce(headword, F.lit("")), F.coalesce(n_items, F.lit(0)))


def pair(value: Column, kind: str = DEFINITIONS) -> Column:
    """(lemma, gloss) of a value of a reply, given as JSON text."""
    v = tx.json_value(value)
    shape = F.schema_of_variant(v)
    both = F.array_contains(F.json_object_keys(value), "lemma") & F.array_contains(F.json_object_keys(value), "gloss")
    get = lambda name: F.coalesce(F.try_variant_get(v, f"$.{name}", "string"), F.lit(""))
    text = F.try_variant_get(v, "$", "string")
    bare = (shape == "STRING") if kind == DEFINITIONS else F.lit(False)
    pick = lambda name: F.when(shape.startswith("OBJECT") & F.coalesce(both, F.lit(False)), get(name)).when(bare, text).otherwise("")
    return F.struct(pick("lemma").alias("lemma"), pick("gloss").alias("gloss"))

from __future__ import annotations

import json
import random
import sqlite3
import unicodedata
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from lexiflow.functions import text as tx
from lexiflow.functions import url as ux
from lexiflow.operators import dedupe, lookup, render
from lexiflow.operators.ranking import numbered
from lexiflow.schema import ENTRY, NOTE_FIELDS, PLAIN_FIELDS
from lexiflow.sources import fetch, sinks


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


TEXT = [
    (lambda: tx.strip(F.lit(" \t a b\n ")), "a b"),
    (lambda: tx.sanitize(F.lit(" {{x}} ")), "x"),
    (lambda: tx.sanitize(F.lit(None).cast("string")), ""),
    (lambda: tx.strip_digits(F.lit("ord12٣")), "ord"),
    (lambda: tx.strip_set(F.lit("[[x]"), "[]"), "x"),
    (lambda: tx.strip_fence(F.lit(" ```JSON\n{}\n``` ")), "{}"),
    (lambda: tx.rank_text(F.lit(7)), "00007"),
    (lambda: tx.rank_text(F.lit(100000)), "100000"),
    (lambda: tx.rank_text(F.lit(None).cast("int")), ""),
    (lambda: tx.stem(F.lit("/a/b.c.html")), "b.c"),
    (lambda: tx.basename(F.lit("/a/b.html")), "b.html"),
    (lambda: tx.ellipsis(F.lit("x" * 120)), "x" * 120),
    (lambda: tx.ellipsis(F.lit("x" * 121)), "x" * 120 + "…"),
    (lambda: tx.ellipsis(F.lit(" " + "x" * 120)), "x" * 120 + "…"),
    (lambda: tx.ellipsis(F.lit("x"), always=True), "x…"),
    (lambda: tx.ellipsis(F.lit(""), always=True), ""),
    (lambda: tx.adler32(F.lit("dansk æøå")), zlib.adler32("dansk æøå".encode()) & 0x7FFFFFFF),
    (lambda: tx.adler32(F.lit("")), 1),
    (lambda: tx.nfc(F.lit("é")), unicodedata.normalize("NFC", "é")),
    (lambda: tx.clean_links(F.array(F.lit("kig3"), F.lit("...vis mere"), F.lit("12"))), ["kig"]),
    (lambda: ux.query_param(F.lit("/q?x=&select=a%20b%2Cc&select=d"), "select"), "a b,c"),
    (lambda: ux.query_param(F.lit("/q?x=&y=1"), "x"), None),
    (lambda: ux.selects(F.lit("/q?select=ord%2C2"), F.lit("ord")), True),
    (lambda: ux.percent_encoded(F.lit("på vej/x")), "p%C3%A5%20vej/x"),
    (lambda: ux.media_name(F.lit("attachment; filename*=UTF-8''a b.mp3"), F.lit("http://h/x.mp3")), "a.b.mp3"),
    (lambda: ux.media_name(F.lit(None).cast("string"), F.lit("http://h/p/x y.mp3?z=1")), "x.y.mp3"),
]


@pytest.mark.parametrize("k", range(len(TEXT)))
def test_scalar_functions(spark, k):
    make, want = TEXT[k]
    assert value(spark, make()) == want


def test_richest_entry_first_on_ties_and_null_headword(spark):
    entries = [("a", 1), ("b", 5), ("a", 3), ("a", 3), (None, 2), (None, 1)]
    rows = [json.dumps({"headword": h, "wordforms": ["x"] * (n - 1), "orddannelser": {"c": ["y"]}, "file": str(i)}) for i, (h, n) in enumerate(entries)]
    df = spark.read.schema(ENTRY).json(spark.sparkContext.parallelize(rows, 3)).withColumn("ord", F.col("file").cast("long"))
    out = dedupe.richest(df.drop("udtale", "etymology", "definitions", "fixed_expressions", "orddannelser").withColumn("size", F.size("wordforms")), ["headword"], F.col("size"), "ord")
    assert [(r.headword, r.ord) for r in out.orderBy("group_position").collect()] == [("a", 2), ("b", 1), (None, 4)]
    assert [r.s for r in df.select(dedupe.richness().alias("s"), "ord").orderBy("ord").collect()] == [n for _, n in entries]
    assert tuple(dedupe.duplicate_stats(df, "headword").first()) == (6, 3, 3)


def test_versions_and_backup(spark):
    versions = spark.createDataFrame([("a", 0, "xx"), ("a", 1, "øø"), ("a", 2, "yyyy"), ("a", 3, None), ("b", 0, None)], "word string, pos int, content string")
    best = dedupe.largest_version(versions, "word", "content", "pos")
    assert [(r.word, r.pos) for r in best.collect()] == [("a", 1)]
    current = spark.createDataFrame([("a", "old"), ("c", "stay")], "word string, content string")
    assert sorted((r.word, r.content, r.backup or "") for r in dedupe.replaced(current, best, "word").collect()) == [("a", "øø", "old"), ("c", "stay", "")]


def test_ranked_entries(spark):
    entries = spark.createDataFrame([(0, "x/B.html"), (1, "b.html"), (2, None), (3, "c.html"), (4, "zz.html"), (5, None)], "ord long, file string")
    words = spark.createDataFrame([("c", 1), ("b", 2), ("C", 9)], "word string, rank int")
    got = lookup.ranked_entries(entries, words).orderBy(F.col("frequency_rank").asc_nulls_last(), "ord").collect()
    assert [(r.ord, r.frequency_rank) for r in got] == [(0, 2), (3, 9), (2, None), (4, None), (5, None)]
    assert lookup.ranked_entries(entries, words.limit(0)).count() == 6
    assert lookup.ranked_entries(entries, words, limit=2).count() == 1


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_positions_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(50), i) for i in range(300)]
    got = numbered(spark.createDataFrame(rows, "a int, b int").repartition(parts), "a", "b").orderBy("position").collect()
    assert [(r.a, r.b, r.position) for r in got] == [(*x, i) for i, x in enumerate(sorted(rows))]


def test_resume_and_merge(spark, tmp_path):
    none = lookup.optional(spark, str(tmp_path / "no"), spark.range(1).schema)
    assert none.count() == 0
    spark.range(3).write.parquet(str(tmp_path / "yes"))
    done = lookup.optional(spark, str(tmp_path / "yes"), spark.range(1).schema)
    assert sorted(r.id for r in lookup.pending(spark.range(5), done, ["id"]).collect()) == [3, 4]
    a, b = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "a")], [(2, "b"), (3, "b")]))
    assert sorted(tuple(r) for r in lookup.upsert(a, b, ["k"]).collect()) == [(1, "a"), (2, "a"), (3, "b")]
    assert sorted(tuple(r) for r in lookup.merged([a, b], ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "b")]


def test_fetching(spark):
    tries, pauses = [], []

    def get(url):
        tries.append(url)
        if url == "busy" and tries.count("busy") < 3:
            raise fetch.HttpError(503)
        if url == "gone":
            raise fetch.HttpError(404, "no")
        if url == "odd":
            raise OSError("x")
        return url.encode()

    one = lambda u: fetch.with_retries(get, u, sleep=pauses.append)
    assert one("busy") == (b"busy", None) and pauses == [60.0, 60.0]
    assert one("gone") == (None, "HTTP 404: no") and one("odd") == (None, "OSError: x")
    always = lambda _: (_ for _ in ()).throw(fetch.HttpError(503))
    assert fetch.with_retries(always, "u", sleep=pauses.append) == (None, "HTTP 503") and len(pauses) == 6
    ok, bad = fetch.split(fetch.fetched(spark.createDataFrame([("a", "a"), ("g", "gone")], "key string, url string"), get).cache())
    assert [(r.key, bytes(r.content)) for r in ok.collect()] == [("a", b"a")] and [(r.key, r.error) for r in bad.collect()] == [("g", "HTTP 404: no")]


def test_cards_and_deck(spark, tmp_path):
    entry = {
        "file": "a.html", "headword": " {ord} ", "pos": "subst.", "wordforms": ["x", "{}", "y"], "etymology": {"raw": "e" * 130},
        "udtale": [{"ipa": "[a]", "audio": "u1", "label": "l"}, {"ipa": "", "audio": "u1"}, {"ipa": "b", "audio": "u9"}],
        "definitions": [{"number": "1", "definition": "d {1}", "examples": [{"text": ""}, {"text": "ex"}]}, {"number": "2", "grammar": "g", "examples": []}, {"number": "3", "definition": "d3", "examples": None}],
        "fixed_expressions": [{"expression": "e {1}"}, {"expression": ""}, {"expression": "e2"}], "orddannelser": {"Øvrige": ["ø"], "Afledninger": ["a"], "Andre": ["n"]},
    }
    bare = {"file": "b.html", "headword": "b", "udtale": [], "wordforms": [], "definitions": [], "fixed_expressions": [], "orddannelser": {}}
    df = spark.read.schema(ENTRY).json(spark.sparkContext.parallelize([json.dumps(entry), json.dumps(bare)], 1))
    df = df.withColumn("ord", F.when(F.col("file") == "a.html", 1).otherwise(0)).withColumn("frequency_rank", F.when(F.col("file") == "a.html", 12))
    table = spark.createDataFrame
    audio = table([("u1", "audio/s.mp3"), ("u2", "audio/t.mp3")], "url string, path string")
    cards = render.cards(df, audio, table([("subst.", "noun")], "pos string, pos_tr string"), table([("{ord}", "d {1}", "L", "G")], "headword string, definition string, lemma string, gloss string"), table([("{ord}", "e {1}", "EL", "EG")], "headword string, expression string, lemma string, gloss string"), "Danish")
    first, second = cards.collect()
    assert first.asDict() == {
        "Headword": "ord", "POS": "subst. (noun)", "IPA": '<div class="ipa-row"><span class="ipa-text">[a]</span><span class="ipa-label">(l)</span>[sound:s.mp3]</div><div class="ipa-row"><span class="ipa-text">[b]</span></div>',
        "Definition": '1 d 1<div class="translation">L (G)</div><br>3 d3', "Grammar": "g", "Example": "ex", "Variants": "x; y", "Collocations": 'e 1<div class="translation">EL (EG)</div><br>e2', "Derivatives": "a, ø",
        "Etymology": "e" * 120 + "…", "FrequencyRank": "00012", "guid": first.guid,
    }
    assert (second.Headword, second.Definition, second.FrequencyRank) == ("b", "(no definition)", "")
    assert [r.path for r in render.media(df, audio).collect()] == ["audio/s.mp3"]
    (tmp_path / "s.mp3").write_bytes(b"sound")
    for name in ("1.apkg", "2.apkg"):
        assert sinks.write_deck(cards, str(tmp_path / name), "Deck", media=[str(tmp_path / "s.mp3")]) == 2
    assert (tmp_path / "1.apkg").read_bytes() == (tmp_path / "2.apkg").read_bytes()
    with zipfile.ZipFile(tmp_path / "1.apkg") as z:
        assert json.loads(z.read("media")) == {"0": "s.mp3"} and z.read("0") == b"sound"
        z.extract("collection.anki2", tmp_path)
    rows = sqlite3.connect(tmp_path / "collection.anki2").execute("SELECT guid, flds, sfld FROM notes ORDER BY id").fetchall()
    assert rows[0][0] == first.guid and len(rows[0][1].split("\x1f")) == len(NOTE_FIELDS) and rows[0][2] == "00012"


def test_plain_cards_in_the_order_of_a_word_list(spark, tmp_path):
    plain = {"udtale": [{"ipa": "[x]", "audio": "u1"}, {"ipa": "y", "audio": "u1"}], "wordforms": ["x", "", "y"], "definitions": [], "fixed_expressions": [{"expression": "e"}, {"expression": None}], "orddannelser": {"Øvrige": ["ø"]}, "etymology": {"raw": "old"}}
    files = ["B.html", "a.html", "c.html", "a.html", "c.html"]
    rows = [json.dumps({"file": f, "headword": f"{f[0]}{i}", "pos": "n", **plain}) for i, f in enumerate(files)]
    df = spark.read.schema(ENTRY).json(spark.sparkContext.parallelize(rows, 1)).withColumn("ord", F.regexp_extract("headword", "([0-9]+)", 1).cast("int"))
    words = spark.createDataFrame([(1, "a"), (2, "b"), (3, "C"), (4, "a")], "rank int, word string")
    audio = spark.createDataFrame([("u1", "audio/s.mp3")], "url string, path string")
    listed = lookup.listed_entries(df, words)
    notes = render.plain_cards(listed, audio)
    got = notes.collect()
    assert notes.columns == [*PLAIN_FIELDS, "guid"] and [r.Headword for r in got] == ["a3", "B0", "c2", "c4"]
    assert (got[0].Definition, got[0].Variants, got[0].Collocations, got[0].Derivatives, got[0].Etymology) == ("(no definition)", "x; ; y", "e; ", "ø", "old…")
    assert got[0].IPA.count("[sound:s.mp3]") == 2
    assert [r.path for r in render.media(listed, audio, repeats=True).collect()] == ["audio/s.mp3"] * 8
    assert sinks.write_deck(notes, str(tmp_path / "p.apkg"), "Plain", fields=PLAIN_FIELDS, sort_field=0) == 4


def test_cards_with_repeated_translations(spark):
    entry = {"file": "a.html", "headword": "a", "pos": "n", "udtale": [], "wordforms": [], "definitions": [{"number": "1", "definition": "d"}], "fixed_expressions": [], "orddannelser": {}}
    df = spark.read.schema(ENTRY).json(spark.sparkContext.parallelize([json.dumps(entry)], 1)).withColumn("ord", F.lit(0)).withColumn("frequency_rank", F.lit(1))
    table = spark.createDataFrame
    tr = table([("a ", "d", "A", "G"), ("a", "d", "L", "G"), (" a", None, "x", "x")], "headword string, definition string, lemma string, gloss string")
    pos = table([("n", "noun"), ("n", "name")], "pos string, pos_tr string")
    exprs = table([], "headword string, expression string, lemma string, gloss string")
    (card,) = render.cards(df, table([], "url string, path string"), pos, tr, exprs, "Danish").collect()
    assert "L (G)" in card.Definition and card.POS == "n (name)"


def test_written_files_stay(spark, tmp_path):
    df = spark.createDataFrame([("a.mp3", b"1"), ("b.mp3", b"2")], "name string, content binary")
    folder = str(tmp_path / "audio")
    assert sorted(r.written for r in sinks.write_files(df, folder).collect()) == [True, True]
    assert sorted(r.written for r in sinks.write_files(df, folder).collect()) == [False, False]
    sinks.json_document(spark.createDataFrame([(1, "ø"), (0, "a")], "ord int, x string"), str(tmp_path / "d.json"))
    assert json.loads((tmp_path / "d.json").read_text()) == [{"x": "a"}, {"x": "ø"}]
    sinks.append_errors(spark.createDataFrame([("w", "e")], "key string, error string"), str(tmp_path / "log"))
    assert [r.value for r in spark.read.text(str(tmp_path / "log")).collect()] == ["w\te"]

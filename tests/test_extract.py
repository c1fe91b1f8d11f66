from __future__ import annotations

from lexiflow.sources import extract, files
from lexiflow.sources.dom import parse
from lexiflow.streaming import incremental

from .pages import BROKEN, FULL, NO_ARTICLE, SEARCH, WORD_LIST


def detail(kind, text=None, source=None, items=None):
    return {"type": kind, "text": text, "source": source, "items": items}


def test_all_sections():
    got = extract.entry(FULL, "blik.html")
    assert (got["file"], got["headword"], got["pos"]) == ("blik.html", "blik", "substantiv")
    assert got["wordforms"] == ["blikket", "blikke", "blikkene", "-abcdefg"]
    assert got["udtale"] == [{"ipa": "[blig] l", "audio": "/m/1.mp3", "label": "normalt"}, {"ipa": "[bleg]", "audio": None, "label": None}, {"ipa": "[blik] l", "audio": None, "label": "sjældent"}]
    assert got["etymology"] == {"raw": "fra gammel , via ny . senere andet hale", "segments": [{"form": "gammel", "description": "fra"}, {"form": "ny", "description": "via"}]}
    first, second, third = got["definitions"] if len(got["definitions"]) == 3 else (*got["definitions"], None)
    assert first == {"number": "1", "definition": "et kort kig", "grammar": "x y", "see_also": ["kig"], "related": ["syn"], "examples": [{"text": "han så op", "source": "avis"}, {"text": "intet", "source": None}]}
    assert second == {"number": "2", "definition": None, "grammar": "kun  flertal", "see_also": None, "related": None, "examples": []}
    assert third is None
    assert got["fixed_expressions"] == [
        {"expression": "på et blik", "details": [detail("definition", "straks"), detail("see_also", items=["nu"]), detail("related", items=["tid"]), detail("grammar", "fast"), detail("usage", "uformelt"), detail("example", "a b")]},
        {"expression": "kaste et blik", "details": []},
    ]
    assert got["orddannelser"] == {"Afledninger": ["sidst"], "Øvrige": []}


def test_derivation_tails():
    html = '<div id="content-orddannelser"><div class="definitionBox"><span class="stempel">A</span><span class="inlineList"><a>x</a>, <a>y</a> adj.<b>.</b><a>z</a></span></div></div>'
    assert extract.derivations(parse(html)) == {"A": ["x ,", "y adj.", "z"]}


def test_pages_become_rows(spark):
    df = spark.createDataFrame([("a.html", FULL), ("b.html", NO_ARTICLE), ("c.html", BROKEN), ("d.html", None)], "file string, html string")
    got = {r.file: r for r in extract.entries(df).collect()}
    assert got["a.html"].entry.headword == "blik" and got["a.html"].error is None
    assert got["a.html"].entry.orddannelser["Afledninger"] == ["sidst"]
    assert got["b.html"].entry is None and got["b.html"].error is None
    assert got["c.html"].entry is None and "headword" in got["c.html"].error
    assert got["d.html"].entry is None


def test_versions_and_word_list(spark):
    assert extract.alternate_urls(SEARCH, "ord", "https://s") == ["https://s/q?select=ord,1&x=1", "http://s/q?select=ord%2C2"]
    df = spark.createDataFrame([("ord", SEARCH), ("andet", SEARCH)], "headword string, html string")
    assert [r.headword for r in extract.alternates(df, "https://s").collect()] == ["ord"]
    listed = extract.word_ranks(spark.createDataFrame([(WORD_LIST,)], "html string")).orderBy("rank").collect()
    assert [(r.rank, r.word) for r in listed] == [(1, "Og"), (2, "i"), (3, "og")]


def test_tree_of_broken_markup():
    page = parse("<p>a<br>b<i>c</p>d</i><!-- no --><script>var x</script>&amp;e")
    assert page.text("|") == "a|b|c|d|&e"
    assert [n.name for n in page.walk()] == ["p", "br", "i", "script"]


def test_folder_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/ørn.html").write_text(FULL, encoding="utf-8")
    (tmp_path / "in/x.txt").write_text("no")
    (tmp_path / "in/bad.html").write_bytes(b"\xff\xfe")
    got = {r.file: r.html for r in files.pages(spark, str(tmp_path / "in")).collect()}
    assert got == {"ørn.html": FULL, "bad.html": None}
    run = lambda: incremental.parse_pages(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (tmp_path / "in/z.html").write_text(BROKEN)
    run()
    rows = {r.file: r for r in incremental.latest(spark, str(tmp_path / "out")).collect()}
    assert rows["ørn.html"].entry.headword == "blik" and rows["z.html"].error and set(rows) == {"ørn.html", "z.html", "bad.html"}


def test_json_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"headword": "b"}, {"headword": "a", "pos": null}]')
    assert [(r.ord, r.headword) for r in files.entries(spark, str(tmp_path / "a.json")).orderBy("ord").collect()] == [(0, "b"), (1, "a")]
    (tmp_path / "m.json").write_text('{"u": "p", "v": "q", "u": "r"}')
    assert sorted((r.key, r.value) for r in files.json_map(spark, str(tmp_path / "m.json")).collect()) == [("u", "r"), ("v", "q")]

"""Extraction of dictionary entries from pages: pure functions of the document tree, and the column function that applies them.

A page without an article has no entry. A page that lacks something which must be there gives an error instead of an entry, and never
fails the job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SUFFIX, UNWANTED_LINKS
from ..schema import ENTRY
from ..session import ship
from .dom import Node, is_, parse

DIGITS = re.compile(r"\d+$")
ENDING = re.compile(SUFFIX)


class MissingPart(ValueError):
    """A page lacks an element that its structure needs."""


def _must(node: Node | None, what: str) -> Node:
    if node is None:
        raise MissingPart(what)
    return node


def links(nodes: list[Node]) -> list[str]:
    texts = (n.text() for n in nodes)
    return [t for t in (DIGITS.sub("", x) for x in texts if x not in UNWANTED_LINKS) if t]


def anchors(node: Node) -> list[Node]:
    return node.all(is_("a"))


def expanded(headword: str, forms: list[str]) -> list[str]:
    return [headword + f[1:] if ENDING.match(f) else f for f in forms]


def _stamped(page: Node, label: str) -> Node | None:
    """The label's own element: it holds this text and nothing else."""
    return page.first(lambda n: n.name == "span" and "stempel" in n.classes and n.children == [label])


def pronunciations(page: Node) -> list[dict]:
    block = page.first(is_("div", id="id-udt"))
    body = block.first(is_("span", cls="tekstmedium")) if block else None
    out, label = [], None
    for node in body.children if body else []:
        if not isinstance(node, Node):
            continue
        if "lydskrift" in node.classes:
            sound = node.first(lambda n: n.name == "a" and n.attrs.get("href", "").endswith(".mp3"))
            # one that is a label itself is looked at as a label by the next one
            out.append({"ipa": node.text(" "), "audio": sound.attrs["href"] if sound else None, "label": label})
            label = None
        if "diskret" in node.classes:
            label = node.text(" ")
    return out


def word_forms(page: Node) -> list[str]:
    label = _stamped(page, "Bøjning")
    body = next((n for n in label.elements_after() if n.name == "span"), None) if label else None
    return [x for x in (p.strip() for p in body.text().split(",")) if x] if body else []


def etymology(page: Node) -> dict | None:
    label = _stamped(page, "Oprindelse")
    body = next((n for n in label.elements_after() if n.name == "span" and "tekstmedium" in n.classes), None) if label else None
    if body is None:
        return None
    segments, open_ = [], ""
    for x in body.children:
        if isinstance(x, str):
            open_ += x
        elif x.name == "a" or (x.name == "span" and "ordform" in x.classes):
            segments.append({"form": x.text(), "description": open_.strip(" ,")})
            open_ = ""
        elif "dividerDot" not in x.classes:
            open_ += x.text()
    return {"raw": body.text(" "), "segments": segments}


def _citation(box: Node) -> dict:
    source = box.first(is_("span", cls="kilde"))
    return {"text": _must(box.first(is_("span", cls="citat")), "citat").text(" "), "source": source.text() if source else None}


def _grammar(box: Node) -> str:
    return (box.first(is_("span", cls="inlineList")) or box).text(" ")


def _box(cls: str):
    return lambda n: n.name == "div" and {"definitionBox", cls} <= set(n.classes)


def definitions(page: Node) -> list[dict]:
    part = page.first(is_(id="content-betydninger"))
    out = []
    for number in part.all(is_("div", cls="definitionNumber")) if part else []:
        body = next((n for n in number.elements_after() if "definitionIndent" in n.classes), None)
        if body is None:
            continue
        holder = [n for n in body.all(is_("div", cls="definitionBox", id_prefix="betydning-")) if n.first(is_("span", cls="definition"))]
        grammar, see, related = (body.first(_box(c)) for c in ("grammatik", "onym", "rel-begreber"))
        out.append({
            "number": number.text(),
            "definition": holder[0].first(is_("span", cls="definition")).text(" ") if holder else None,
            "grammar": _grammar(grammar) if grammar else None,
            "see_also": links(anchors(see)) if see else None,
            "related": links(anchors(related)) if related else None,
            "examples": [_citation(c) for c in body.all(is_("div", cls="citat-box"))],
        })
    return out


def _detail(box: Node, expression_id: str) -> dict | None:
    """What a box below an expression says; the first rule that fits counts."""
    none = {"type": None, "text": None, "source": None, "items": None}
    if box.attrs.get("id", "").startswith(f"{expression_id}-betydning"):
        return none | {"type": "definition", "text": box.text(" ")}
    for cls, kind in (("onym", "see_also"), ("rel-begreber", "related")):
        if cls in box.classes:
            return none | {"type": kind, "items": links(anchors(box))}
    if "grammatik" in box.classes:
        return none | {"type": "grammar", "text": _grammar(box)}
    stamp = box.first(is_("span", cls="stempel"))
    if stamp and stamp.text() == "SPROGBRUG":
        usage = box.first(is_("span", cls="tekstnormal"))
        return none | {"type": "usage", "text": usage.text()} if usage else None
    cite = box.first(is_("div", cls="citat-box"))
    return none | {"type": "example"} | _citation(cite) if cite else None


def fixed_expressions(page: Node) -> list[dict]:
    article = page.first(is_("div", cls="artikel"))
    part = article.first(is_(id="content-faste-udtryk")) if article else None
    out = []
    for head in part.all(lambda n: n.name == "div" and re.match(r"udtryk-\d+", n.attrs.get("id", "")) is not None) if part else []:
        match = head.first(is_("span", cls="match"))
        if match is None:
            continue
        details = []
        for node in head.elements_after():
            if node.name == "div" and node.attrs.get("id", "").startswith("udtryk-"):
                break
            if "definitionIndent" in node.classes:
                boxes = (b for b in node.children if isinstance(b, Node) and b.name == "div" and "definitionBox" in b.classes)
                details += [d for d in (_detail(b, head.attrs["id"]) for b in boxes) if d]
        out.append({"expression": match.text(), "details": details})
    return out


def derivations(page: Node) -> dict[str, list[str]]:
    part = page.first(is_(id="content-orddannelser"))
    out: dict[str, list[str]] = {}
    for box in part.all(is_("div", cls="definitionBox")) if part else []:
        category = _must(box.first(is_("span", cls="stempel")), "stempel").text()
        listed = box.first(is_("span", cls="inlineList"))
        items = []
        for x in listed.children if listed else []:
            if isinstance(x, Node) and x.name == "a":
                tail = ""
                for y in x.after():
                    if isinstance(y, Node):
                        break
                    tail += y
                items.append(f"{x.text()} {tail.strip()}".strip() if tail.strip() else x.text())
        out[category] = items
    return out


def entry(html: str, file: str) -> dict | None:
    """The entry of a page; None if the page has no article."""
    page = parse(html)
    if page.first(is_("div", cls="artikel")) is None:
        return None
    tops = page.all(is_("div", cls="definitionBoxTop"))
    inside = lambda cls: next((n for t in tops if (n := t.first(is_("span", cls=cls)))), None)
    raw = _must(inside("match"), "headword").text()
    headword = DIGITS.sub("", raw).strip()
    pos = inside("tekstmedium")
    return {
        "file": file,
        "headword": headword,
        "pos": pos.text() if pos else None,
        "udtale": pronunciations(page),
        "wordforms": expanded(headword, [f for f in word_forms(page) if f != raw]),
        "etymology": etymology(page),
        "definitions": definitions(page),
        "fixed_expressions": fixed_expressions(page),
        "orddannelser": derivations(page),
    }


def alternate_urls(html: str, headword: str, site: str) -> list[str]:
    """Links of the result box to versions of this headword, absolute, each once, in order."""
    box = parse(html).first(is_("div", cls="searchResultBox"))
    out = []
    for a in box.all(is_("a", has="href")) if box else []:
        href = a.attrs["href"]
        chosen = parse_qs(urlparse(href).query).get("select", [""])[0]
        if chosen and chosen.split(",")[0] == headword:
            out.append(site + href if href.startswith("/") else href)
    return list(dict.fromkeys(out))


def word_list(html: str, heading: str = "Danish") -> list[str]:
    """Texts of the first link of each item of the first ordered list after the heading."""
    nodes = list(parse(html).walk())
    start = next((i for i, n in enumerate(nodes) if n.name == "h3" and n.attrs.get("id") == heading), None)
    listed = next((n for n in nodes[start + 1 :] if n.name == "ol"), None) if start is not None else None
    found = (item.first(is_("a")) for item in listed.all(is_("li"))) if listed else ()
    return [a.text() for a in found if a is not None]


def entries(pages: DataFrame, file: str = "file", html: str = "html") -> DataFrame:
    """(file, entry, error) for each page: no entry and no error where the page has no article."""
    ship(pages.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, text in zip(frame["file"], frame["html"], strict=True):
                try:
                    found = entry(text or "", name)
                    rows.append((name, json.dumps(found, ensure_ascii=False) if found else None, None))
                except (MissingPart, KeyError) as e:
                    rows.append((name, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["file", "doc", "error"])

    out = pages.select(F.col(file).alias("file"), F.col(html).alias("html")).mapInPandas(run, "file string, doc string, error string")
    return out.select("file", F.from_json("doc", ENTRY).alias("entry"), "error")


def word_ranks(pages: DataFrame, html: str = "html") -> DataFrame:
    """(rank, word) of word-list pages."""
    ship(pages.sparkSession)

    @F.pandas_udf("array<string>")
    def listed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: word_list(t or ""))

    return pages.select(F.posexplode(listed(F.col(html))).alias("rank", "word")).select((F.col("rank") + 1).alias("rank"), "word")


def alternates(pages: DataFrame, site: str, html: str = "html", headword: str = "headword") -> DataFrame:
    """headword and its versions' urls, for pages with several versions."""
    ship(pages.sparkSession)

    @F.pandas_udf("array<string>")
    def urls(texts: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([alternate_urls(t or "", w, site) for t, w in zip(texts, words, strict=True)])

    return pages.select(headword, urls(F.col(html), F.col(headword)).alias("urls")).where(F.size("urls") > 1)

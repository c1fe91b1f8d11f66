"""Writers: tables, versioned pages, media files, and the deck package."""

from __future__ import annotations

import hashlib
import json
import os
import sqlite3
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import NOTE_FIELDS
from ..session import ship

SEPARATOR = "\x1f"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def append_errors(df: DataFrame, path: str) -> None:
    """Adds to the error log: key, tab, error."""
    df.select(F.concat_ws("\t", "key", "error").alias("value")).write.mode("append").text(path)


def json_document(df: DataFrame, path: str, order: str = "ord") -> None:
    """One JSON array in the rows' order, for small results; row by row through the driver."""
    rows = df.orderBy(order).select(F.to_json(F.struct(*[c for c in df.columns if c != order])).alias("doc")).toLocalIterator()
    beside = f"{path}.{uuid.uuid4().hex}"
    with open(beside, "w", encoding="utf-8") as out:
        out.write("[")
        for i, r in enumerate(rows):
            out.write(("," if i else "") + "\n  " + r[0])
        out.write("\n]\n")
    os.replace(beside, path)


def write_files(df: DataFrame, folder: str) -> DataFrame:
    """Writes (name, content) rows as files of a mounted folder; (name, path, written): a file that is there already stays. Names that several rows
    share get the content of one of them."""
    ship(df.sparkSession)
    os.makedirs(folder, exist_ok=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["name"], frame["content"], strict=True):
                path = os.path.join(folder, os.path.basename(name))
                fresh = not os.path.exists(path)
                if fresh:
                    beside = f"{path}.{uuid.uuid4().hex}"
                    Path(beside).write_bytes(content)
                    os.replace(beside, path)
                rows.append((name, path, fresh))
            yield pd.DataFrame(rows, columns=["name", "path", "written"])

    return df.select("name", "content").mapInPandas(run, "name string, path string, written boolean")


def _number(text: str, bits: int = 31) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big") % (1 << bits)


#: The tables of a collection in the package format.
COLLECTION = """
CREATE TABLE col (id integer primary key, crt integer not null, mod integer not null, scm integer not null, ver integer not null, dty integer not null, usn integer not null, ls integer not null, conf text not null, models text not null, decks text not null, dconf text not null, tags text not null);
CREATE TABLE notes (id integer primary key, guid text not null, mid integer not null, mod integer not null, usn integer not null, tags text not null, flds text not null, sfld text not null, csum integer not null, flags integer not null, data text not null);
CREATE TABLE cards (id integer primary key, nid integer not null, did integer not null, ord integer not null, mod integer not null, usn integer not null, type integer not null, queue integer not null, due integer not null, ivl integer not null, factor integer not null, reps integer not null, lapses integer not null, left integer not null, odue integer not null, odid integer not null, flags integer not null, data text not null);
CREATE TABLE revlog (id integer primary key, cid integer not null, usn integer not null, ease integer not null, ivl integer not null, lastIvl integer not null, factor integer not null, time integer not null, type integer not null);
CREATE TABLE graves (usn integer not null, oid integer not null, type integer not null);
"""


def write_deck(notes: DataFrame, path: str, name: str, description: str = "", media: list[str] = (), fields: list[str] = NOTE_FIELDS, sort_field: int = -1, front: str = "{{Headword}}<br>{{IPA}}", back: str = "{{FrontSide}}<hr>{{Definition}}", css: str = "", stamp: int = 1_700_000_000) -> int:
    """Packs notes, in their order, and media files into a deck; the same input gives the same bytes. Returns the number of notes.

    Notes come to the driver partition by partition and go straight into the package's database.
    """
    deck, model = _number(f"deck {name}"), _number(f"model {name}")
    described = [{"name": f, "ord": i, "font": "Arial", "media": [], "rtl": False, "size": 20, "sticky": False} for i, f in enumerate(fields)]
    models = {str(model): {"id": str(model), "name": name, "type": 0, "mod": stamp, "usn": -1, "sortf": sort_field % len(fields), "did": deck, "css": css, "latexPre": "", "latexPost": "", "req": [[0, "any", [0]]], "tags": [], "vers": [], "flds": described, "tmpls": [{"name": "Card 1", "ord": 0, "qfmt": front, "afmt": back, "did": None, "bafmt": "", "bqfmt": ""}]}}
    decks = {str(deck): {"id": deck, "name": name, "desc": description, "mod": stamp, "usn": -1, "collapsed": False, "conf": 1, "dyn": 0, "extendNew": 0, "extendRev": 50, "lrnToday": [0, 0], "newToday": [0, 0], "revToday": [0, 0], "timeToday": [0, 0]}}
    with tempfile.TemporaryDirectory() as work:
        file = f"{work}/collection.anki2"
        db = sqlite3.connect(file)
        db.executescript(COLLECTION)
        db.execute("INSERT INTO col VALUES (1, ?, ?, ?, 11, 0, 0, 0, ?, ?, ?, ?, ?)", (stamp, stamp * 1000, stamp * 1000, json.dumps({"nextPos": 1, "curDeck": deck}), json.dumps(models), json.dumps(decks), json.dumps({"1": {"id": 1, "name": "Default"}}), "{}"))
        n = 0
        for row in notes.select("guid", *fields).toLocalIterator():
            values = [row[f] or "" for f in fields]
            nid = stamp * 1000 + n
            check = int(hashlib.sha1(values[0].encode()).hexdigest()[:8], 16)
            db.execute("INSERT INTO notes VALUES (?, ?, ?, ?, -1, '', ?, ?, ?, 0, '')", (nid, row["guid"], model, stamp, SEPARATOR.join(values), values[sort_field], check))
            db.execute("INSERT INTO cards VALUES (?, ?, ?, 0, ?, -1, 0, 0, ?, 0, 0, 0, 0, 0, 0, 0, 0, '')", (nid, nid, deck, stamp, n))
            n += 1
        db.commit()
        db.close()
        beside = f"{path}.{uuid.uuid4().hex}"
        with zipfile.ZipFile(beside, "w", zipfile.ZIP_DEFLATED) as z:

            def put(member: str, content: bytes) -> None:
                z.writestr(zipfile.ZipInfo(member, (2020, 1, 1, 0, 0, 0)), content, zipfile.ZIP_DEFLATED)

            put("collection.anki2", Path(file).read_bytes())
            for i, m in enumerate(media):
                put(str(i), Path(m).read_bytes())
            put("media", json.dumps({str(i): os.path.basename(m) for i, m in enumerate(media)}).encode())
        os.replace(beside, path)
    return n

"""Every query with an SQL twin, held against DuckDB on the same Parquet files."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("LEXIFLOW_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    out = pd.DataFrame({c: [None if pd.isna(x) else (str(int(x)) if isinstance(x, float) and x == int(x) else str(x)) for x in df[c].tolist()] for c in df.columns})
    return out.sort_values(list(out.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("q_")))
def test_same_rows_as_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(plain(got), plain(want))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_and_sql_fit():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_definitions_hold_whole_texts(spark):
    rows = pd.read_parquet(f"{FOLDER}/conversations.parquet").sort_values(["conv_id", "turn"])
    want = {c: "<br>".join(f"{t} {x}" for t, r, x in zip(g.turn, g.role, g.text, strict=True) if r == "system") or "(no definition)" for c, g in rows.groupby("conv_id")}
    assert any(len(x) > 200 for x in want.values())
    assert {r.conv_id: r.definition for r in entry.queries()["q_def_concat"](spark, FOLDER).collect()} == want


def test_merge_reads_every_label(spark):
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet")
    want = {d: ("late", q + 10) if d % 3 == 0 else ("early", q) for d, q in zip(labels.doc_id, labels.quality, strict=True)}
    assert {r.doc_id: (r.part, r.quality) for r in entry.queries()["q_merge_last_wins"](spark, FOLDER).collect()} == want

from __future__ import annotations

import random

import pytest


def prose(rng: random.Random, n: int) -> str:
    syllables = "an er th in on re ed nd ha at en es of or nt ea ti to it st".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.choice((1, 1, 2, 3)))) for _ in range(n))


def edited(rng: random.Random, text: str, rate: float) -> str:
    return " ".join(prose(rng, 1) + "x" if rng.random() < rate else w for w in text.split())


@pytest.fixture(scope="session")
def texts() -> dict:
    """Ids and texts with exact and near copies, a passage that a third share, null, empty, short and long ones."""
    rng = random.Random(5)
    passage, base = prose(rng, 45), prose(rng, 160)
    out: dict = {0: None, 1: "", 2: " \n\t", 3: "one", 4: "One", 5: "two words", 6: "Two  words"}
    for i in range(7, 90):
        out[i] = prose(rng, rng.choice((3, 30, 120, 400)))
    for i in range(90, 150):  # a large group of near copies
        out[i] = edited(rng, base, 0.015)
    for i in range(150, 200):  # what many share
        out[i] = f"{prose(rng, 40)} {passage}\n{prose(rng, 30)}"
    for i in range(200, 230):
        out[i] = out[rng.randrange(7, 200)]
    for i in range(230, 260):
        out[i] = edited(rng, out[rng.randrange(7, 90)], 0.03)
    out[260] = prose(rng, 30_000)
    out[261] = "again and " * 300
    out[262] = "é à 漢字 — 'quoted' don't x.y!! 12 345 <b> <|x|> ÉCOLE" + " naïve" * 30
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark, texts):
    return spark.createDataFrame([(i, t, "xx", f"s{i % 3}", len(t or "")) for i, t in texts.items()], SCHEMA).repartition(5).cache()


@pytest.fixture
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)

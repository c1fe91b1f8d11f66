from __future__ import annotations

import corpus_pipeline
import pytest

from .brute import near
from .conftest import prose
from .test_packing import check


@pytest.fixture(scope="module")
def folder(spark, frame, tmp_path_factory):
    import random

    path = tmp_path_factory.mktemp("tables")
    item = prose(random.Random(77), 40)
    leaky = spark.createDataFrame([(1000, f"before {item} after", "xx", "s", 1), (1001, "12 34 !!", "xx", "s", 1)], frame.schema)
    frame.unionByName(leaky).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_all_stages(spark, texts, folder):
    rows = corpus_pipeline.run(spark, folder).withColumnRenamed("doc_id", "id").collect()
    kept = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    last = {t: i for i, t in sorted(kept.items())}
    kept = {i: t for t, i in last.items()}
    kept = {i: kept[i] for i, (_, c) in near(kept, 5, 80, 100).items() if c == i}
    from tokenizers import Tokenizer

    from lexiflow.llm.packing import default_tokenizer

    check(rows, kept, Tokenizer.from_file(default_tokenizer()))


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns

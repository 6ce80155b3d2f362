"""The pipeline's stages on planted documents and on a given table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import quality_votes
from tidemark.llm.common import staged, table

from test_free import ITEM, tokens_by_hand

SF = "/root/testdata/sf0.001"


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n))


@pytest.fixture
def planted(documents, folder, spark):
    clean = [(n, prose(n), "en", "ab"[n % 2]) for n in range(30)]
    near = prose(3).split()
    near[60] = "changed"
    rows = [*clean, (100, prose(3), "en", "a"), (101, " ".join(near), "en", "b"), (102, prose(4), "en", None), (102, prose(4), "en", None),
            (103, prose(50, 60) + " " + ITEM + " " + prose(51, 60), "en", "a"), (104, "spam " * 100, "en", "a"), (105, None), (106, "too short")]
    docs = documents(*rows).withColumn("row", F.lit("extra"))
    return folder(documents=docs, benchmark=spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string"))


def test_stages_on_planted_documents(spark, planted):
    docs, kept = table(spark, planted, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = staged(stage(spark, docs, planted), "stage")
        kept[name] = sorted(r["doc_id"] for r in docs.collect())
        if name != "token files":
            assert docs.columns == columns
    clean = list(range(30))
    assert kept["quality rules"] == [*clean, 100, 101, 102, 102, 103]
    assert kept["near-duplicates"] == [*clean, 103]
    assert kept["benchmark decontamination"] == clean
    mixed = kept["source mix"]
    assert set(mixed) <= set(clean) and max(map(mixed.count, mixed)) <= 2
    assert kept["token files"] == mixed
    rows = {r["doc_id"]: r["n_tokens"] for r in docs.collect()}
    assert [rows[n] for n in sorted(rows)] == [len(t) for t in tokens_by_hand([prose(n) for n in sorted(rows)])]


def test_run_of_a_table(spark):
    got = corpus_pipeline.run(spark, SF)
    rows = sorted(got.collect(), key=lambda r: r["start"])
    assert rows and [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:n]) for n in range(len(rows))]
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    good = {r["doc_id"] for r in quality_votes.keep_good(table(spark, SF, "documents")).collect()}
    assert {r["doc_id"] for r in rows} <= good


def test_run_of_an_empty_table(spark, documents, folder):
    path = folder(documents=documents(), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).collect() == []

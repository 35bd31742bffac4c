"""Stages of the pipeline keep columns of any name, and stand empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline

CLASHING = [
    "score", "_text_", "_id", "_sha", "_key", "text_sha256", "row", "key", "rest", "id", "sha", "sha256",
    "sign", "class", "first", "label", "draw", "a b", "d.e", "f`g",
]


@pytest.fixture(scope="module")
def clashing(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    for c in CLASHING:
        docs = docs.selectExpr("*", f"concat(doc_id, '-{c}') AS `{c.replace('`', '``')}`")
    return docs


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_columns_of_any_name_stay_as_they_are(spark, small_dir, clashing, stage):
    kept = stage[1](spark, clashing, small_dir)
    assert kept.columns == clashing.columns and kept.schema.simpleString() == clashing.schema.simpleString()
    found = {tuple(r) for r in kept.collect()}
    assert found <= {tuple(r) for r in clashing.collect()} and len(found) > 50


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_empty_tables(spark, small_dir, clashing, stage):
    assert stage[1](spark, clashing.limit(0), small_dir).collect() == []

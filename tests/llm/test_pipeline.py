"""The pipeline on awkward rows and on none, and what it leaves behind."""

from __future__ import annotations

import pytest
from tests.llm import cases

import corpus_pipeline
from aislecast.session import listing, release, shared_dir, stage, stage_by
from aislecast.sources.versions import children


@pytest.mark.parametrize("rows", [cases.awkward, cases.nothing], ids=["awkward", "nothing"])
def test_stages_take_any_row(spark, rows):
    docs = rows(spark)
    names = docs.columns
    for name, step in corpus_pipeline.STAGES:
        assert docs.columns == names
        docs = stage(step(spark, docs, ""), f"test-{name}")
    if rows is cases.nothing:
        assert docs.count() == 0
    else:
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= {i for i, _ in cases.texts()}


def test_inner_tables_go_when_the_next_stage_begins(spark):
    docs = cases.awkward(spark)
    inner = corpus_pipeline._INNER.setdefault(spark.sparkContext.applicationId, [])
    first = stage(corpus_pipeline.near_duplicates(spark, docs, ""), "test-out")
    made = [path for path, _ in inner]
    assert made and all(children(spark, path) for path in made)
    corpus_pipeline.quality_rules(spark, first, "").count()
    assert not any(children(spark, path) for path in made)
    assert first.count() > 0


def test_release_removes_listed_tables_only(spark):
    made: list = []
    kept = stage(spark.range(3), "kept")
    with listing(made):
        stage(spark.range(4), "gone")
        table = stage_by(spark.range(5), "gone", ["id"], ["id"])
    assert len(made) == 2 and table.count() == 5
    paths = [path for path, _ in made]
    release(spark, made)
    assert made == [] and not any(children(spark, path) for path in paths)
    assert kept.count() == 3 and shared_dir(spark)

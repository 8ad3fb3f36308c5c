"""The pipeline, stage by stage against the plain way."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from spintally.llm import mixing, quality_rules
from tests.llm import plain
from tests.llm.conftest import SMALL


def test_stages(spark, small):
    docs = small("documents")
    columns = docs.columns
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        results[name] = (before.collect(), docs.collect())
        assert docs.columns[: len(columns)] == columns
    ids = lambda rows: Counter(r.doc_id for r in rows)

    before, after = results["quality rules"]
    kept = quality_rules.judge(small("documents")).filter("kept")
    assert ids(after) == ids(kept.collect())

    before, after = results["n-gram Jaccard join"]
    groups = plain.components([(r.doc_id, r.text) for r in before], 5, 80)
    assert ids(after) == Counter({group for _, _, group in groups})

    before, after = results["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in small("benchmark").collect()]
    found = plain.contamination([(r.doc_id, r.text) for r in before], items)
    assert ids(after) == Counter(row[0] for row in found if not row[-1])

    before, after = results["mixing sources"]
    plan = mixing.plan(spark.createDataFrame(before, columns and small("documents").schema))
    assert ids(after) == +Counter({r.doc_id: r.copies for r in plan.collect()})

    before, after = results["sharding"]
    assert ids(after) == ids(before)
    assert {(r.shard, r.slot) for r in after} == {(i % 8, i // 8) for i in range(len(before))}


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns[-2:] == ["shard", "slot"]
    assert found.count() > 0


def test_run_frees_what_stages_left(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folder.glob("*"))
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before}
    # The result, and the last stage's own tables until another run begins.
    assert "sharding" in left
    assert not left & {"quality_rules", "n-gram_Jaccard_join", "mixing_sources", "described", "classes", "clusters", "taken"}


@pytest.mark.parametrize("kind", ["odd", "none", "no items"])
def test_run_over_odd_tables(spark, tmp_path, odd_docs, no_docs, small, kind):
    """NULLs, repeated rows, long texts and clashing columns; empty documents; an empty benchmark."""
    docs = {"odd": odd_docs, "none": no_docs, "no items": small("documents").limit(40)}[kind]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = small("benchmark")
    (items.limit(0) if kind == "no items" else items).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == [*(c for c in docs.columns if c not in ("shard", "slot")), "shard", "slot"]
    rows = found.collect()
    assert {(r.shard, r.slot) for r in rows} == {(i % 8, i // 8) for i in range(len(rows))}
    assert bool(rows) == (kind != "none")
    before = {(r.doc_id, r.text) for r in docs.collect()}
    assert {(r.doc_id, r.text) for r in rows} <= before

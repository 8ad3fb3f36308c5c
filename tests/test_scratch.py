"""Tables that jobs need for a while."""

from __future__ import annotations

import time
from pathlib import Path

import pytest

from spintally.sources import scratch as module
from spintally.sources.scratch import discard, handed_on, kept, noted, scratch, shared_folder


def names(spark) -> set[str]:
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {path.name.rsplit("-", 1)[0] for path in folder.glob("*-*")}


def test_a_block_deletes_its_tables_but_what_it_hands_on(spark):
    with scratch(spark):
        with scratch(spark):
            inner = kept(spark.range(5), "inner_table")
            result = handed_on(inner.filter("id > 2"), "result_table")
            assert {"inner_table", "result_table"} <= names(spark)
        assert "inner_table" not in names(spark)
        assert result.count() == 2
    assert "result_table" not in names(spark)


def test_a_failed_block_deletes_its_tables(spark):
    with pytest.raises(ValueError), scratch(spark):
        kept(spark.range(5), "failed_table")
        raise ValueError
    assert "failed_table" not in names(spark)


def test_tables_outside_blocks_stay(spark):
    assert kept(spark.range(5), "loose_table").count() == 5
    assert "loose_table" in names(spark)


def test_noted_tables_are_deleted_when_asked(spark):
    paths: list[str] = []
    with noted(paths):
        table = kept(spark.range(5), "noted_table")
    assert table.count() == 5 and len(paths) == 1
    discard(spark, paths)
    assert paths == [] and "noted_table" not in names(spark)


@pytest.fixture
def on_cluster(spark, monkeypatch):
    """The session as one of a cluster's, by its master's name."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    monkeypatch.setattr(module, "_tried", set(), raising=False)
    return spark


def test_a_mounted_folder_serves_a_cluster(on_cluster):
    assert kept(on_cluster.range(5), "mounted_table").count() == 5
    assert "tried" not in names(on_cluster)


def test_a_folder_that_machines_do_not_share_is_refused(on_cluster, monkeypatch):
    # What tasks write does not reach the driver's folder.
    monkeypatch.setattr(type(on_cluster.range(1).write), "parquet", lambda self, path: Path(path.removeprefix("file:")).mkdir())
    with pytest.raises(RuntimeError, match="for itself"):
        shared_folder(on_cluster)


def shuffles(spark) -> set[str]:
    """Files of shuffles that this machine still has."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in found if name.startswith("shuffle_")}


def test_a_block_leaves_no_shuffle_files(spark):
    before = shuffles(spark)
    with scratch(spark):
        assert kept(spark.range(1000).repartition(7, "id"), "shuffled_table").count() == 1000
        assert shuffles(spark) - before
    until = time.monotonic() + 20
    while shuffles(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles(spark) - before

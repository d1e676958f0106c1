"""Listing a tree by prefix gives what Spark's own listing gives."""

from __future__ import annotations

import os

import pytest

from aisleworks import sources
from aisleworks.sources import tree


@pytest.fixture
def root(tmp_path):
    for name in ("a/x.csv", "a/b/y.csv", "a/b/c/z.csv", "a=1/p.csv", "_a=2/q.csv", "top.csv", "e f/ü.csv",
                 "_hidden/h.csv", ".git/h.csv", "a/_SUCCESS", "a/.x.crc", "a/_temporary/0/t.csv", "_top"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * len(name))
        os.utime(path, (1_700_000_000, 1_700_000_000))
    (tmp_path / "nothing").mkdir()
    return str(tmp_path)


def rows(frame):
    return sorted((r.path, r.length, r.modificationTime) for r in frame.collect())


def test_same_rows_as_sparks_listing(spark, root):
    got = sources.list_tree(spark, root)
    want = sources.list_files(spark, root)
    assert got.schema == want.schema
    found = rows(got)
    assert sorted(os.path.basename(path) for path, *_ in found) == ["p.csv", "q.csv", "top.csv", "x.csv", "y.csv", "z.csv", "ü.csv"]
    assert found == rows(want)
    assert rows(sources.list_tree(spark, f"file:{root}/")) == found


def test_a_task_for_each_prefix(spark, root):
    assert sources.list_tree(spark, root).rdd.getNumPartitions() == 6  # the root's own files, four folders and an empty one
    some = sources.list_tree(spark, root, ["a/b", "nowhere"])
    assert [os.path.basename(path) for path, *_ in rows(some)] == ["z.csv", "y.csv", "top.csv"]


def test_many_files_come_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tree, "BATCH_ROWS", 7)
    folder = tmp_path / "many"
    folder.mkdir()
    for n in range(50):
        (folder / f"{n}.csv").write_text("")
    assert sources.list_tree(spark, str(tmp_path)).count() == 50


def test_missing_and_empty_folders_list_as_empty(spark, tmp_path):
    assert sources.list_tree(spark, str(tmp_path)).count() == 0
    assert sources.list_tree(spark, str(tmp_path / "none")).count() == 0


def test_other_stores_are_listed_by_spark(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(tree, "list_files", lambda spark, root: asked.append(root))
    sources.list_tree(spark, "viewfs://cluster/raw")
    assert asked == ["viewfs://cluster/raw"]

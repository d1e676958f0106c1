"""Publishing by pointer: readers see a whole old or a whole new version, whatever happens to a run."""

from __future__ import annotations

import datetime as dt
import os
import shutil
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aisleworks import sinks, sources, versions
from aisleworks.functions.digests import digest_columns, row_hash
from aisleworks.sinks import partitioned
from tests.conftest import DAY, days

LATER = dt.datetime(2100, 1, 1, tzinfo=dt.UTC)


def rows(spark, n, mark="old"):
    return spark.range(n).select(F.lit(DAY).alias("trans_dt"), "id", F.lit(mark).alias("mark"))


def seen(spark, root, *dates):
    back = sources.read_published(spark, str(root), dates or None)
    return sorted((str(r.date), r.mark, r["count"]) for r in back.groupBy("date", "mark").count().collect())


OLD, NEW = [(str(DAY), "old", 40)], [(str(DAY), "new", 70)]


@pytest.fixture
def published(spark, tmp_path):
    sinks.write_partition(rows(spark, 40), str(tmp_path), DAY)
    return tmp_path


class Killed(RuntimeError):
    pass


def killed(*_):
    raise Killed


@pytest.mark.parametrize("count", [70, 0])
def test_killed_between_version_and_pointer(spark, published, monkeypatch, count):
    monkeypatch.setattr(partitioned, "point_to", killed)
    with pytest.raises(Killed):
        sinks.write_partition(rows(spark, count, "new"), str(published), DAY)
    assert seen(spark, published) == OLD
    monkeypatch.undo()
    sinks.write_partition(rows(spark, count, "new"), str(published), DAY)
    assert seen(spark, published) == (NEW if count else [])


def test_a_task_that_fails_while_writing(spark, published):
    bad = rows(spark, 70, "new").withColumn("id", F.when(F.col("id") == 69, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        sinks.write_partition(bad, str(published), DAY, cluster_by=None)
    assert seen(spark, published) == OLD


def pointer_files(root):
    return sorted((p for p in (root / "_pointers").rglob("*.json")), key=lambda p: p.parent.name)


@pytest.mark.parametrize("count, after", [(70, NEW), (0, [])])
def test_every_state_of_the_pointer_shows_a_whole_version(spark, published, count, after):
    """The swap cut off after any number of bytes, or with only its unfinished file there."""
    sinks.write_partition(rows(spark, count, "new"), str(published), DAY)
    pointer = pointer_files(published)[-1]
    whole = pointer.read_bytes()
    (pointer.parent / f".{pointer.name}.crc").unlink()
    for size in (0, 1, len(whole) // 3, len(whole) // 2, len(whole) - 3):
        pointer.write_bytes(whole[:size])
        assert seen(spark, published) == OLD
    unfinished = pointer.parent / "_temporary" / "0" / pointer.name
    unfinished.parent.mkdir(parents=True)
    pointer.rename(unfinished)
    assert seen(spark, published) == OLD
    pointer.write_bytes(whole)
    assert seen(spark, published) == after
    pointer.write_bytes(whole.replace(b'"rows":', b'"rows":9'))
    assert seen(spark, published) == OLD


def test_a_version_half_copied_by_its_committer_is_not_seen(spark, published):
    """Without an atomic rename of folders, files appear one by one."""
    version = versions.new_version(str(published), versions.date_slot(DAY))
    rows(spark, 70, "new").repartition(6).write.parquet(version.path)
    parts = sorted(os.listdir(version.path))
    for name in parts[: len(parts) // 2]:
        os.unlink(f"{version.path}/{name}")
    assert seen(spark, published) == OLD


def test_a_frame_keeps_its_version_until_clean_up(spark, published):
    old = sources.read_published(spark, str(published))
    before = dt.datetime.now(dt.UTC)
    time.sleep(1.1)
    sinks.write_partition(rows(spark, 70, "new"), str(published), DAY)
    assert old.count() == 40 and seen(spark, published) == NEW
    assert versions.clean(spark, str(published), before) == []  # superseded only since
    assert old.count() == 40
    (gone,) = versions.clean(spark, str(published), LATER)
    assert "version=" in gone and seen(spark, published) == NEW and len(pointer_files(published)) == 1
    assert versions.clean(spark, str(published), LATER) == []


def test_clean_up_takes_leftovers_of_killed_runs_and_nothing_else(spark, published, monkeypatch):
    a, b = days(2)
    sinks.write_partition(rows(spark, 5, "b"), str(published), b)
    monkeypatch.setattr(partitioned, "point_to", killed)
    with pytest.raises(Killed):
        sinks.write_partition(rows(spark, 70, "new"), str(published), b)
    half = published / versions.date_slot(a) / "version=vdead" / "_temporary" / "0"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"x")
    long_ago = dt.datetime(2000, 1, 1, tzinfo=dt.UTC)
    assert versions.clean(spark, str(published), long_ago) == []
    assert len(versions.clean(spark, str(published), LATER)) == 2
    assert seen(spark, published) == [*OLD, (str(b), "b", 5)]
    with pytest.raises(ValueError, match="zone"):
        versions.clean(spark, str(published), dt.datetime(2000, 1, 1))


def test_a_clean_up_that_is_killed_can_be_run_again(spark, published):
    sinks.write_partition(rows(spark, 70, "new"), str(published), DAY)
    old = versions.pointers(spark, str(published)).orderBy("seq").first()
    shutil.rmtree(published / old.slot / f"version={old.version}")
    assert seen(spark, published) == NEW
    assert versions.clean(spark, str(published), LATER) == [] and len(pointer_files(published)) == 1


def test_two_runs_at_once_leave_one_of_their_versions(spark, published):
    both = [versions.new_version(str(published), versions.date_slot(DAY)) for _ in range(2)]
    for version, mark in zip(both, ("x", "y")):
        rows(spark, 7, mark).write.parquet(version.path)
        versions.point_to(spark, version, 7)
    first, second = pointer_files(published)[-2:]
    # The second one takes the first one's number, as if both had looked before either wrote.
    row = versions.pointers(spark, str(published)).orderBy("seq").collect()[-1]
    shutil.rmtree(second.parent)
    same = spark.createDataFrame([(row.slot, 1, row.version, 7)], "slot string, seq bigint, version string, rows bigint")
    same.withColumn("check", row_hash("slot", "seq", "version", "rows")).write.json(str(second.parent))
    top = max(version.id for version in both)
    assert versions.current(spark, str(published)).first().version == top
    assert len(seen(spark, published)) == 1


def test_only_the_dates_asked_for_are_listed(spark, published):
    a, b, c = days(3)
    sinks.write_partition(rows(spark, 5, "b"), str(published), b)
    assert seen(spark, published, b) == [(str(b), "b", 5)]
    assert sources.published_paths(spark, str(published), [c]) == []
    with pytest.raises(sources.NothingPublishedError):
        sources.read_published(spark, str(published), [c])
    with pytest.raises(sources.NothingPublishedError):
        sources.read_published(spark, str(published / "nowhere"))


def test_digests_ignore_order_and_see_nulls_copies_and_changes(spark):
    def digest(*rows):
        frame = spark.createDataFrame(list(rows), "a int, b int, `c.d` string").repartition(3)
        return tuple(frame.agg(*digest_columns(frame)).first())

    whole = digest((1, 2, "x"), (None, 1, "y"), (3, 4, None))
    assert whole == digest((3, 4, None), (1, 2, "x"), (None, 1, "y"))
    assert whole != digest((1, 2, "x"), (1, None, "y"), (3, 4, None))
    assert digest((1, 1, "x"), (1, 1, "x"))[1:] != digest()[1:]
    assert digest((1, 1, "x"), (1, 1, "x")) != digest((1, 1, "x"))
    assert digest((1, 1, ""),) != digest((1, 1, None))
    assert [a + b for a, b in zip(digest((1, 2, "x")), digest((None, 1, "y"), (3, 4, None)))] == list(whole)
    assert digest() == (0, 0, 0)

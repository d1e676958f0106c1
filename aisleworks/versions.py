"""Versions of a stored result, and the pointers that say which of them counts.

A result lies in a folder of its own, ``<root>/<slot>/version=<id>``, that is written once and never changed.  Readers see the
version that the slot's highest pointer names.  A pointer is one small file below ``<root>/_pointers``, written after its
version is whole and never overwritten: the swap is the appearance of one new file, which takes no rename of a folder
and no exchange of a file's content.  Until then readers see the old version, from then on the new one, and a run killed at
any moment leaves one of the two.  A pointer cut off in its middle fails its check and counts for nothing.

Versions that no pointer names, and those superseded, stay until ``clean`` takes them away.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.functions.digests import row_hash

_NAMED = ("slot", "seq", "version", "rows")
SCHEMA = "slot string, seq bigint, version string, rows bigint, check bigint"


@dataclass(frozen=True)
class Version:
    """Where one version of a slot lies."""

    root: str
    slot: str
    id: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.slot}/version={self.id}"


def date_slot(run_date: dt.date) -> str:
    return f"date={run_date.isoformat()}"


def new_version(root: str, slot: str) -> Version:
    """A folder that no other run writes to."""
    return Version(root, slot, f"v{uuid.uuid4().hex}")


def pointers(spark: SparkSession, root: str, slot: str | None = None) -> DataFrame:
    """(slot, seq, version, rows, at) of every whole pointer; ``at`` is when it was written."""
    try:
        found = (
            spark.read.schema(SCHEMA).option("recursiveFileLookup", True)
            .json(f"{root.rstrip('/')}/_pointers/{slot or '*'}")
        )
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in (err.getCondition() or ""):
            raise
        return spark.createDataFrame([], "slot string, seq bigint, version string, rows bigint, at timestamp")
    whole = F.col("check") == row_hash(*_NAMED)
    return found.select("*", F.col("_metadata.file_modification_time").alias("at")).where(whole).drop("check")


def _latest() -> Column:
    """Of pointers with one number, written by two runs at once, all readers take the same."""
    return F.max(F.struct("seq", "version", "rows"))


def current(spark: SparkSession, root: str, slot: str | None = None) -> DataFrame:
    """(slot, seq, version, rows): what counts now, one row per slot that has ever been published."""
    return pointers(spark, root, slot).groupBy("slot").agg(_latest().alias("top")).select("slot", "top.*")


def point_to(spark: SparkSession, version: Version, rows: int) -> None:
    """Make a whole version the one that readers see."""
    # As many rows as the slot has versions since the last clean-up.
    seq = 1 + max((row.seq for row in pointers(spark, version.root, version.slot).select("seq").collect()), default=-1)
    pointer = spark.range(0, 1, 1, 1).select(
        F.lit(version.slot).alias("slot"), F.lit(seq).cast("bigint").alias("seq"),
        F.lit(version.id).alias("version"), F.lit(rows).cast("bigint").alias("rows"),
    )
    path = f"{version.root.rstrip('/')}/_pointers/{version.slot}/{seq:012d}-{version.id}"
    pointer.withColumn("check", row_hash(*_NAMED)).write.json(path)


def current_versions(spark: SparkSession, root: str) -> dict[str, Version]:
    """The version of each slot that readers see; as many as there are slots, not rows."""
    return {row.slot: Version(root, row.slot, row.version) for row in current(spark, root).collect()}


# Clean-up


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _newest(files: JavaObject, folder: JavaObject) -> int:
    """When anything below a folder last changed, unfinished files included."""
    newest = files.getFileStatus(folder).getModificationTime()
    below = files.listFiles(folder, True)
    while below.hasNext():
        newest = max(newest, below.next().getModificationTime())
    return newest


def _folders(spark: SparkSession, pattern: str) -> Iterator[tuple[JavaObject, JavaObject]]:
    files, where = _file_system(spark, pattern)
    for status in files.globStatus(where) or []:
        yield files, status.getPath()


def clean(spark: SparkSession, root: str, before: dt.datetime) -> list[str]:
    """Remove versions that no reader can hold since ``before`` (with its time zone), and their pointers; return their paths.

    A superseded version goes if the pointer after it is older than ``before``: readers that began earlier may still
    read it.  A version without pointer goes if nothing in it is newer, for its run may still be writing.  Versions go
    before their pointers, so a clean-up that is killed can be run again.
    """
    if before.tzinfo is None:
        raise ValueError("give the time with its zone")
    limit = int(before.timestamp() * 1000)
    history: dict[str, list] = {}
    for row in sorted(pointers(spark, root).select("*", (F.unix_micros("at") / 1000).cast("long").alias("ms")).collect(),
                      key=lambda row: (row.slot, row.seq, row.version)):
        history.setdefault(row.slot, []).append(row)
    kept, superseded = set(), set()
    for rows in history.values():
        for row, after in zip(rows, [*rows[1:], None]):
            (kept if after is None or after.ms >= limit else superseded).add((row.slot, row.version))
    removed = []
    for files, folder in _folders(spark, f"{root.rstrip('/')}/*/version=*"):
        key = (folder.getParent().getName(), folder.getName().removeprefix("version="))
        if key in kept or (key not in superseded and _newest(files, folder) >= limit):
            continue
        files.delete(folder, True)
        removed.append(folder.toString())
    for files, folder in _folders(spark, f"{root.rstrip('/')}/_pointers/*/*"):
        if (folder.getParent().getName(), folder.getName().split("-", 1)[-1]) in superseded:
            files.delete(folder, True)
    return sorted(removed)

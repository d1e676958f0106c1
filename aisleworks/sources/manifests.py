"""Manifests: what says that a dated export is finished, and what it holds.

Whoever delivers files writes the manifest last, exporters of other systems too: a file, or a folder
of files, named ``<table>_<date>.manifest`` beside the data, with JSON lines of the columns below.  One line without
``part`` is about the whole export; it needs ``table_name``, ``business_date`` and ``rows``, may have the digest (``high``
and ``low``) and may list the names of all parts.  Our own exports have a line for every part that holds rows besides.

A digest is the same for equal multisets of typed rows, in any order, and digests of parts add up to that of the whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from aisleworks.functions.digests import multiset_digest
from aisleworks.schemas import TABLES
from aisleworks.scratch import scratch_path
from aisleworks.sources.csv_files import read_by_header
from aisleworks.sources.listing import list_files
from aisleworks.sources.location import Location

SCHEMA = "table_name string, business_date date, rows bigint, part string, high bigint, low bigint, parts array<string>"
_DIGEST = ("rows", "high", "low")


class IncompleteExportError(RuntimeError):
    """An export does not hold what its manifest says."""


def clear_manifest(spark: SparkSession, location: Location, table: str, day: dt.date) -> None:
    """Take an earlier manifest away, before its data is replaced.

    Written without rows and by partition, a table has no file, so nothing is listed.
    """
    nothing = spark.createDataFrame([], SCHEMA)
    nothing.write.mode("overwrite").partitionBy("business_date").json(location.manifest_path(table, day))


def row_digest(table: str) -> list[Column]:
    """The digest of a table's rows as they are typed, ready for ``agg`` or ``observe``."""
    typed = (F.col(field.name).cast(field.dataType) for field in TABLES[table].fields)
    return [value.alias(name) for name, value in multiset_digest(*typed).items()]


def digested(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of the digest of what a job has read of it."""
    seen = Observation()
    return df.observe(seen, *row_digest(table)), seen


def part_digests(spark: SparkSession, location: Location, table: str, day: dt.date) -> DataFrame:
    """(part, rows, high, low) of every file of an export that holds rows, read from the files."""
    rows = read_by_header(spark, location, table, TABLES[table], day, part="part")
    return rows.groupBy("part").agg(*row_digest(table))


def write_manifest(spark: SparkSession, location: Location, table: str, day: dt.date, written: dict) -> None:
    """Read the export back part by part and, if its parts add up to the digest ``written``, write its manifest.

    What the files cannot give back, such as text that spells the NULL mark, is found here and not by
    the reader.  The manifest is one file, so it appears whole.
    """
    scratch = scratch_path(spark, "parts")
    seen = Observation()
    parts = part_digests(spark, location, table, day)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _DIGEST]
    parts.observe(seen, *sums).write.parquet(scratch)
    if seen.get != written:
        raise IncompleteExportError(f"{table} for {day}: the files written read as {seen.get}, the rows were {written}")
    _manifest(spark, table, day, written).unionByName(
        spark.read.schema(parts.schema).parquet(scratch), allowMissingColumns=True
    ).withColumns({"table_name": F.lit(table), "business_date": F.lit(day)}).coalesce(1).write.mode("overwrite").json(
        location.manifest_path(table, day)
    )


def write_total(spark: SparkSession, location: Location, table: str, day: dt.date, written: dict) -> None:
    """A manifest of the whole export alone, without reading anything back."""
    _manifest(spark, table, day, written).coalesce(1).write.mode("overwrite").json(location.manifest_path(table, day))


def _manifest(spark: SparkSession, table: str, day: dt.date, written: dict) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(
        F.lit(table).alias("table_name"), F.lit(day).alias("business_date"),
        *(F.lit(written[name]).cast("bigint").alias(name) for name in _DIGEST),
    )


def manifest_lines(spark: SparkSession, location: Location, table: str, day: dt.date) -> DataFrame:
    """All lines of a manifest; none if it is not there."""
    try:
        return spark.read.schema(SCHEMA).json(location.manifest_path(table, day))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in (err.getCondition() or ""):
            raise
        return spark.createDataFrame([], SCHEMA)


def read_manifest(spark: SparkSession, location: Location, table: str, day: dt.date) -> Row:
    """The manifest's line about the whole export; fails if there is none or more than one.

    Names of parts stay where they are: ``listed`` says whether there are any.
    """
    whole = manifest_lines(spark, location, table, day).where("part IS NULL")
    found = whole.select("table_name", "business_date", *_DIGEST, F.col("parts").isNotNull().alias("listed")).limit(2).collect()
    if len(found) != 1 or found[0].table_name != table or found[0].business_date != day:
        raise IncompleteExportError(f"no manifest of {table} for {day} at {location.manifest_path(table, day)}")
    return found[0]


def _examples(frame: DataFrame) -> list[str]:
    return sorted(row.part for row in frame.select("part").limit(5).collect())


def _complain(table: str, day: dt.date, **found: DataFrame) -> None:
    """Fail if any of the frames holds a part, naming a few."""
    named = {what: _examples(frame) for what, frame in found.items()}
    if any(named.values()):
        told = ", ".join(f"{what} parts {parts}" for what, parts in named.items() if parts)
        raise IncompleteExportError(f"{table} for {day}: {told}")


def check_listed(spark: SparkSession, location: Location, table: str, day: dt.date) -> None:
    """Fail unless just the parts are there that the manifest lists by name alone."""
    names = manifest_lines(spark, location, table, day).where("part IS NULL").select(F.explode("parts").alias("part"))
    files = list_files(spark, location.root, location.file_name(table, day))
    there = files.select(F.element_at(F.split("path", "/"), -1).alias("part"))
    _complain(table, day, missing=names.join(there, "part", "left_anti"), unknown=there.join(names, "part", "left_anti"))


def check_read(spark: SparkSession, location: Location, table: str, day: dt.date, manifest: Row, read: dict) -> None:
    """Fail unless a read has seen just the rows that the manifest stands for.

    ``read`` is what ``digested`` observed.  Only where it differs are the parts themselves compared, in Spark, to
    name those at fault.
    """
    if read["rows"] == manifest.rows and (manifest.high is None or (read["high"], read["low"]) == (manifest.high, manifest.low)):
        return
    lines = manifest_lines(spark, location, table, day).where("part IS NOT NULL").select("part", *_DIGEST)
    if manifest.high is not None and not lines.isEmpty():
        there = part_digests(spark, location, table, day)
        _complain(
            table, day,
            missing=lines.join(there, "part", "left_anti"),
            unknown=there.join(lines, "part", "left_anti"),
            altered=lines.join(there, ["part", *_DIGEST], "left_anti").join(there, "part", "left_semi"),
        )
    what = "but not the same ones" if read["rows"] == manifest.rows else f"its manifest has {manifest.rows}"
    raise IncompleteExportError(f"{table} for {day}: {read['rows']} rows read, {what}")

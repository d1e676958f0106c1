"""Dated full-snapshot exports to headered CSV."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisleworks.schemas import SNAPSHOT_DATE
from aisleworks.sources.location import Location
from aisleworks.sources.manifests import clear_manifest, digested, write_manifest, write_total

# About 100 MB of CSV per part file for rows of a hundred bytes.
ROWS_PER_FILE = 1_000_000


def snapshot(df: DataFrame, table: str, run_date: dt.date) -> DataFrame:
    """Rows known on ``run_date``: facts up to that day, dimensions whole."""
    dated = SNAPSHOT_DATE.get(table)
    return df.where(F.col(dated) <= F.lit(run_date)) if dated else df


def _export_one(df: DataFrame, table: str, location: Location, run_date: dt.date, verify: bool) -> int:
    # Counted and digested in the writing stage itself: no second pass over the source, and Spark
    # counts each finished partition of that stage once however often its tasks are retried.
    spark = df.sparkSession
    clear_manifest(spark, location, table, run_date)
    observed, seen = digested(snapshot(df, table, run_date), table)
    (
        observed.write.mode("overwrite")
        .options(**location.csv_options())
        .option("header", True)
        .option("compression", "none")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .csv(location.path(table, run_date))
    )
    (write_manifest if verify else write_total)(spark, location, table, run_date, seen.get)
    return seen.get["rows"]


def export_snapshot(
    tables: Mapping[str, DataFrame], location: Location, run_date: dt.date, verify: bool = True
) -> dict[str, int]:
    """Write ``<table>_<date>.csv`` for each table, then its manifest; return the rows written.

    A table counts as arrived by its manifest alone.  That of an earlier export goes
    before the data is touched and the new one comes after its commit.

    The rows are digested as they are written.  With ``verify`` the files are then read back, each part gets
    a digest of its own in the manifest, and parts that do not add up to the whole fail the export; without
    it the manifest has the digest of the whole alone.

    Each export is a folder of part files, so no table passes through one task.
    The tables are independent jobs and are submitted together.
    """
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        jobs = {
            name: pool.submit(_export_one, df, name, location, run_date, verify)
            for name, df in tables.items()
        }
        return {name: job.result() for name, job in jobs.items()}


def audit_frame(spark: SparkSession, rows: Mapping[str, int]) -> DataFrame:
    """The export's row counts, one row per table."""
    return spark.createDataFrame(sorted(rows.items()), "table_name string, rows_unloaded bigint")

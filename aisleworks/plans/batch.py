"""The daily batch: gate, read, compute, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from aisleworks import schemas
from aisleworks.operators.checks import require_unique
from aisleworks.operators.readiness import missing_files, required_files
from aisleworks.plans.daily import kpi_daily
from aisleworks.plans.restate import restate
from aisleworks.scratch import scratch_path
from aisleworks.session import require_ansi
from aisleworks.sinks import write_partition
from aisleworks.sources import Location, list_files, read_by_header, read_published
from aisleworks.sources.manifests import check_listed, check_read, digested, read_manifest

INPUTS = ("sales", "calendar", "inventory")


class MissingFilesError(RuntimeError):
    """Some files of the run date have not arrived; they are listed in ``names``."""

    def __init__(self, names: list[str]):
        super().__init__(f"missing files: {', '.join(names)}")
        self.names = names


def check_ready(spark: SparkSession, landing: Location, run_date: dt.date) -> None:
    """Raise unless the manifests of all five files of the run date are there.

    Only names of that date are listed, however many dates the folder holds.
    """
    required = required_files(spark.createDataFrame([(run_date,)], "business_date date"))
    listing = list_files(spark, landing.root, f"*_{run_date.isoformat()}.manifest")
    absent = missing_files(required, listing).collect()
    if absent:
        raise MissingFilesError(sorted(row.file_name for row in absent))


def read_inputs(spark: SparkSession, landing: Location, run_date: dt.date) -> dict[str, DataFrame]:
    """The three tables the KPIs need, typed, and proven whole.

    Each file is read once, into a scratch table; the rows that the read has seen are those that
    its manifest stands for, by number and digest.
    """
    root = scratch_path(spark, "inputs")

    def read_whole(table: str) -> DataFrame:
        manifest = read_manifest(spark, landing, table, run_date)
        if manifest.listed:
            check_listed(spark, landing, table, run_date)
        read = read_by_header(spark, landing, table, schemas.TABLES[table], run_date)
        observed, seen = digested(read, table)
        observed.write.parquet(f"{root}/{table}")
        check_read(spark, landing, table, run_date, manifest, seen.get)
        return spark.read.schema(read.schema).parquet(f"{root}/{table}")

    # Independent jobs, submitted together.
    with ThreadPoolExecutor(max_workers=len(INPUTS)) as pool:
        return dict(zip(INPUTS, pool.map(read_whole, INPUTS), strict=True))


def run_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    output_root: str,
    run_date: dt.date,
    check_keys: bool = True,
    cluster_by: str | Sequence[str] | None = "trans_dt",
) -> int:
    """Publish the KPIs of one run date from typed tables and return the rows written.

    Rerunning a date replaces its partition and leaves every other date alone.
    ``check_keys`` refuses repeated calendar days and inventory keys, which would
    multiply sales; tables that ``load_table`` made have been checked already.
    ``cluster_by`` is how ``write_partition`` lays the rows out.
    """
    require_ansi(spark)
    inputs = {table: tables[table] for table in INPUTS}
    if check_keys:
        for table in ("calendar", "inventory"):
            require_unique(inputs[table], schemas.UNIQUE_KEYS[table], table)
    return write_partition(kpi_daily(**inputs), output_root, run_date, cluster_by)


def restate_tables(
    spark: SparkSession,
    before: Mapping[str, DataFrame],
    after: Mapping[str, DataFrame],
    output_root: str,
    previous: dt.date,
    run_date: dt.date,
    check_keys: bool = True,
) -> int:
    """``run_tables`` over ``after``, from what ``previous`` has published and how ``before`` differs.

    ``before`` holds the tables that the published rows of ``previous`` were made of.  Rows are written as they come,
    so those of unchanged dates are copied without a shuffle.
    """
    require_ansi(spark)
    sides = [{table: side[table] for table in INPUTS} for side in (before, after)]
    if check_keys:
        for table in ("calendar", "inventory"):
            require_unique(sides[1][table], schemas.UNIQUE_KEYS[table], table)
    published = read_published(spark, output_root, [previous])
    return write_partition(restate(published, *sides), output_root, run_date, cluster_by=None)


def rerun(
    spark: SparkSession,
    landing: Location,
    output_root: str,
    previous: dt.date,
    run_date: dt.date,
    check_keys: bool = True,
) -> int:
    """``run``, from what ``previous`` has published and how its files differ from those of ``run_date``."""
    require_ansi(spark)
    for day in (previous, run_date):
        check_ready(spark, landing, day)
    before, after = (read_inputs(spark, landing, day) for day in (previous, run_date))
    return restate_tables(spark, before, after, output_root, previous, run_date, check_keys)


def run(
    spark: SparkSession,
    landing: Location,
    output_root: str,
    run_date: dt.date,
    check_keys: bool = True,
) -> int:
    """Gate, read and publish one run date from the files in ``landing``; see ``run_tables``."""
    require_ansi(spark)
    check_ready(spark, landing, run_date)
    inputs = read_inputs(spark, landing, run_date)
    return run_tables(spark, inputs, output_root, run_date, check_keys)

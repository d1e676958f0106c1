"""spark-submit entry: load tables, export snapshots, publish the KPIs of a run date, or clean old versions away."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from aisleworks.plans.batch import rerun, run, run_tables
from aisleworks.schemas import TABLES
from aisleworks.session import build_session
from aisleworks.sinks import export_snapshot
from aisleworks.sources import Location, load_table, read_table
from aisleworks.versions import clean


def _stored(spark: SparkSession, root: str) -> dict:
    return {name: read_table(spark, f"{root}/{name}", schema) for name, schema in TABLES.items()}


def _load(spark: SparkSession, given: argparse.Namespace) -> str:
    source = Location(given.landing, null_value=given.null_value)
    for name in TABLES:
        load_table(spark, source, name, f"{given.tables}/{name}")
    return f"{len(TABLES)} tables loaded"


def _export(spark: SparkSession, given: argparse.Namespace) -> str:
    landing = Location(given.landing, null_value=given.null_value)
    rows = export_snapshot(_stored(spark, given.tables), landing, given.run_date)
    return ", ".join(f"{name} {count}" for name, count in sorted(rows.items())) + " rows exported"


def _publish(spark: SparkSession, given: argparse.Namespace) -> str:
    if given.tables:
        rows = run_tables(spark, _stored(spark, given.tables), given.output, given.run_date, check_keys=False)
    else:
        landing = Location(given.landing, null_value=given.null_value)
        if given.since:
            rows = rerun(spark, landing, given.output, given.since, given.run_date)
        else:
            rows = run(spark, landing, given.output, given.run_date)
    return f"{rows} rows published"


def _clean(spark: SparkSession, given: argparse.Namespace) -> str:
    return f"{len(clean(spark, given.output, given.before))} versions removed"


def _moment(text: str) -> dt.datetime:
    moment = dt.datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)


def main() -> None:
    args = argparse.ArgumentParser(prog="aisleworks", description=__doc__)
    commands = args.add_subparsers(required=True, dest="command")
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--null-value", default="\\N", help="text that stands for NULL")
    load = commands.add_parser("load", parents=[shared], help="load <table>.csv of all five tables")
    export = commands.add_parser("export", parents=[shared], help="export a snapshot of all five tables")
    publish = commands.add_parser("run", parents=[shared], help="publish the KPIs of a run date")
    publish.add_argument(
        "--since", type=dt.date.fromisoformat, help="a published date: compute only what its files and the run date's differ in"
    )
    cleaning = commands.add_parser("clean", parents=[shared], help="remove versions that no reader needs any more")
    cleaning.add_argument("--before", type=_moment, required=True, help="ISO time, UTC unless it names a zone: readers may be as old")
    for command in (export, publish):
        command.add_argument("run_date", type=dt.date.fromisoformat, help="yyyy-MM-dd")
    for command in (load, export):
        command.add_argument("--landing", required=True, help="folder of the CSV files")
        command.add_argument("--tables", required=True, help="folder of the typed tables")
    source = publish.add_mutually_exclusive_group(required=True)
    source.add_argument("--landing", help="folder holding <table>_<date>.csv and manifests")
    source.add_argument("--tables", help="folder of typed tables that load has made")
    for command in (publish, cleaning):
        command.add_argument("--output", required=True, help="root of the date= partitions")
    given = args.parse_args()
    if getattr(given, "since", None) and not given.landing:
        args.error("--since compares files: give --landing")
    spark = build_session("aisleworks")
    print({"load": _load, "export": _export, "run": _publish, "clean": _clean}[given.command](spark, given))
    spark.stop()


if __name__ == "__main__":
    main()

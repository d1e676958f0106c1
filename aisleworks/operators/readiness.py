"""Have all files of a business date arrived?

A table has arrived once its manifest is there, which is written after all of its
files; files without one are an export under way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisleworks.functions import date_text
from aisleworks.schemas import TABLES

REQUIRED = tuple(sorted(TABLES))

# Manifests, alone or as a folder of part files: <table>_<date>.manifest
_NAME = r"(?:^|/)(" + "|".join(REQUIRED) + r")_(\d{4}-\d{2}-\d{2})\.manifest(?:/|$)"


def file_name(table: Column, day: Column) -> Column:
    return F.concat(table, F.lit("_"), date_text(day), F.lit(".csv"))


def required_files(days: DataFrame) -> DataFrame:
    """The five files each business date needs."""
    return (
        days.select("business_date")
        .distinct()
        .withColumn("table_name", F.explode(F.array(*[F.lit(t) for t in REQUIRED])))
        .withColumn("file_name", file_name(F.col("table_name"), F.col("business_date")))
    )


def manifest_of(path: Column) -> tuple[Column, Column]:
    """Table and business date of a manifest's path; the date is NULL for other files."""
    return F.regexp_extract(path, _NAME, 1), F.try_to_date(F.regexp_extract(path, _NAME, 2), "yyyy-MM-dd")


def arrived_files(listing: DataFrame) -> DataFrame:
    """Table and business date of each listed manifest; other files are ignored."""
    table, day = manifest_of(F.col("path"))
    return (
        listing.select(table.alias("table_name"), day.alias("business_date"))
        .where((F.col("table_name") != "") & F.col("business_date").isNotNull())
        .withColumn("file_name", file_name(F.col("table_name"), F.col("business_date")))
    )


def missing_files(required: DataFrame, listing: DataFrame) -> DataFrame:
    """Required files whose manifest is not listed; empty means ready."""
    return required.join(arrived_files(listing).select("file_name"), "file_name", "left_anti")


def arrival_flags() -> list[Column]:
    """One flag per table, so state and results stay at five booleans per date."""
    return [F.bool_or(F.col("table_name") == t).alias(f"has_{t}") for t in REQUIRED]


def readiness_status(required: DataFrame, flags: DataFrame) -> DataFrame:
    """Files arrived, names missing and the verdict for every required date."""
    has = {t: F.coalesce(F.col(f"has_{t}"), F.lit(False)) for t in REQUIRED}
    arrived = reduce(lambda a, b: a + b, [c.cast("int") for c in has.values()])
    absent = F.concat_ws(",", *[F.when(~c, F.lit(t)) for t, c in has.items()])
    return (
        required.select("business_date")
        .distinct()
        .join(flags, "business_date", "left")
        .select(
            "business_date",
            arrived.alias("files_arrived"),
            absent.alias("files_missing"),
            (arrived == len(REQUIRED)).alias("ready"),
        )
    )


def readiness_by_date(required: DataFrame, listing: DataFrame) -> DataFrame:
    flags = arrived_files(listing).groupBy("business_date").agg(*arrival_flags())
    return readiness_status(required, flags)


def manifest_json(ready_days: DataFrame, root: str) -> DataFrame:
    """The run request of each ready date: its five file names and their paths."""
    day = F.col("business_date")
    names = {t: file_name(F.lit(t), day) for t in REQUIRED}
    entries = [
        part
        for name in names.values()
        for part in (name, F.concat(F.lit(root.rstrip("/") + "/"), name))
    ]
    request = F.struct(F.struct(F.create_map(*entries).alias("data")).alias("conf"))
    return ready_days.select(day, F.to_json(request).alias("payload"))
